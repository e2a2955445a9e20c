"""The persister: a stream over the growing execution log into the trades table.

Each micro-batch is inserted if absent (``operators.trades``) under its own ``(run_id, batch_id)``; what the table
refuses, and records that can't be decoded, go to the rejects of the same batch. A batch that was written but not yet
committed when the job died is written again as the same partitions.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..operators.trades import insert_trades, table_rejects, tasks_for
from ..schemas import EXECUTION
from ..session import checkpoint_dir
from ..sources.requests import decode_json
from .jobs import _output_schemas, _write_batch, checkpoint_run_id


def execution_stream(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """The execution log that ``tagged_sink`` writes, as a stream (each execution with its stream position)."""
    schema = _output_schemas()["executions"]
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
            .drop("run_id", "batch_id"))


def persist_sink(path: str, rejects: str, run_id: str, table: str | None = None, as_text: bool = False):
    """foreachBatch body. ``as_text``: the batch holds messages (partition, offset, value) instead of executions."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        refused, tasks = None, tasks_for(batch.count())
        if as_text:
            batch, refused = decode_json(batch, EXECUTION)
        insert_trades(batch.sparkSession, batch, path, batch_id, run_id=run_id, table=table, tasks=tasks)
        bad = table_rejects(batch)
        _write_batch(bad if refused is None else bad.unionByName(refused), rejects, batch_id, run_id)

    return sink


def run_persist_stream(executions: DataFrame, path: str, rejects: str | None = None, checkpoint: str | None = None,
                       table: str | None = None, as_text: bool = False, available_now: bool = True,
                       trigger_interval: str = "1 second"):
    """Start the persister on a stream of executions; with ``available_now`` it runs to the end of the log and returns."""
    spark: SparkSession = executions.sparkSession
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "persist-stream", os.path.basename(path.rstrip("/")))
    sink = persist_sink(path, rejects or path.rstrip("/") + "-rejects", checkpoint_run_id(spark, ckpt), table, as_text)
    writer = executions.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger_interval)
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
