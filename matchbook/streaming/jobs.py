"""Streaming jobs: the keyed matcher and its exactly-once sinks."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.render import execution_json
from ..functions.unsigned import is_wide, to_bits
from ..operators import book as book_ops
from ..operators import lifetimes
from ..operators.matching import KEYED_COLUMNS, Cadence
from ..operators.routing import keyed_messages, write_message_log
from ..operators.trades import _exists, insert_trades, table_rejects
from ..operators.validate import engine_checked
from ..schemas import TAGGED
from ..session import checkpoint_dir, ship_package
from .processor import LANE_BOOK, LANE_REFUSED, REJECT_KEYS, BookProcessor

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def match_stream(requests: DataFrame, restored: DataFrame | None = None, snapshot_every: int = 0,
                 snapshot_interval_ms: int = 0, symbols: list[str] | None = None, snapshot_interval_us: int = 0,
                 steps: bool | None = None) -> DataFrame:
    """Streaming tagged rows (schemas.TAGGED) from a streaming request DataFrame.

    Snapshots are taken after ``snapshot_every`` orders, by ``snapshot_interval_us`` of receive time (when the first
    order of a later interval arrives), and by a processing-time timer of ``snapshot_interval_ms`` (idle books too).

    ``restored`` is a batch DataFrame of restore rows (``operators.snapshots.restore_rows``)
    used as the initial state of each symbol's book.
    """
    spark = requests.sparkSession
    ship_package(spark)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    if symbols is not None:  # before the keyed operator, so it reaches the source
        requests = requests.filter(F.col("symbol").isin(symbols))
        if restored is not None:
            restored = restored.filter(F.col("symbol").isin(symbols))
    checked = engine_checked(requests)
    # One pass over each micro-batch: refused rows go through the same keyed
    # operator in their own lane, spread by offset (an empty or NULL symbol
    # would otherwise be one hot key), and leave state untouched.
    refused = F.col("reject_reason").isNotNull()
    lane = F.when(refused, F.lit(LANE_REFUSED)).otherwise(F.lit(LANE_BOOK))
    key = F.when(refused, F.pmod(F.col("offset"), F.lit(REJECT_KEYS)).cast("string")).otherwise(F.col("symbol"))
    rows = checked.select(lane.alias("_lane"), key.alias("_key"), "symbol", "partition", "offset", "request_id",
                          "received_at", "side", *[(to_bits(F.col(c)) if is_wide(checked, c) else F.col(c)).alias(c) for c in ("price", "size")],
                          "reject_stage", "reject_reason")
    initial = None
    if restored is not None:
        initial = restored.select(F.lit(LANE_BOOK).alias("_lane"), F.col("symbol").alias("_key"),
                                  *KEYED_COLUMNS).groupBy("_lane", "_key")
    if steps is None:
        steps = bool(snapshot_every or snapshot_interval_us or snapshot_interval_ms)
    cadence = Cadence(snapshot_every, snapshot_interval_us, steps)
    time_mode = "processingTime" if snapshot_interval_ms else "none"
    return rows.groupBy("_lane", "_key").transformWithStateInPandas(
        BookProcessor(cadence, snapshot_interval_ms), TAGGED, "append", time_mode, initialState=initial)


def _write_batch(df: DataFrame, path: str, batch_id: int, run_id: str) -> None:
    """Append one micro-batch idempotently: only its own (run, batch) partition is overwritten on replay."""
    (df.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("long")})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "batch_id").parquet(path))


def checkpoint_run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the run that owns a checkpoint, kept inside it: a restart from the checkpoint has the same id, a
    fresh checkpoint (whose batch ids start at 0 again) a new one."""
    path = os.path.join(checkpoint, "run-id")
    if not _exists(spark, os.path.join(path, "_SUCCESS")):
        spark.range(1).select(F.lit(uuid.uuid4().hex).alias("value")).write.mode("overwrite").text(path)
    return spark.read.text(path).first().value


def tagged_sink(out_dir: str, parallel: bool = True, run_id: str = "0", table: str | None = None,
                message_partitions: int = 0):
    """foreachBatch body: split the tagged batch into executions, snapshot headers, the order log, rejects
    and the trades table.

    Executions that the table refuses go to the rejects of the same batch, so no row disappears. ``table`` names the
    trades table in the catalog, if it shall be kept there; with ``message_partitions`` the executions are also published
    as keyed messages (``messages``).
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        from concurrent.futures import ThreadPoolExecutor

        spark = batch.sparkSession
        batch = batch.persist()
        try:
            batch.count()  # materialise once; the writes below read the cached batch
            fills = book_ops.executions_with_position(batch)
            writes = [
                lambda: _write_batch(fills, os.path.join(out_dir, "executions"), batch_id, run_id),
                lambda: _write_batch(book_ops.snapshots(batch), os.path.join(out_dir, "snapshots"), batch_id, run_id),
                lambda: _write_batch(lifetimes.order_log(batch), os.path.join(out_dir, "orders"), batch_id, run_id),
                lambda: _write_batch(book_ops.engine_rejects(batch).unionByName(table_rejects(fills)),
                                     os.path.join(out_dir, "rejects"), batch_id, run_id),
                lambda: insert_trades(spark, fills, os.path.join(out_dir, "trades"), batch_id, run_id=run_id, table=table),
            ]
            if message_partitions:
                sent = keyed_messages(fills, execution_json(fills), message_partitions, "execution_id")
                writes.append(lambda: write_message_log(sent, os.path.join(out_dir, "messages"), batch_id, run_id))
            if parallel:
                # independent jobs: submitted together, Spark runs them side by side
                with ThreadPoolExecutor(len(writes)) as pool:
                    for f in [pool.submit(w) for w in writes]:
                        f.result()
            else:
                for w in writes:
                    w()
        finally:
            batch.unpersist()

    return sink


def run_match_stream(requests: DataFrame, out_dir: str, checkpoint: str | None = None,
                     restored: DataFrame | None = None, snapshot_every: int = 0, snapshot_interval_ms: int = 0,
                     available_now: bool = True, trigger_interval: str = "1 second", snapshot_interval_us: int = 0, **sink):
    """Start the matcher with the tagged sink; with ``available_now`` runs to the end of the input and returns.
    ``sink``: further arguments of ``tagged_sink``."""
    spark: SparkSession = requests.sparkSession
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "match-stream", os.path.basename(out_dir.rstrip("/")))
    tagged = match_stream(requests, restored, snapshot_every, snapshot_interval_ms, snapshot_interval_us=snapshot_interval_us)
    writer = tagged.writeStream.foreachBatch(tagged_sink(out_dir, run_id=checkpoint_run_id(spark, ckpt), **sink)).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger_interval)
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def _output_schemas():
    from pyspark.sql import types as T

    from ..operators.trades import STORED
    from ..schemas import EXECUTION, ORDER_STEP, REJECT, SNAPSHOT_HEADER

    batch = [T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType())]
    position = [T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType()),
                T.StructField("fill_no", T.IntegerType())]
    return {
        "executions": T.StructType(EXECUTION.fields + position + batch),
        "snapshots": T.StructType(SNAPSHOT_HEADER.fields + batch),
        "orders": T.StructType(ORDER_STEP.fields + batch),
        "rejects": T.StructType(REJECT.fields + batch),
        "trades": STORED,
        "messages": T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.StringType()),
                                  T.StructField("partition", T.IntegerType())] + batch),
    }


def read_stream_output(spark: SparkSession, out_dir: str, kind: str = "executions") -> DataFrame:
    """Read one output of ``tagged_sink`` with its fixed schema (works on empty outputs too)."""
    return spark.read.schema(_output_schemas()[kind]).parquet(os.path.join(out_dir, kind))
