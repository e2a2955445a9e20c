"""The front end as a stream: raw submit requests in, request log and rejects out.

One stateless job. Each micro-batch is checked in one pass and written by one job into ``outcome=accepted`` and
``outcome=refused`` folders of its own ``(run_id, batch_id)``; a replayed micro-batch rewrites only these, another run's
never. Request ids come from the row's source and position, so a replay, a restart or another split of the input into
micro-batches gives the same ids.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.unsigned import is_wide, to_bits, widened
from ..operators.validate import STAGE_INGEST, ingest_checked
from ..schemas import REJECT, REQUEST, REQUEST_COLUMNS
from ..session import checkpoint_dir
from ..sources.requests import decode_submit_json, numbered_lines
from .jobs import checkpoint_run_id

ACCEPTED, REFUSED = "accepted", "refused"
#: Rows of the ingest log: a request, and why it was refused (NULL: accepted).
INGEST_LOG = T.StructType(REQUEST.fields + [T.StructField("stage", T.StringType()), T.StructField("reason", T.StringType()),
                                            T.StructField("raw", T.StringType())])
STORED = T.StructType(INGEST_LOG.fields + [T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType()),
                                           T.StructField("outcome", T.StringType())])


def ingest_log(raw: DataFrame, partitions: int = 3) -> DataFrame:
    """Every raw request once (INGEST_LOG columns); accepted rows carry no raw text. Prices and sizes are stored as
    bigints that hold their 64 bits, whether the source gave bigints or ``decimal(20,0)``."""
    checked = ingest_checked(raw, partitions)
    checked = checked.withColumns({c: to_bits(F.col(c)) for c in ("price", "size") if is_wide(checked, c)})
    refused = F.col("reject_reason").isNotNull()
    return checked.select(*REQUEST_COLUMNS, F.when(refused, F.lit(STAGE_INGEST)).alias("stage"), F.col("reject_reason").alias("reason"),
                          F.when(refused, F.col("raw")).alias("raw"))


def _undecodable(rejects: DataFrame) -> DataFrame:
    """Rejects of the decoder in the columns of the ingest log."""
    return rejects.select(*[F.col(f.name) if f.name in rejects.columns else F.lit(None).cast(f.dataType).alias(f.name)
                            for f in INGEST_LOG.fields])


def ingest_sink(out_dir: str, run_id: str, partitions: int = 3, as_text: bool = False):
    """foreachBatch body; ``as_text``: the batch holds lines of proto-JSON (``numbered_lines``), not raw request rows."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        if as_text:
            good, bad = decode_submit_json(numbered_lines(batch))
            rows = ingest_log(good, partitions).unionByName(_undecodable(bad))
        else:
            rows = ingest_log(batch, partitions)
        outcome = F.when(F.col("reason").isNull(), F.lit(ACCEPTED)).otherwise(F.lit(REFUSED))
        (rows.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("long"), "outcome": outcome})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id", "batch_id", "outcome").parquet(out_dir))

    return sink


def run_ingest_stream(raw: DataFrame, out_dir: str, checkpoint: str | None = None, partitions: int = 3, as_text: bool = False,
                      available_now: bool = True, trigger_interval: str = "1 second"):
    """Start the ingest job; with ``available_now`` it runs to the end of the input and returns."""
    spark: SparkSession = raw.sparkSession
    ckpt = checkpoint or os.path.join(checkpoint_dir(spark), "ingest-stream", os.path.basename(out_dir.rstrip("/")))
    sink = ingest_sink(out_dir, checkpoint_run_id(spark, ckpt), partitions, as_text)
    writer = raw.writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger_interval)
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def text_lines(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Streaming text files of one JSON request per line, with what ``numbered_lines`` needs."""
    return (spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
            .select("value", F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("block")))


def read_ingest(spark: SparkSession, out_dir: str, outcome: str | None = None) -> DataFrame:
    """The ingest log (INGEST_LOG columns); ``outcome`` reads one folder of each batch only."""
    rows = spark.read.schema(STORED).parquet(out_dir)
    if outcome is not None:
        rows = rows.filter(F.col("outcome") == outcome)
    return rows.select(*[f.name for f in INGEST_LOG.fields])


def accepted_requests(spark: SparkSession, out_dir: str, wide: bool = False) -> DataFrame:
    """Accepted requests; ``wide``: prices and sizes as ``decimal(20,0)``, for flows that go beyond BIGINT."""
    rows = read_ingest(spark, out_dir, ACCEPTED).select(*REQUEST_COLUMNS)
    return widened(rows, "price", "size") if wide else rows


def refused_requests(spark: SparkSession, out_dir: str) -> DataFrame:
    """Rejects of the front end (REJECT columns); a refused request has no partition yet."""
    return read_ingest(spark, out_dir, REFUSED).select(
        *[F.lit(None).cast("int").alias("partition") if f.name == "partition" else F.col(f.name) for f in REJECT.fields])
