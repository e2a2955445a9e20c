"""Request routing and the request log (publish side).

Requests are laid out alphabetically: ``partition = lex_bucket(symbol, n)``,
so one symbol always lands in one request partition and its arrival order
is the offset order inside that partition. The matching job itself shuffles
by hash of symbol (alphabetical ranges are skewed by construction).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.render import trade_event_json
from ..functions.symbols import hash_bucket, route

#: Files that a task may write at once; 0: one, after a sort by partition.
MANY_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def with_route(requests: DataFrame, n: int, key: str = "symbol", fallback: str = "request_id") -> DataFrame:
    """Set ``partition`` from the alphabetical rule (hash of ``fallback`` when the key is empty)."""
    return requests.withColumn("partition", route(key, fallback, n))


def route_requests(requests: DataFrame, n: int) -> DataFrame:
    """Physically place each request in Spark partition = its request partition (no hashing)."""
    return with_route(requests, n).repartitionById(n, F.col("partition"))


def keyed_messages(df: DataFrame, value, n: int, fallback: str) -> DataFrame:
    """key, value, partition: messages of a log with ``n`` partitions dealt by hash of the key (executions, snapshots).

    An empty symbol gives no key; its partition comes from the ``fallback`` column. One symbol stays in one partition.
    """
    key = F.nullif(F.col("symbol"), F.lit(""))
    return df.select(key.alias("key"), value.alias("value"), hash_bucket(F.coalesce(key, F.col(fallback)), n).alias("partition"))


def write_message_log(messages: DataFrame, path: str, batch_id: int = 0, run_id: str = "0", dealt: bool = False) -> None:
    """File form of a keyed topic: one folder for each batch and message partition; a replayed batch rewrites itself.

    ``dealt``: the messages of a task are of one partition, and those that are alike stand together (whole books). They are
    written as they come, without a sort of whole messages by partition, and compressed over long distances; a row group
    has few messages, as a reader holds its texts at once.
    """
    spark = messages.sparkSession
    writers = spark.conf.get(MANY_WRITERS, "0")
    named = messages.withColumns({"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("long")})
    out = named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id", "batch_id", "partition")
    if not dealt:
        out.parquet(path)
        return
    try:
        spark.conf.set(MANY_WRITERS, "8")
        out.option("compression", "zstd").option("parquet.block.row.count.limit", "128").parquet(path)
    finally:
        spark.conf.set(MANY_WRITERS, writers)


def encode_messages(df: DataFrame, value) -> DataFrame:
    """Keyed messages: key = symbol (NULL when empty, so the sink's own partitioner applies), value = text."""
    return df.select(F.nullif(F.col("symbol"), F.lit("")).alias("key"), value.alias("value"))


def request_messages(requests: DataFrame) -> DataFrame:
    """TradeEvent messages keyed by symbol, plus the request partition for keyed sinks."""
    return requests.select(F.nullif(F.col("symbol"), F.lit("")).alias("key"),
                           trade_event_json(requests).alias("value"), F.col("partition"))


def write_request_log(requests: DataFrame, path: str, n: int = 3, batch_id: int = 0, width: int = 1 << 20) -> None:
    """File form of the request topic: one folder per request partition and batch, offset order inside each file.

    A request partition is written by as many tasks as it has offset ranges of ``width``, not by one. Writing a
    batch again replaces that batch alone.
    """
    ranged = with_route(requests, n).withColumn("_range", F.floor(F.col("offset") / width))
    (ranged.repartition("partition", "_range").sortWithinPartitions("partition", "offset").drop("_range")
     .withColumn("batch_id", F.lit(batch_id).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("partition", "batch_id").parquet(path))
