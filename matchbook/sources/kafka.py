"""Kafka connectors (optional: needs the spark-sql-kafka package on the classpath).

Messages carry proto-JSON text; a deployment with the spark-protobuf package
can swap ``from_json`` for ``from_protobuf`` on the same columns. Nothing here
runs in the test suite (the connector jar is not installed).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.unsigned import WIDE, whole
from ..schemas import EXECUTION, MAX_BIGINT, MAX_UNSIGNED, SNAPSHOT
from .requests import CORRUPT, bad_fields, decode_json, side_code

EVENT_JSON = T.StructType([
    T.StructField("trade", T.StructType([
        T.StructField("instrument", T.StructType([T.StructField("symbol", T.StringType())])),
        T.StructField("side", T.StringType()),
        T.StructField("price", T.StringType()),
        T.StructField("size", T.StringType()),
    ])),
    T.StructField("received_at", T.StringType()),
    T.StructField("request_id", T.StringType()),
    T.StructField(CORRUPT, T.StringType()),
])


def _reader(spark: SparkSession, servers: str, topic: str, stream: bool, **options):
    r = spark.readStream if stream else spark.read
    r = r.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    r = r.option("startingOffsets", options.pop("startingOffsets", "earliest"))
    if not stream:
        r = r.option("endingOffsets", options.pop("endingOffsets", "latest"))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load()


def request_log(spark: SparkSession, servers: str, topic: str, stream: bool = True, wide: bool = False, **options) -> DataFrame:
    """Trade requests from oldest offset, keeping partition and offset (see ``decode_request_records``)."""
    return decode_request_records(_reader(spark, servers, topic, stream, **options), wide)


def decode_request_records(raw: DataFrame, wide: bool = False) -> DataFrame:
    """Log records ``(partition, offset, value)`` holding proto-JSON TradeEvents -> request rows.

    REQUEST columns plus ``reject_stage`` / ``reject_reason``: undecodable
    records (a bad time too) and values beyond unsigned 64 bits are refused here and ride
    the matcher's reject lane; such a row keeps the record's text in place of its request id.
    ``wide`` gives prices and sizes as ``decimal(20,0)``, all unsigned 64-bit values; without it they
    are bigints and values above that range are refused.
    """
    j = F.from_json(F.col("value").cast("string"), EVENT_JSON,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    side = F.col("j.trade.side")
    price = F.col("j.trade.price").try_cast("decimal(20,0)")
    size = F.col("j.trade.size").try_cast("decimal(20,0)")
    at = F.col("j.received_at").try_cast("timestamp")
    undecodable = (F.col("j").isNull() | F.col(f"j.{CORRUPT}").isNotNull()
                   | bad_fields(side, F.col("j.trade.price"), F.col("j.trade.size"))
                   | (F.col("j.received_at").isNotNull() & at.isNull()))
    most = whole(MAX_UNSIGNED if wide else MAX_BIGINT)
    too_big = F.coalesce((price > most) | (size > most), F.lit(False))
    number = WIDE if wide else "long"
    text = F.col("value").cast("string")
    return raw.select("partition", "offset", "value", j.alias("j")).select(
        F.col("partition").cast("int"), "offset",
        F.when(undecodable | too_big, text).otherwise(F.coalesce(F.col("j.request_id"), F.lit(""))).alias("request_id"),
        at.cast("timestamp_ntz").alias("received_at"),
        F.when(F.col("j.trade.instrument").isNotNull(),
               F.coalesce(F.col("j.trade.instrument.symbol"), F.lit(""))).alias("symbol"),
        F.coalesce(side_code(side), F.lit(0)).alias("side"),
        F.when(price <= most, price.cast(number)).alias("price"),
        F.when(size <= most, size.cast(number)).alias("size"),
        F.when(undecodable | too_big, F.lit("decode")).alias("reject_stage"),
        F.when(undecodable, F.lit("undecodable")).when(too_big, F.lit("out_of_range")).alias("reject_reason"),
    )


def execution_log(spark: SparkSession, servers: str, topic: str, stream: bool = True, **options) -> DataFrame:
    raw = _reader(spark, servers, topic, stream, **options)
    return decode_json(raw.select("partition", "offset", F.col("value").cast("string").alias("value")), EXECUTION)[0]


def snapshot_log(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Bounded read of the whole snapshot log (earliest to latest), undecodable records skipped."""
    raw = _reader(spark, servers, topic, False, **options)
    return decode_json(raw.select("offset", F.col("value").cast("string").alias("value")), SNAPSHOT)[0].drop("offset")


def write_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Publish key/value messages (batch write, or a streaming query when ``messages`` is streaming)."""
    if messages.isStreaming:
        return (messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("topic", topic).option("checkpointLocation", checkpoint).start())
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
    return None
