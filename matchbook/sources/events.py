"""Order flow derived from the driver's ``events`` table.

Every valid event becomes one limit order; integer arithmetic only, so the same
view can be written in any SQL dialect and compared by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.symbols import lex_bucket
from ..schemas import REQUEST_COLUMNS

# Fixed values of the view: request partitions and the price grid.
REQUEST_PARTITIONS = 3
BASE_PRICE = 100
PRICE_STEPS = 11
MICROS = 1_000_000
SIZE_STEPS = 9


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _letter(n: Column) -> Column:
    return F.char((F.lit(65) + n).cast("long"))


def symbol_of_user(user_id: Column) -> Column:
    return F.concat(
        _letter(user_id % 26),
        _letter(F.floor(user_id / 26).cast("long") % 26),
        _letter((user_id * 7) % 26),
    )


def _order_columns(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").alias("offset"),
        F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("request_id"),
        F.col("ts").cast("timestamp_ntz").alias("received_at"),
        symbol_of_user(F.col("user_id")).alias("symbol"),
        F.when(F.col("event_id") % 2 == 0, F.lit(1)).otherwise(F.lit(0)).cast("int").alias("side"),
        ((F.lit(BASE_PRICE) + F.floor("value").cast("long") % PRICE_STEPS) * MICROS).cast("long").alias("price"),
        (F.lit(1) + F.floor(F.col("event_id") / 2).cast("long") % SIZE_STEPS).cast("long").alias("size"),
        F.col("event_type"),
    )


def order_flow(events: DataFrame, keep_type: bool = False) -> DataFrame:
    """Valid-only order flow: one request row per non-error event (REQUEST schema); with ``keep_type`` every event,
    and its type."""
    o = _order_columns(events if keep_type else events.filter(F.col("event_type") != "error"))
    columns = REQUEST_COLUMNS + (["event_type"] if keep_type else [])
    return o.withColumn("partition", lex_bucket("symbol", REQUEST_PARTITIONS)).select(*columns)


def dirty_requests(events: DataFrame, keep_type: bool = False) -> DataFrame:
    """All events as raw submit requests, error events broken in one field.

    Columns: source, offset, received_at, symbol (raw, padded lower case),
    side, price, size. Broken field by ``event_id % 5``: 0 price 0, 1 size 0,
    2 both 0, 3 blank symbol, 4 side 7.
    """
    o = _order_columns(events)
    bad = F.col("event_type") == "error"
    k = F.col("offset") % 5
    return o.select(
        F.lit("events").alias("source"),
        "offset",
        "received_at",
        F.when(bad & (k == 3), F.lit("   "))
        .otherwise(F.concat(F.lit("  "), F.lower("symbol"), F.lit(" ")))
        .alias("symbol"),
        F.when(bad & (k == 4), F.lit(7)).otherwise(F.col("side")).cast("int").alias("side"),
        F.when(bad & k.isin(0, 2), F.lit(0)).otherwise(F.col("price")).cast("long").alias("price"),
        F.when(bad & k.isin(1, 2), F.lit(0)).otherwise(F.col("size")).cast("long").alias("size"),
        *(["event_type"] if keep_type else []),
    )


# Fixed values of the skewed view: symbols before this letter (about a third of all) trade as one.
HOT_BEFORE = "J"
HOT_SYMBOL = "HOT"


def hot_flow(requests: DataFrame) -> DataFrame:
    """The request flow with about a third of its rows on one symbol (skew); other symbols are as they were."""
    hot = requests.withColumn("symbol", F.when(F.col("symbol") < HOT_BEFORE, F.lit(HOT_SYMBOL)).otherwise(F.col("symbol")))
    return hot.withColumn("partition", lex_bucket("symbol", REQUEST_PARTITIONS)).select(*requests.columns)
