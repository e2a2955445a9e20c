"""Request validation: front-end ingest (P1-P3) and the engine's own checks (P4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import request_id as derive_request_id
from ..functions.symbols import lex_bucket, normalise_symbol
from ..functions.unsigned import WIDE, is_wide, whole
from ..schemas import MAX_UNSIGNED, REQUEST_COLUMNS

# Reject reasons, first failing check wins, in this order.
INGEST_REASONS = ["missing_instrument", "empty_symbol", "size", "price", "out_of_range"]
ENGINE_REASONS = ["missing_instrument", "empty_symbol", "price_or_size", "missing_request_id"]

STAGE_INGEST, STAGE_ENGINE = "ingest", "engine"


def _raw_text(df: DataFrame) -> Column:
    """A compact, dialect-neutral rendering of the raw request for the quarantine table."""
    if "raw" in df.columns:
        return F.col("raw")
    return F.concat_ws("|", F.col("symbol"), F.col("side").cast("string"), F.col("price").cast("string"),
                       F.col("size").cast("string"))


def ingest_checked(raw: DataFrame, partitions: int = 3) -> DataFrame:
    """Front-end validation and normalisation of raw submit requests.

    Input columns: ``source, offset, received_at, symbol, side, price, size``
    (symbol NULL = instrument missing; side/price/size NULL = absent, i.e. 0).
    Output: REQUEST columns plus ``reject_reason`` (NULL when accepted) and ``raw``.
    Narrow projection only: no shuffle.

    Wire values are unsigned 64-bit: text or decimal input is read, and given on, as ``decimal(20,0)`` in that whole
    range; integral input is a bigint and checked for its sign only (``decimal(20,0)`` costs an object for each row).
    """
    wide = not all(isinstance(raw.schema[c].dataType, T.IntegralType) for c in ("price", "size"))
    num = WIDE if wide else "long"
    price = F.coalesce(F.col("price").cast(num), F.lit(0).cast(num))
    size = F.coalesce(F.col("size").cast(num), F.lit(0).cast(num))
    symbol = normalise_symbol("symbol")
    out_of_range = (size < 0) | (price < 0)
    if wide:
        out_of_range = out_of_range | (size > whole(MAX_UNSIGNED)) | (price > whole(MAX_UNSIGNED))
    reason = (
        F.when(F.col("symbol").isNull(), F.lit(INGEST_REASONS[0]))
        .when(symbol == "", F.lit(INGEST_REASONS[1]))
        .when(size == 0, F.lit(INGEST_REASONS[2]))
        .when(price == 0, F.lit(INGEST_REASONS[3]))
        .when(out_of_range, F.lit(INGEST_REASONS[4]))
    )
    checked = raw.select(
        F.col("source"),
        F.col("offset").cast("long").alias("offset"),
        F.coalesce(F.col("received_at").cast("timestamp_ntz"), F.current_timestamp().cast("timestamp_ntz"))
        .alias("received_at"),
        symbol.alias("symbol"),
        F.coalesce(F.col("side").cast("int"), F.lit(0)).alias("side"),
        price.alias("price"),
        size.alias("size"),
        reason.alias("reject_reason"),
        _raw_text(raw).alias("raw"),
    )
    # Accepted rows always have a non-empty symbol, so the alphabetical bucket
    # needs no hash fallback here (see functions.symbols.route for that case).
    # It is computed for every row, outside any CASE branch: inside a branch
    # Spark does not share the repeated byte extraction and cost grows ~20x.
    return checked.select(
        "*",
        derive_request_id("source", "offset").alias("request_id"),
        lex_bucket("symbol", partitions).alias("partition"),
    )


def ingest_tagged(raw: DataFrame, partitions: int = 3) -> DataFrame:
    """Single-pass ingest: REQUEST columns plus ``reject_stage`` / ``reject_reason`` (NULL = accepted).

    Feed this straight into ``match_batch``: refused rows come back as
    ``kind = 'reject'`` rows of the same plan, so the input is read once.
    """
    checked = ingest_checked(raw, partitions)
    return checked.select(*REQUEST_COLUMNS, F.when(F.col("reject_reason").isNotNull(), F.lit(STAGE_INGEST))
                          .alias("reject_stage"), "reject_reason")


def ingest(raw: DataFrame, partitions: int = 3) -> tuple[DataFrame, DataFrame]:
    """Split raw requests into accepted request rows and quarantined rejects.

    Two DataFrames over one input: consuming both reads the input twice. Use
    ``ingest_tagged`` (batch) or a persisted micro-batch (streaming) to write both in one pass.
    """
    checked = ingest_checked(raw, partitions)
    accepted = checked.filter(F.col("reject_reason").isNull()).select(*REQUEST_COLUMNS)
    rejects = checked.filter(F.col("reject_reason").isNotNull()).select(
        F.lit(STAGE_INGEST).alias("stage"),
        F.col("reject_reason").alias("reason"),
        F.lit(None).cast("int").alias("partition"),
        "offset",
        "raw",
    )
    return accepted, rejects


def engine_reason(df: DataFrame) -> Column:
    """The engine's checks on a request row; NULL when the row may reach the book."""
    return (
        F.when(F.col("symbol").isNull(), F.lit(ENGINE_REASONS[0]))
        .when(F.col("symbol") == "", F.lit(ENGINE_REASONS[1]))
        .when((F.coalesce(F.col("price"), F.lit(0)) <= 0) | (F.coalesce(F.col("size"), F.lit(0)) <= 0),
              F.lit(ENGINE_REASONS[2]))
        .when(F.coalesce(F.col("request_id"), F.lit("")) == "", F.lit(ENGINE_REASONS[3]))
    )


def engine_checked(requests: DataFrame) -> DataFrame:
    """Request rows with proto3 defaults applied, plus ``reject_stage`` / ``reject_reason``.

    Rows already refused upstream (input columns ``reject_stage`` and
    ``reject_reason``) keep that verdict; the others get the engine checks.
    A row with an unknown side passes (reason NULL): it must still reach the
    keyed operator, where it takes a sequence number and is rejected there.
    Prices and sizes given as ``decimal(20,0)`` stay so (the upper half of the unsigned range).
    """
    upstream = "reject_reason" in requests.columns
    d = requests.select(
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        F.coalesce(F.col("request_id"), F.lit("")).alias("request_id"),
        F.col("received_at").cast("timestamp_ntz").alias("received_at"),
        F.col("symbol"),
        F.coalesce(F.col("side").cast("int"), F.lit(0)).alias("side"),
        *[F.coalesce(F.col(c).cast(WIDE if is_wide(requests, c) else "long"), F.lit(0)).alias(c) for c in ("price", "size")],
        *([F.col("reject_stage"), F.col("reject_reason").alias("upstream_reason")] if upstream else []),
    )
    checked = d.withColumn("engine_reason", engine_reason(d))
    if not upstream:
        return checked.select("*", F.when(F.col("engine_reason").isNotNull(), F.lit(STAGE_ENGINE))
                              .alias("reject_stage"), F.col("engine_reason").alias("reject_reason"))
    return checked.select(
        *[c for c in checked.columns if c not in ("reject_stage", "upstream_reason")],
        F.when(F.col("upstream_reason").isNotNull(), F.col("reject_stage"))
        .when(F.col("engine_reason").isNotNull(), F.lit(STAGE_ENGINE)).alias("reject_stage"),
        F.coalesce(F.col("upstream_reason"), F.col("engine_reason")).alias("reject_reason"))
