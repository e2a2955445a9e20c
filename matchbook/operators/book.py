"""Book products read off the tagged output of the matching operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import execution_id
from ..schemas import (EXECUTION_COLUMNS, KIND_BOOK, KIND_FILL, KIND_REJECT, KIND_REST, KIND_SNAPSHOT,
                       SIDE_NAMES, SIDE_BUY, SIDE_SELL, SNAPSHOT_HEADER_COLUMNS)
from .matching import Cadence, keyed_rows, match_keyed
from .validate import STAGE_ENGINE, engine_checked


def match_batch(requests: DataFrame, restored: DataFrame | None = None, snapshot_every: int = 0,
                num_partitions: int | None = None, emit_final: bool = True,
                symbols: list[str] | None = None, snapshot_interval_us: int = 0, steps: bool | None = None) -> DataFrame:
    """Run the books over a bounded request table; returns tagged rows (schemas.TAGGED).

    One pass over the input: rows failing the engine checks (or refused
    upstream, see ``validate.ingest_tagged``) travel through the same shuffle,
    spread by offset, and come back as ``kind = 'reject'`` rows. ``symbols``
    restricts the run to some books; the filter is applied before the
    shuffle, where Catalyst can push it into the scan (it cannot pass the
    Python operator by itself). ``snapshot_every`` orders, and ``snapshot_interval_us`` of
    receive time, set when a book's snapshot header is written; ``steps`` adds the order log
    (by default with either).
    """
    if symbols is not None:
        requests = requests.filter(F.col("symbol").isin(symbols))
        if restored is not None:
            restored = restored.filter(F.col("symbol").isin(symbols))
    return match_keyed(keyed_rows(engine_checked(requests), restored), num_partitions,
                       Cadence(snapshot_every, snapshot_interval_us, steps), emit_final)


def executions(tagged: DataFrame, now: bool = False) -> DataFrame:
    """ExecutedTrade rows. Execution time is the incoming order's receive time, the same in every replay; with ``now``
    the time at which the query (or micro-batch) runs."""
    at = F.current_timestamp().cast("timestamp_ntz") if now else F.col("at")
    return tagged.filter(F.col("kind") == KIND_FILL).select(
        "symbol", "price", "size", "bid_request_id", "ask_request_id", at.alias("executed_at"),
        execution_id("bid_request_id", "ask_request_id").alias("execution_id"),
    ).select(*EXECUTION_COLUMNS)


def executions_with_position(tagged: DataFrame) -> DataFrame:
    """Executions plus the incoming order's stream position and fill number."""
    return tagged.filter(F.col("kind") == KIND_FILL).select(
        "symbol", "price", "size", "bid_request_id", "ask_request_id", F.col("at").alias("executed_at"),
        execution_id("bid_request_id", "ask_request_id").alias("execution_id"), "partition", "offset", "fill_no",
    )


def resting_orders(tagged: DataFrame) -> DataFrame:
    """Orders left in the books at the end of the input: symbol, side, id, price, size, seq."""
    return tagged.filter(F.col("kind") == KIND_REST).select(
        "symbol", "side", F.col("request_id").alias("id"), "price", "size", "seq")


def book_headers(tagged: DataFrame) -> DataFrame:
    """One row per book at the end of the input."""
    return tagged.filter(F.col("kind") == KIND_BOOK).select(
        "symbol", F.col("partition").alias("trades_partition"), F.col("offset").alias("last_offset"),
        F.col("seq").alias("orderbook_seq"), F.col("size").alias("since_snapshot"), F.col("price").alias("interval_no"))


def snapshots(tagged: DataFrame) -> DataFrame:
    """Headers of the book snapshots that the run took; ``operators.lifetimes`` has their orders."""
    return tagged.filter(F.col("kind") == KIND_SNAPSHOT).select(
        F.col("at").alias("created_at"), "symbol", F.col("partition").alias("trades_partition"),
        F.col("offset").alias("last_offset"), F.col("seq").alias("orderbook_seq"),
    ).select(*SNAPSHOT_HEADER_COLUMNS)


def engine_rejects(tagged: DataFrame) -> DataFrame:
    """Refused requests of a matching run (stage, reason, partition, offset, raw = request id)."""
    return tagged.filter(F.col("kind") == KIND_REJECT).select(
        F.coalesce(F.col("stage"), F.lit(STAGE_ENGINE)).alias("stage"), "reason", "partition", "offset",
        F.col("request_id").alias("raw"))


def top_of_book(resting: DataFrame) -> DataFrame:
    """Best bid and best ask per symbol (one aggregate; partial aggregation applies)."""
    is_bid = F.col("side") == SIDE_NAMES[SIDE_BUY]
    is_ask = F.col("side") == SIDE_NAMES[SIDE_SELL]
    order = F.struct("id", "price", "size", "seq")
    best_bid = F.max_by(F.when(is_bid, order), F.when(is_bid, F.struct(F.col("price"), -F.col("seq"))))
    best_ask = F.min_by(F.when(is_ask, order), F.when(is_ask, F.struct(F.col("price"), F.col("seq"))))
    agg = resting.groupBy("symbol").agg(best_bid.alias("b"), best_ask.alias("a"))
    return agg.select(
        "symbol",
        F.col("b.id").alias("bid_id"), F.col("b.price").alias("bid_price"), F.col("b.size").alias("bid_size"),
        F.col("a.id").alias("ask_id"), F.col("a.price").alias("ask_price"), F.col("a.size").alias("ask_size"),
    )
