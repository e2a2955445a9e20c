"""Explicit schemas of the order-flow data model (never inferred).

Prices are integer micro-units (10^-6 of the currency unit); sizes are whole
units; both are unsigned 64-bit on the wire. They are ``bigint`` columns; a flow that
uses the upper half of the range carries ``decimal(20,0)`` instead (``functions.unsigned``),
and in shuffles, books and state the 64 bits themselves.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the wire format: side enum codes (SELL is the zero default).
SIDE_SELL = 0
SIDE_BUY = 1
SIDE_NAMES = {SIDE_SELL: "SELL", SIDE_BUY: "BUY"}

# Largest value a BIGINT table column can hold, and the largest wire value (unsigned 64 bits).
MAX_BIGINT = (1 << 63) - 1
MAX_UNSIGNED = (1 << 64) - 1

# Flat request row: one TradeEvent plus its stream position.
REQUEST = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("received_at", T.TimestampNTZType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("side", T.IntegerType()),
        T.StructField("price", T.LongType()),
        T.StructField("size", T.LongType()),
    ]
)
REQUEST_COLUMNS = [f.name for f in REQUEST.fields]

ORDER = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("price", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)

EXECUTION = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("bid_request_id", T.StringType()),
        T.StructField("ask_request_id", T.StringType()),
        T.StructField("executed_at", T.TimestampNTZType()),
        T.StructField("execution_id", T.StringType()),
    ]
)
EXECUTION_COLUMNS = [f.name for f in EXECUTION.fields]

SNAPSHOT = T.StructType(
    [
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("trades_partition", T.IntegerType()),
        T.StructField("last_offset", T.LongType()),
        T.StructField("orderbook_seq", T.LongType()),
        T.StructField("bids", T.ArrayType(ORDER)),
        T.StructField("asks", T.ArrayType(ORDER)),
    ]
)
SNAPSHOT_COLUMNS = [f.name for f in SNAPSHOT.fields]

# A snapshot without its orders: the orders of any book are in the order log (ORDER_STEP).
SNAPSHOT_HEADER = T.StructType([f for f in SNAPSHOT.fields if f.name not in ("bids", "asks")])
SNAPSHOT_HEADER_COLUMNS = [f.name for f in SNAPSHOT_HEADER.fields]

# One change of a resting order: from book sequence number ``book_seq`` on its resting size is ``size`` (0: it left).
# ``seq`` is the order's own arrival number, unique within a symbol.
ORDER_STEP = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("id", T.StringType()),
        T.StructField("price", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("book_seq", T.LongType()),
    ]
)
ORDER_STEP_COLUMNS = [f.name for f in ORDER_STEP.fields]

# Output of the matching operator: one schema, rows tagged by ``kind``.
#   fill     one execution (incoming order = aggressor)
#   rest     one order left in a book at the end of the input
#   book     one row per book at the end of the input (seq, last offset;
#            size = orders since the last snapshot and price = number of the receive-time interval,
#            so a resumed run keeps the cadence)
#   snapshot one book snapshot (header only)
#   step     one change of a resting order (see ORDER_STEP)
#   reject   a request refused before or by the books (stage + reason)
KIND_FILL, KIND_REST, KIND_BOOK, KIND_SNAPSHOT, KIND_STEP, KIND_REJECT = (
    "fill",
    "rest",
    "book",
    "snapshot",
    "step",
    "reject",
)
TAGGED = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("fill_no", T.IntegerType()),
        T.StructField("side", T.StringType()),
        T.StructField("price", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("request_id", T.StringType()),
        T.StructField("bid_request_id", T.StringType()),
        T.StructField("ask_request_id", T.StringType()),
        T.StructField("at", T.TimestampNTZType()),
        T.StructField("reason", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("book_seq", T.LongType()),
    ]
)
TAGGED_COLUMNS = [f.name for f in TAGGED.fields]

TRADES_TABLE = T.StructType(
    [
        T.StructField("execution_id", T.StringType()),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("price", T.LongType(), False),
        T.StructField("size", T.LongType(), False),
        T.StructField("bid_request_id", T.StringType()),
        T.StructField("ask_request_id", T.StringType()),
        T.StructField("executed_at", T.TimestampNTZType()),
    ]
)
TRADES_COLUMNS = [f.name for f in TRADES_TABLE.fields]

REJECT = T.StructType(
    [
        T.StructField("stage", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("raw", T.StringType()),
    ]
)
