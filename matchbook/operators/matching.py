"""Price-time priority matching of limit orders, one book per symbol.

The book logic is one small pure class shared by the batch operator (this
module) and the streaming processor. Within a symbol the outcome depends on
arrival order, so a symbol's orders are processed in (partition, offset) order
by exactly one task; symbols are spread over tasks by a hash shuffle.

Batch plan::

    requests --engine checks--> keyed rows --repartition(n, symbol | offset for refused rows)
      --sortWithinPartitions(lane, symbol, phase, partition, offset)--> mapInArrow

The Python generator (Arrow batches in and out) holds a single book at a
time and streams the sorted rows through it, so task memory is one book plus
one Arrow batch, never a whole symbol's history.

A book snapshot is a header. What rests in a book is told by the order log: one ``step`` row for each change of a
resting order (it came to rest, was filled in part, left), so written rows grow with the orders, however deep the
books are and however often snapshots are taken (``operators.lifetimes`` reads any book back from the log).
"""

from __future__ import annotations

from collections import deque
from heapq import heapify, heappop, heappush
from itertools import islice
from typing import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.unsigned import MASK, is_wide, signed, to_bits
from ..session import ship_package
from ..schemas import MAX_BIGINT, SIDE_BUY, SIDE_NAMES, SIDE_SELL, TAGGED, TAGGED_COLUMNS

# Phases of keyed input rows: refused requests (passed through, no book),
# a restored book's header, its resting orders, then the requests themselves.
PHASE_REJECT, PHASE_BOOK, PHASE_ORDER, PHASE_REQUEST = -1, 0, 1, 2
KEYED_COLUMNS = [
    "symbol", "phase", "partition", "offset", "request_id", "received_at", "side", "price", "size", "seq",
    "stage", "reason",
]
# Refused rows first (phase -1), then each symbol's rows in arrival order.
SORT_COLUMNS = ["_lane", "symbol", "phase", "partition", "offset", "seq"]
UNKNOWN_SIDE = "unknown_side"
DUPLICATE_OFFSET = "duplicate_offset"
#: Rows of output that are held before they are given back, and input rows between two looks at that.
FLUSH_ROWS = 1 << 13
LOOK_ROWS = 1 << 10

_NAT = np.iinfo(np.int64).min
# Arrow types of schemas.TAGGED, in column order.
ARROW_TAGGED = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64(),
                pa.int64(), pa.string(), pa.string(), pa.string(), pa.timestamp("us"), pa.string(), pa.string(),
                pa.int64()]


class Book:
    """One symbol's order book, by price level.

    ``levels[side]`` maps a price to its orders, a queue of ``[seq, id, size]`` in arrival order; ``heaps[side]`` holds
    the prices of the side, best first (negated for bids). A level may be fetched only when it is reached
    (``fetch``: the streaming processor reads it from state); ``touched`` names the levels that changed.
    """

    __slots__ = ("symbol", "levels", "heaps", "prices", "seq", "last_offset", "partition", "since_snapshot", "interval",
                 "fetch", "touched")

    def __init__(self, symbol: str, seq: int = 0, last_offset: int = -1, partition=None,
                 fetch: Callable[[int, int], list] | None = None):
        self.symbol = symbol
        self.levels: tuple[dict, dict] = ({}, {})
        self.heaps: tuple[list, list] = ([], [])
        self.prices: tuple[set, set] = (set(), set())
        self.seq = seq
        self.last_offset = last_offset
        self.partition = partition
        self.since_snapshot = 0
        self.interval = None
        self.fetch = fetch
        self.touched: set[tuple[int, int]] = set()

    def add_prices(self, side: int, prices: Iterable[int]) -> None:
        """Prices whose orders are fetched when they are reached."""
        self.prices[side].update(prices)
        self.heaps[side][:] = [-p if side == SIDE_BUY else p for p in self.prices[side]]
        heapify(self.heaps[side])

    def level(self, side: int, price: int) -> deque:
        found = self.levels[side].get(price)
        if found is None:
            if price not in self.prices[side]:
                self.prices[side].add(price)
                heappush(self.heaps[side], -price if side == SIDE_BUY else price)
                found = deque()
            else:
                found = deque(self.fetch(side, price))
            self.levels[side][price] = found
        return found

    def rest(self, side: int, order_id: str, price: int, size: int, seq: int) -> None:
        """Put a resting order behind those of its price."""
        self.touched.add((side, price))
        self.level(side, price).append([seq, order_id, size])

    def submit(self, side: int, price: int, size: int, order_id: str, fills: list, steps: list | None = None) -> bool:
        """Apply one incoming limit order; append ``(price, size, bid_id, ask_id)`` fills.

        The order takes the next sequence number even when its side is unknown; it then trades nothing and False
        is returned. ``steps`` gets ``(side, price, seq, id, size now resting)`` of every order whose size changed.
        """
        self.seq += 1
        if side == SIDE_BUY:
            heap, limit = self.heaps[SIDE_SELL], price
        elif side == SIDE_SELL:
            heap, limit = self.heaps[SIDE_BUY], -price
        else:
            return False
        other = SIDE_BUY + SIDE_SELL - side
        while size and heap and heap[0] <= limit:
            best = heap[0] if side == SIDE_BUY else -heap[0]
            level = self.level(other, best)
            self.touched.add((other, best))
            while size and level:
                top = level[0]
                q = size if size < top[2] else top[2]
                fills.append((best, q, order_id, top[1]) if side == SIDE_BUY else (best, q, top[1], order_id))
                size -= q
                top[2] -= q
                if steps is not None:
                    steps.append((other, best, top[0], top[1], top[2]))
                if not top[2]:
                    level.popleft()
            if not level:
                heappop(heap)
                del self.levels[other][best]
                self.prices[other].remove(best)
        if size:
            self.rest(side, order_id, price, size, self.seq)
            if steps is not None:
                steps.append((side, price, self.seq, order_id, size))
        return True

    def side_orders(self, side: int) -> list[dict]:
        """Resting orders of one side in priority order, as Order structs."""
        return [{"id": oid, "price": price, "size": size, "seq": seq}
                for price in sorted(self.prices[side], reverse=side == SIDE_BUY) for seq, oid, size in self.level(side, price)]


class TaggedRows:
    """Accumulates tagged output rows (schemas.TAGGED order).

    ``record_batch`` feeds the batch operator (``mapInArrow``); ``frame``
    feeds the streaming processor (pandas). ``at`` is epoch microseconds.
    """

    __slots__ = ("rows",)

    def __init__(self):
        self.rows: list[tuple] = []

    # column order follows schemas.TAGGED
    def fill(self, symbol, partition, offset, seq, n, side_name, price, size, rid, bid, ask, at):
        self.rows.append(("fill", symbol, partition, offset, seq, n, side_name, price, size, rid, bid, ask, at,
                          None, None, seq))

    def reject(self, symbol, partition, offset, seq, rid, reason, stage="engine"):
        self.rows.append(("reject", symbol, partition, offset, seq, None, None, None, None, rid, None, None, None,
                          reason, stage, seq))

    def step(self, symbol, partition, offset, book_seq, at, side, price, seq, oid, size):
        self.rows.append(("step", symbol, partition, offset, seq, None, SIDE_NAMES[side], price, size, oid, None, None,
                          at, None, None, book_seq))

    def snapshot(self, book: Book, at):
        self.rows.append(("snapshot", book.symbol, book.partition, book.last_offset, book.seq, None, None, None,
                          None, None, None, None, at, None, None, book.seq))

    def final(self, book: Book):
        """End of input for a book: its resting orders and one header row."""
        rows = self.rows
        for side in (SIDE_BUY, SIDE_SELL):
            for o in book.side_orders(side):
                rows.append(("rest", book.symbol, book.partition, book.last_offset, o["seq"], None, SIDE_NAMES[side],
                             o["price"], o["size"], o["id"], None, None, None, None, None, book.seq))
        rows.append(("book", book.symbol, book.partition, book.last_offset, book.seq, None, None, book.interval,
                     book.since_snapshot, None, None, None, None, None, None, book.seq))

    def __len__(self):
        return len(self.rows)

    def columns(self) -> list:
        """The accumulated rows by column; prices and sizes as the bigints that hold their 64 bits."""
        cols = list(zip(*self.rows)) if self.rows else [[] for _ in TAGGED_COLUMNS]
        self.rows = []
        for name in ("price", "size"):
            i = TAGGED_COLUMNS.index(name)
            if max((x for x in cols[i] if x is not None), default=0) > MAX_BIGINT:
                cols[i] = [signed(x) for x in cols[i]]
        return cols

    def record_batch(self) -> pa.RecordBatch:
        """The accumulated rows as one Arrow batch (``at`` holds epoch microseconds)."""
        cols = self.columns()
        return pa.RecordBatch.from_arrays(
            [pa.array(list(values), type=t) for values, t in zip(cols, ARROW_TAGGED)], names=TAGGED_COLUMNS)

    def frame(self) -> pd.DataFrame:
        if not self.rows:
            return pd.DataFrame({c: pd.Series([], dtype=object) for c in TAGGED_COLUMNS})
        cols = self.columns()
        out = {}
        for name, values in zip(TAGGED_COLUMNS, cols):
            if name in ("partition", "fill_no"):
                out[name] = pd.array(values, dtype="Int32")
            elif name in ("offset", "seq", "price", "size", "book_seq"):
                out[name] = pd.array(values, dtype="Int64")
            elif name == "at":  # epoch microseconds; int64 min is NaT
                micros = np.array([_NAT if v is None else v for v in values], dtype="int64")
                out[name] = pd.Series(micros.view("datetime64[us]"))
            else:
                out[name] = pd.Series(values, dtype=object)
        return pd.DataFrame(out)


def _micros(series: pd.Series) -> list:
    """Timestamps as epoch microseconds (None for NaT)."""
    arr = series.to_numpy(dtype="datetime64[us]")
    ints = arr.astype("int64").tolist()
    if np.isnat(arr).any():
        return [None if np.isnat(a) else v for a, v in zip(arr, ints)]
    return ints


def unsigned_values(values: list) -> list:
    """Prices or sizes read from bigints: 64 bits without a sign."""
    if min((x for x in values if x is not None), default=0) >= 0:
        return values
    return [x if x is None else x & MASK for x in values]


class Cadence:
    """What a book writes besides its fills: the order log, and a snapshot after every ``every`` orders and at the end
    of each ``interval_us`` of receive time in which it had orders (both 0: none)."""

    __slots__ = ("every", "interval_us", "steps")

    def __init__(self, every: int = 0, interval_us: int = 0, steps: bool | None = None):
        self.every = int(every or 0)
        self.interval_us = int(interval_us or 0)
        self.steps = bool(self.every or self.interval_us) if steps is None else steps


def apply_requests(book: Book, out: TaggedRows, rows: Iterable[tuple], cadence: Cadence | int) -> None:
    """Feed request rows ``(partition, offset, request_id, at, side, price, size)`` in order into ``book``.

    A row whose offset the book has already passed is a redelivery: it is given back as a refused row. The snapshot of
    an interval is taken when the first order of a later interval arrives (of equal or earlier times, none).
    """
    if isinstance(cadence, int):
        cadence = Cadence(cadence)
    symbol, every, width, log = book.symbol, cadence.every, cadence.interval_us, cadence.steps
    for part, off, rid, at, side, price, size in rows:
        if part == book.partition and off <= book.last_offset:
            out.reject(symbol, part, off, None, rid, DUPLICATE_OFFSET)
            continue
        if width and at is not None:
            this = at // width
            if book.interval is None or this > book.interval:
                if book.interval is not None:
                    out.snapshot(book, (book.interval + 1) * width)
                book.interval = this
        fills: list = []
        steps: list | None = [] if log else None
        ok = book.submit(side, price, size, rid, fills, steps)
        book.last_offset = off
        book.partition = part
        if not ok:
            out.reject(symbol, part, off, book.seq, rid, UNKNOWN_SIDE)
            continue
        if fills:
            name, seq = SIDE_NAMES[side], book.seq
            for n, (p, q, bid, ask) in enumerate(fills):
                out.fill(symbol, part, off, seq, n, name, p, q, rid, bid, ask, at)
        if steps:
            for s in steps:
                out.step(symbol, part, off, book.seq, at, *s)
        if every > 0:
            book.since_snapshot += 1
            if book.since_snapshot >= every:
                out.snapshot(book, at)
                book.since_snapshot = 0


def match_sorted(batches: Iterator[pa.RecordBatch], cadence: Cadence | int = 0, emit_final: bool = True
                 ) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: rows arrive sorted by (lane, symbol, phase, partition, offset)."""
    book: Book | None = None
    out = TaggedRows()
    for rb in batches:
        n = rb.num_rows
        if not n:
            continue
        col = {name: rb.column(i) for i, name in enumerate(rb.schema.names)}
        symbols = col["symbol"].to_pylist()
        phases = col["phase"].to_pylist()
        parts = col["partition"].to_pylist()
        offsets = col["offset"].to_pylist()
        rids = col["request_id"].to_pylist()
        ats = col["received_at"].cast(pa.int64()).to_pylist()
        sides = col["side"].to_pylist()
        prices, sizes = (unsigned_values(col[c].to_pylist()) for c in ("price", "size"))
        seqs = col["seq"].to_pylist()
        i = 0
        if phases[0] == PHASE_REJECT:
            stages, reasons = col["stage"].to_pylist(), col["reason"].to_pylist()
            while i < n and phases[i] == PHASE_REJECT:
                out.reject(symbols[i], parts[i], offsets[i], None, rids[i], reasons[i], stages[i])
                i += 1
        while i < n:
            sym = symbols[i]
            if book is None or sym != book.symbol:
                if book is not None and emit_final:
                    out.final(book)
                book = Book(sym)
            # restored header and resting orders of this symbol
            while i < n and symbols[i] == sym and phases[i] != PHASE_REQUEST:
                if phases[i] == PHASE_BOOK:
                    book.seq, book.last_offset, book.partition = seqs[i], offsets[i], parts[i]
                    book.since_snapshot, book.interval = sizes[i] or 0, prices[i]
                else:
                    book.rest(sides[i], rids[i], prices[i], sizes[i], seqs[i])
                i += 1
            j = i
            while j < n and symbols[j] == sym:
                j += 1
            rows = zip(parts[i:j], offsets[i:j], rids[i:j], ats[i:j], sides[i:j], prices[i:j], sizes[i:j])
            for _ in range(i, j, LOOK_ROWS):
                apply_requests(book, out, islice(rows, LOOK_ROWS), cadence)
                if len(out) >= FLUSH_ROWS:
                    yield out.record_batch()
            i = j
        if len(out):
            yield out.record_batch()
    if book is not None and emit_final:
        out.final(book)
    if len(out):
        yield out.record_batch()


def keyed_rows(requests: DataFrame, restored: DataFrame | None = None) -> DataFrame:
    """Checked requests plus optional restored books, in the keyed input layout.

    ``requests`` has REQUEST columns and ``reject_stage`` / ``reject_reason``
    (``validate.engine_checked``); refused rows ride along as phase -1.
    ``restored`` is a flat book table: header rows with ``phase = 0`` and
    resting-order rows with ``phase = 1`` (see ``operators.snapshots.restore_rows``).
    """
    refused = F.col("reject_reason").isNotNull()
    req = requests.select(
        "symbol",
        F.when(refused, F.lit(PHASE_REJECT)).otherwise(F.lit(PHASE_REQUEST)).alias("phase"),
        F.col("partition").cast("int"),
        F.col("offset").cast("long"),
        "request_id",
        F.col("received_at").cast("timestamp_ntz"),
        F.col("side").cast("int"),
        *[(to_bits(F.col(c)) if is_wide(requests, c) else F.col(c).cast("long")).alias(c) for c in ("price", "size")],
        F.lit(None).cast("long").alias("seq"),
        F.col("reject_stage").alias("stage"),
        F.col("reject_reason").alias("reason"),
    )
    if restored is None:
        return req
    return restored.select(*KEYED_COLUMNS).unionByName(req)


def match_keyed(keyed: DataFrame, num_partitions: int | None = None, cadence: Cadence | None = None,
                emit_final: bool = True) -> DataFrame:
    """Shuffle keyed rows by symbol, sort each partition, run the books."""
    spark = keyed.sparkSession
    ship_package(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cadence = cadence or Cadence()

    def run(batches):
        return match_sorted(batches, cadence, emit_final)

    # Book rows are hashed by symbol; refused rows by offset, so that a flood of
    # bad requests (often with an empty or NULL symbol) spreads over all tasks.
    lane = F.when(F.col("phase") == PHASE_REJECT, F.lit(0)).otherwise(F.lit(1))
    route = F.when(F.col("phase") == PHASE_REJECT, F.col("offset").cast("string")).otherwise(F.col("symbol"))
    return (keyed.withColumn("_lane", lane)
            .repartition(n, route)
            .sortWithinPartitions(*SORT_COLUMNS)
            .drop("_lane")
            .mapInArrow(run, TAGGED))
