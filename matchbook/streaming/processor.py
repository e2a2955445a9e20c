"""Keyed stateful matching for Structured Streaming (``transformWithStateInPandas``).

State per symbol (RocksDB state store):
  * ``meta``   value state: book seq, last offset, partition, orders since the last snapshot, receive-time interval,
               whether the book changed since the last snapshot, and the prices of its levels;
  * ``levels`` map state: (side, price) -> the orders that rest at that price, in arrival order.

A micro-batch replays the key's rows in (partition, offset) order through the shared ``Book``. A level is read when an
order reaches its price, and only levels that changed are written back, so what a micro-batch reads and writes follows
the levels its orders touch, not the depth of the book. Snapshots are headers (the order log holds their orders), so they
don't read the book either. Offsets at or below the stored last offset are redeliveries: they come back as refused rows,
which also makes restore-then-replay safe.
"""

from __future__ import annotations

from typing import Iterator

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.unsigned import signed, unsigned
from ..operators.matching import PHASE_BOOK, Book, Cadence, TaggedRows, _micros, apply_requests, unsigned_values
from ..schemas import SIDE_BUY, SIDE_SELL

# Grouping key is (lane, key): lane 0 carries refused rows, spread over
# REJECT_KEYS keys by offset and passed through without state; lane 1 is keyed
# by symbol and holds the books.
LANE_REFUSED, LANE_BOOK = 0, 1
REJECT_KEYS = 1024

META_SCHEMA = ("seq long, last_offset long, partition int, since_snapshot int, interval_no long, changed boolean, "
               "bids array<long>, asks array<long>")
LEVEL_KEY = "side int, price long"
LEVEL_SCHEMA = "seqs array<long>, ids array<string>, sizes array<long>"


def _int(x):
    return None if x is None or pd.isna(x) else int(x)


class BookProcessor(StatefulProcessor):
    def __init__(self, cadence: Cadence | None = None, snapshot_interval_ms: int = 0):
        self.cadence = cadence or Cadence()
        self.snapshot_interval_ms = int(snapshot_interval_ms or 0)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.meta = handle.getValueState("meta", META_SCHEMA)
        self.levels = handle.getMapState("levels", LEVEL_KEY, LEVEL_SCHEMA)

    # -- state <-> book -------------------------------------------------------
    def _fetch(self, side: int, price: int) -> list:
        seqs, ids, sizes = self.levels.getValue((side, signed(price)))
        return [[int(s), i, unsigned(int(q))] for s, i, q in zip(seqs, ids, sizes)]

    def _load(self, symbol: str) -> tuple[Book, bool]:
        """The stored book, whose levels are fetched when they are reached, and the changed-since-snapshot flag."""
        book = Book(symbol, fetch=self._fetch)
        meta = self.meta.get()
        if meta is None:
            return book, False
        seq, last_offset, partition, since, interval, changed, bids, asks = meta
        book.seq, book.last_offset, book.partition = int(seq), int(last_offset), _int(partition)
        book.since_snapshot, book.interval = int(since or 0), _int(interval)
        book.add_prices(SIDE_BUY, [unsigned(int(p)) for p in bids])
        book.add_prices(SIDE_SELL, [unsigned(int(p)) for p in asks])
        return book, bool(changed)

    def _store_meta(self, book: Book, changed: bool) -> None:
        self.meta.update((book.seq, book.last_offset, book.partition, book.since_snapshot, book.interval, changed,
                          *([signed(p) for p in sorted(book.prices[side])] for side in (SIDE_BUY, SIDE_SELL))))

    def _store(self, book: Book, had: tuple[set, set], changed: bool) -> None:
        """Write the levels that changed; ``had``: the prices that state holds."""
        for side, price in sorted(book.touched):
            if price in book.prices[side]:
                seqs, ids, sizes = (list(x) for x in zip(*book.levels[side][price]))
                self.levels.updateValue((side, signed(price)), (seqs, ids, [signed(q) for q in sizes]))
            elif price in had[side]:
                self.levels.removeKey((side, signed(price)))
        self._store_meta(book, changed)

    # -- callbacks ------------------------------------------------------------
    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        lane, symbol = key[0], key[1]
        pdf = pd.concat(list(rows), ignore_index=True)
        if lane == LANE_REFUSED:
            out = TaggedRows()
            for r in pdf.itertuples(index=False):
                out.reject(r.symbol, _int(r.partition), int(r.offset), None, r.request_id, r.reject_reason, r.reject_stage)
            yield out.frame()
            return
        pdf = pdf.sort_values(["partition", "offset"], kind="stable")
        book, changed = self._load(symbol)
        seen, had = book.last_offset, tuple(set(p) for p in book.prices)
        out = TaggedRows()
        apply_requests(book, out, zip(pdf["partition"].astype("int64").tolist(),
                                      pdf["offset"].astype("int64").tolist(), pdf["request_id"].tolist(),
                                      _micros(pdf["received_at"]), pdf["side"].astype("int64").tolist(),
                                      *(unsigned_values(pdf[c].astype("int64").tolist()) for c in ("price", "size"))),
                       self.cadence)
        if book.last_offset != seen:
            changed = book.since_snapshot > 0 or not self.cadence.every
            self._store(book, had, changed)
        if self.snapshot_interval_ms > 0 and changed and next(iter(self.handle.listTimers()), None) is None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.snapshot_interval_ms)
        if len(out):
            yield out.frame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Interval snapshot: emitted only if the book changed since the last snapshot."""
        book, changed = self._load(key[1])
        if changed:
            out = TaggedRows()
            out.snapshot(book, int(timerValues.getCurrentProcessingTimeInMs()) * 1000)
            book.since_snapshot = 0
            self._store_meta(book, False)
            yield out.frame()

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """Rebuild the book from restore rows (header phase 0, resting orders phase 1)."""
        book = Book(key[1])
        for row in initialState.sort_values("seq", kind="stable").itertuples(index=False):
            if int(row.phase) == PHASE_BOOK:
                book.seq, book.last_offset, book.partition = int(row.seq), int(row.offset), _int(row.partition)
                book.since_snapshot, book.interval = _int(row.size) or 0, _int(row.price)
            else:
                book.rest(int(row.side), row.request_id, unsigned(int(row.price)), unsigned(int(row.size)), int(row.seq))
        self._store(book, (set(), set()), False)

    def close(self) -> None:
        pass
