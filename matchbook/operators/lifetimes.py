"""Books read back from the order log.

The order log has one row for each change of a resting order (schemas.ORDER_STEP): from book sequence number
``book_seq`` on, the order's resting size is ``size``; 0 says that it left. So an order's life is a row of intervals
``[book_seq, next book_seq)``, and the book at any sequence number is the set of intervals that hold it. The log grows
with the orders and their fills, not with the depth of the books or the number of snapshots.

A run that resumes from a snapshot writes the steps after it once more, with the same values: equal rows are one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.render import order_json
from ..schemas import (KIND_STEP, ORDER_STEP_COLUMNS, SIDE_BUY, SIDE_NAMES, SNAPSHOT, SNAPSHOT_COLUMNS,
                       SNAPSHOT_HEADER_COLUMNS)
from ..session import new_folder, ship_package

#: Fields of an order in a snapshot message, and the column of its JSON.
FIELDS, TEXT = ["id", "price", "size", "seq"], "_text"
ORDER_COLUMNS = ["side", "id", "price", "size", "seq"]
BOOK_COLUMNS = ["symbol", "orderbook_seq", "last_offset", "created_at", "trades_partition", *ORDER_COLUMNS]
#: Orders of a batch of whole books that is given back, unless one book has more; rows of books, unless one life has more.
ORDERS_AT_ONCE = 1 << 14
ROWS_AT_ONCE = 1 << 13
#: Bins of sequence numbers that have the least width; beyond them, bins from a number to its double.
EVEN_BINS, BINS_PER_DOUBLING = 8, 4


def order_log(tagged: DataFrame) -> DataFrame:
    """The order log of a matching run."""
    return tagged.filter(F.col("kind") == KIND_STEP).select(
        *[F.col("request_id").alias("id") if c == "id" else F.col(c) for c in ORDER_STEP_COLUMNS])


def lifetimes(steps: DataFrame) -> DataFrame:
    """symbol, side, id, price, seq, size, from_seq, to_seq (exclusive; NULL: still resting at the end of the log).

    The window runs over the steps of one order, however many orders a symbol has. They are dealt by order, which serves
    to find equal steps as well: the log is shuffled once.
    """
    own = Window.partitionBy("symbol", "seq").orderBy("book_seq")
    dealt = steps.select(*ORDER_STEP_COLUMNS).repartition("symbol", "seq")
    spans = dealt.distinct().withColumn("to_seq", F.lead("book_seq").over(own))
    return spans.filter("size > 0").withColumnRenamed("book_seq", "from_seq")


def _bin(seq: Column, width: int) -> Column:
    """The bin of a sequence number: first bins of ``width``, then bins that widen with the numbers in them.

    What rests at the begin of a bin stands in it once more; it may grow with the log, as the bins do. So lives are
    repeated a number of times that does not grow with the log: bins of one width would repeat them as often as there are bins.
    """
    even = EVEN_BINS * width
    wide = F.floor(F.log2(seq / even) * BINS_PER_DOUBLING) + EVEN_BINS
    return F.when(seq < even, F.floor(F.greatest(seq, F.lit(0)) / width)).otherwise(wide).cast("bigint")


def _binned(headers: DataFrame, steps: DataFrame, width: int) -> DataFrame:
    """symbol, _bin, ORDER_COLUMNS, from_seq, to_seq: every life up to its symbol's last header, once for each bin that
    it reaches.

    A symbol's last header is written and read back, a small row for each symbol: so its size is known before the join is
    planned, and where it is small the lives are not shuffled by symbol.
    """
    path = new_folder(headers.sparkSession, "last-headers")
    headers.groupBy("symbol").agg(F.max("orderbook_seq").alias("_last")).write.parquet(path)
    last = headers.sparkSession.read.schema("symbol string, _last bigint").parquet(path)
    spans = lifetimes(steps).join(last, "symbol").filter(F.col("from_seq") <= F.col("_last"))
    end = F.least(F.coalesce(F.col("to_seq") - 1, F.col("_last")), F.col("_last"))
    binned = spans.withColumn("_bin", F.explode(F.sequence(_bin(F.col("from_seq"), width), _bin(end, width))))
    return binned.select("symbol", "_bin", *ORDER_COLUMNS, "from_seq", "to_seq")


def books_at(headers: DataFrame, steps: DataFrame, width: int = 1024) -> DataFrame:
    """The resting orders of every snapshot header, one row each (BOOK_COLUMNS); an empty book keeps one row with
    NULL order fields.

    Lives and headers are dealt by (symbol, bin) and sorted, the headers of a bin in front of its lives. A task holds the
    headers of one bin and gives each life's rows as it passes, so it holds no book, and neither a symbol nor a long life
    is compared with every header. Its rows are those of the result (here and in ``whole_books`` whole books are written
    out); they come life by life, so that those of an order stand together and take little room in a columnar file.
    """
    spark = headers.sparkSession
    ship_package(spark)
    lives = _binned(headers, steps, width).withColumn("_phase", F.lit(1))
    heads = headers.select(*SNAPSHOT_HEADER_COLUMNS, _bin(F.col("orderbook_seq"), width).alias("_bin"), F.lit(0).alias("_phase"))
    rows = heads.unionByName(lives, allowMissingColumns=True)
    schema = T.StructType([T.StructField(c, rows.schema[c].dataType) for c in BOOK_COLUMNS])
    dealt = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "symbol", "_bin")
    return dealt.sortWithinPartitions("symbol", "_bin", "_phase", "orderbook_seq", "from_seq", "seq").mapInArrow(_rows_of_bins, schema)


def _runs(batches):
    """((symbol, bin), phase, rows) of stretches of sorted rows that are alike in these."""
    for rb in batches:
        if not rb.num_rows:
            continue
        keys = [rb.column(c) for c in ("symbol", "_bin", "_phase")]
        codes = [k.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False) for k in keys]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in codes], axis=0)) + 1
        edges = [0, *cuts.tolist(), rb.num_rows]
        for i, j in zip(edges, edges[1:]):
            yield (keys[0][i].as_py(), keys[1][i].as_py()), keys[2][i].as_py(), rb.slice(i, j - i)


def _rows_of_bins(batches):
    """mapInArrow body of ``books_at``."""
    group, heads = None, None
    for key, phase, part in _runs(batches):
        if key != group:
            if heads is not None:
                yield from heads.bare()
            group, heads = key, _Heads()
        if phase == 0:
            heads.add(part)
        else:
            yield from heads.rows(part)
    if heads is not None:
        yield from heads.bare()


class _Heads:
    """The headers of one bin, ascending by sequence number, and how many lives hold each."""

    __slots__ = ("parts", "table", "seqs", "held")

    def __init__(self):
        self.parts, self.table = [], None

    def add(self, part: pa.RecordBatch) -> None:
        self.parts.append(part)

    def close(self) -> None:
        if self.table is None and self.parts:
            self.table = pa.Table.from_batches(self.parts).combine_chunks().to_batches()[0]
            # headers without a number (sorted to the front) hold nothing
            self.seqs = self.table.column("orderbook_seq").fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)
            self.held = np.zeros(len(self.seqs) + 1, np.int64)

    def rows(self, lives: pa.RecordBatch):
        """A row for each life and header that holds it, life by life."""
        self.close()
        if self.table is None:
            return
        first = np.searchsorted(self.seqs, lives.column("from_seq").to_numpy(zero_copy_only=False))
        end = np.searchsorted(self.seqs, lives.column("to_seq").fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False))
        at = np.flatnonzero(end > first)
        first, end = first[at], end[at]
        self.held += np.bincount(first, minlength=len(self.held)) - np.bincount(end, minlength=len(self.held))
        n = end - first
        total = np.cumsum(n)
        i = 0
        while i < len(at):
            before = total[i] - n[i]
            j = max(i + 1, int(np.searchsorted(total, before + ROWS_AT_ONCE, "right")))
            k = n[i:j]
            head = np.arange(total[j - 1] - before) + np.repeat(first[i:j] - (total[i:j] - k - before), k)
            yield self.joined(pa.array(head), lives, pa.array(np.repeat(at[i:j], k)))
            i = j

    def bare(self):
        """The headers that no life holds."""
        self.close()
        if self.table is not None:
            found = np.flatnonzero(np.cumsum(self.held)[:-1] == 0)
            if len(found):
                yield self.joined(pa.array(found), self.table, pa.array(found))

    def joined(self, head: pa.Array, orders: pa.RecordBatch, life: pa.Array) -> pa.RecordBatch:
        columns = [orders.column(c).take(life) if c in ORDER_COLUMNS else self.table.column(c).take(head) for c in BOOK_COLUMNS]
        return pa.RecordBatch.from_arrays(columns, names=BOOK_COLUMNS)


def whole_books(headers: DataFrame, steps: DataFrame, lane: Column | None = None, lanes: int = 1, width: int = 1024,
                texts: bool = False) -> DataFrame:
    """Every snapshot header with its orders in two arrays, in priority order (SNAPSHOT columns).

    Lives and headers are dealt by (symbol, bin) and sorted, a header behind the lives of its bin; the task picks each
    header's orders from those lives. So what is shuffled is a life for each bin it reaches, not an order for each
    snapshot that holds it, and a task holds the lives of one bin: a book and its changes in that bin.
    ``lane`` (0 .. ``lanes`` - 1, by symbol) keeps rows of two lanes out of one task; a bin's books come out in order.
    ``texts``: ``bids`` and ``asks`` as texts for ``snapshot_json``, each life written as JSON once for all books that hold it.
    """
    spark = headers.sparkSession
    ship_package(spark)
    each = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // lanes))
    bid = F.col("side") == SIDE_NAMES[SIDE_BUY]
    lives = _binned(headers, steps, width).select(
        "symbol", "_bin", F.lit(0).alias("_phase"), (~bid).alias("_ask"), F.when(bid, -F.col("price")).otherwise(F.col("price")).alias("_rank"),
        *FIELDS, "from_seq", "to_seq")
    heads = headers.select(*SNAPSHOT_HEADER_COLUMNS, _bin(F.col("orderbook_seq"), width).alias("_bin"), F.lit(1).alias("_phase"))
    rows = lives.unionByName(heads, allowMissingColumns=True)
    place = F.coalesce(lane if lane is not None else F.lit(0), F.lit(0)) * each + F.pmod(F.xxhash64("symbol", "_bin"), F.lit(each))
    dealt = (rows.repartitionById(lanes * each, place.cast("int"))
             .sortWithinPartitions("symbol", "_bin", "_phase", "_ask", "_rank", "seq", "orderbook_seq").drop("_rank"))
    if not texts:
        return dealt.mapInArrow(_books_of_bins, SNAPSHOT).select(*SNAPSHOT_COLUMNS)
    written = F.when(F.col("_phase") == 0, order_json(*[F.col(c) for c in FIELDS]))
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in ("bids", "asks") else f for f in SNAPSHOT.fields])
    return dealt.withColumn(TEXT, written).drop(*FIELDS).mapInArrow(_books_of_bins, schema).select(*SNAPSHOT_COLUMNS)


def _books_of_bins(batches):
    """mapInArrow body of ``whole_books``."""
    group, held, lives = None, [], None
    for key, phase, part in _runs(batches):
        if key != group:
            group, held, lives = key, [], None
        if phase == 0:
            held.append(part)
            continue
        if lives is None:
            lives = pa.Table.from_batches(held, part.schema).combine_chunks()
        yield from _picked(part, lives)


def _picked(heads: pa.RecordBatch, lives: pa.Table):
    """SNAPSHOT rows of ``heads``: each with the lives that hold its sequence number, which stand in priority order."""
    begin = lives["from_seq"].to_numpy()
    end = lives["to_seq"].fill_null(np.iinfo(np.int64).max).to_numpy()
    ask = lives["_ask"].to_numpy()
    texts = TEXT in lives.column_names
    fields = [TEXT] if texts else FIELDS
    orders = {c: lives[c].combine_chunks() if lives.num_rows else pa.array([], lives.schema.field(c).type) for c in fields}
    n_bids = int(np.count_nonzero(~ask))  # bids stand first
    seqs = heads.column("orderbook_seq").to_numpy(zero_copy_only=False)
    first, sides, total = 0, ([], []), 0
    for k, seq in enumerate(seqs):
        at = np.flatnonzero((begin <= seq) & (seq < end))
        cut = int(np.searchsorted(at, n_bids))
        sides[0].append(at[:cut])
        sides[1].append(at[cut:])
        total += len(at)
        if total < ORDERS_AT_ONCE and k + 1 < len(seqs):
            continue
        lists = []
        for found in sides:
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32))
            index = pa.array(np.concatenate(found))
            taken = [orders[c].take(index) for c in fields]
            if texts:
                lists.append(pc.binary_join(pa.ListArray.from_arrays(offsets, taken[0]), ","))
            else:
                lists.append(pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(taken, names=fields)))
        part = heads.slice(first, k + 1 - first)
        columns = [part.column(c) if c not in ("bids", "asks") else lists[c == "asks"] for c in SNAPSHOT_COLUMNS]
        yield pa.RecordBatch.from_arrays(columns, names=SNAPSHOT_COLUMNS)
        first, sides, total = k + 1, ([], []), 0


def books_of_latest(headers: DataFrame, steps: DataFrame) -> DataFrame:
    """As ``books_at``, for headers with one row for each symbol: an order's last step up to its symbol's header.

    Headers are narrow and one to a symbol; the aggregate by order is partial, so steps are shuffled as one row for
    each order, and no row holds a whole book.
    """
    heads = headers.select(F.col("symbol").alias("_symbol"), F.col("orderbook_seq").alias("_at"))
    before = steps.join(heads, (F.col("symbol") == F.col("_symbol")) & (F.col("book_seq") <= F.col("_at")))
    state = before.groupBy("symbol", "seq").agg(F.max(F.struct("book_seq", "size", "side", "id", "price")).alias("s"))
    resting = state.filter("s.size > 0").select(F.col("symbol").alias("_symbol"), "seq", "s.side", "s.id", "s.price", "s.size")
    return headers.join(resting, F.col("symbol") == F.col("_symbol"), "left").select(*BOOK_COLUMNS)
