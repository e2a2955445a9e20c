"""Benchmark decontamination by the q-gram lemma over diagonal bands, verified by banded alignment.

A document holds a benchmark item if some region of its text is within ``floor(EDIT_RATE * m)`` edits
(insertions, deletions, substitutions) of the whole item of ``m`` characters. Texts are compared as UTF-8
bytes ("characters" below) with A-Z in lower case and runs of ASCII white space as one space. Such a region shares at least ``m - q + 1 - k q`` q-grams with
the item, all within ``k`` diagonals of one another. So for every text position whose q-gram an item has,
the diagonal (text position less item position) is counted in two overlapping bands of ``2 (k + 1)``
diagonals; bands that reach the bound are aligned by dynamic programming within the band. What is counted are the
text positions of a band. Positions of one gram in an item that lie within ``k`` of one another fall into the same
bands, so they are one entry of the index: a text position meets at most about ``1 / EDIT_RATE`` entries of an item,
also where text and item repeat themselves, and hits are laid out ``PAIRS`` at a time.

The benchmark's distinct (item_id, text) rows are cut by hash into blocks of about ``BLOCK_CHARS`` characters;
the index of one block is sent to the tasks at a time (its size is bounded by the block), and every document is
scanned once for each block. There is no shuffle of documents. Every text of an item_id is searched; the best
region of an item_id is taken in the task, and over the blocks by an aggregate of the matches where an item_id
has several texts and there are several blocks.

Items under ``MIN_CHARS`` characters have too few grams to be told from chance with edits: they are found where they
stand word for word (no letter, digit or byte of a non-ASCII character on either side).

Defined results: null or empty texts match nothing; null or blank items are in no document; repeated rows of either table are judged alike; different texts of one item_id
are all searched and the item_id is reported once for each document row, with its best region (least edits, then
begin, then end); items whose item_id is null are searched too and count as texts of one item_id, null; an empty
table on either side gives no matches. Extra columns of any name are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchbook.llm.common import prepared, text_blocks

#: Edits allowed for each character of an item.
EDIT_RATE = 0.1
#: Gram lengths; an item uses the longest with a bound of MIN_SHARED shared grams or more.
GRAMS = (8, 4)
MIN_SHARED = 3
MIN_CHARS = 12
#: Characters of benchmark text indexed at a time, and of documents scanned at a time.
BLOCK_CHARS = 1 << 20
SCAN_CHARS = 1 << 19
STRIDE = 1 << 16
TABLE_BITS = 20
MASK = (1 << 18) - 1
#: Hits laid out at once.
PAIRS = 1 << 20
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
LOWER[0x09:0x0E] = 0x20


def normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of texts in normal form, and where each text begins in them."""
    x = LOWER[data]
    space = x == 0x20
    keep = np.ones(len(x), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    return x[keep], np.concatenate([[0], np.cumsum(keep)])[offsets]


def normal_text(text: str | None) -> np.ndarray:
    data = np.frombuffer((text or "").strip().encode("utf-8", "surrogatepass"), np.uint8)
    return normal(data, np.array([0, len(data)]))[0]


def grams(x: np.ndarray, q: int) -> np.ndarray:
    """32-bit hash of every q consecutive bytes (q a power of two): a polynomial, by doubling."""
    base, have, h = 0x9E3779B1, 1, x.astype(np.uint32) + np.uint32(1)
    while have < q:
        h = h[:-have] * np.uint32(base) + h[have:]
        base, have = base * base & 0xFFFFFFFF, have * 2
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0xC2B2AE35)
    return h


def bound(m: int, k: int, q: int) -> int:
    return m - q + 1 - k * q


def align(item: np.ndarray, text: np.ndarray, low: int, width: int, most: int) -> tuple[int, int, int] | None:
    """(edits, begin, end in text) of the best alignment of the whole item to a region of ``text`` that stays on
    the diagonals low .. low + width - 1, or None above ``most`` edits. First end of the best ones."""
    far = np.int32(1 << 20)
    diagonal = np.arange(width, dtype=np.int32)
    at = low + np.arange(width)
    row = np.where((at >= 0) & (at <= len(text)), 0, far).astype(np.int32)
    begin = at.copy()  # where the region of each diagonal's best alignment begins
    for i in range(len(item)):
        at = at + 1  # end in text of each diagonal once the item's character i is read
        inside = (at >= 1) & (at <= len(text))
        same = np.zeros(width, bool)
        same[inside] = text[at[inside] - 1] == item[i]
        step = np.where(inside, row + ~same, far)
        skip = np.where(at[:-1] >= 0, row[1:] + 1, far)
        begin = np.append(np.where(skip < step[:-1], begin[1:], begin[:-1]), begin[-1:])
        step[:-1] = np.minimum(step[:-1], skip)
        step = step - diagonal
        least = np.minimum.accumulate(step)
        begin = begin[np.maximum.accumulate(np.where(step == least, diagonal, 0))]
        row = np.where((at >= 0) & (at <= len(text)), np.minimum(least + diagonal, far), far).astype(np.int32)
        if row.min() > most:
            return None
    best = int(row.argmin())
    return (int(row[best]), int(begin[best]), int(at[best])) if row[best] <= most else None


@dataclass
class GramIndex:
    """Items that use one gram length: a bit table of gram hashes, and each gram's entries (item, first and last
    position of a stretch of at most ``edits`` + 1)."""

    q: int
    ids: list[int]
    texts: list[np.ndarray]
    edits: np.ndarray
    need: np.ndarray
    slots: np.ndarray
    deepest: int
    keys: np.ndarray
    first: np.ndarray
    item: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @staticmethod
    def build(q: int, items: list[tuple[int, np.ndarray]], rate: float) -> GramIndex:
        texts = [t for _, t in items]
        edits = np.array([int(rate * len(t)) for t in texts], np.int64)
        need = np.array([bound(len(t), int(k), q) for t, k in zip(texts, edits, strict=True)], np.int64)
        h = [grams(t, q) for t in texts]
        flat = np.concatenate(h)
        item = np.repeat(np.arange(len(items)), [len(x) for x in h])
        position = np.concatenate([np.arange(len(x)) for x in h])
        order = np.lexsort((position, item, flat))
        flat, item, position = flat[order], item[order], position[order]
        # a gram's positions in an item, cut into cells of edits + 1 positions
        cell = position // (edits[item] + 1)
        new = np.ones(len(flat), bool)
        new[1:] = (flat[1:] != flat[:-1]) | (item[1:] != item[:-1]) | (cell[1:] != cell[:-1])
        at = np.flatnonzero(new)
        high = position[np.append(at[1:], len(flat)) - 1]
        flat, item, low = flat[at], item[at], position[at]
        keys, first = np.unique(flat, return_index=True)
        top = keys >> np.uint32(32 - TABLE_BITS)
        slots = np.full(1 << TABLE_BITS, -1, np.int32)
        slots[top[::-1]] = np.arange(len(keys), dtype=np.int32)[::-1]
        deepest = int(np.unique(top, return_counts=True)[1].max())
        return GramIndex(q, [i for i, _ in items], texts, edits, need, slots, deepest, keys, np.append(first, len(flat)), item, low, high)

    def plain(self) -> tuple:
        """The fields as built-in types and arrays: a broadcast is pickled by reference to classes, which workers may
        not have."""
        return tuple(getattr(self, f.name) for f in fields(self))

    def hits(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, key) of every gram of ``x`` that an item has."""
        at, slot = [], []
        for begin in range(0, len(x) - self.q + 1, STRIDE):
            h = grams(x[begin : begin + STRIDE + self.q - 1], self.q)
            s = self.slots[h >> np.uint32(32 - TABLE_BITS)]
            hit = np.flatnonzero(s >= 0)
            s, h = s[hit], h[hit]
            found = np.full(len(hit), -1)
            for _ in range(self.deepest):
                found = np.where(self.keys[s] == h, s, found)
                s = np.minimum(s + 1, len(self.keys) - 1)
            at.append(hit[found >= 0] + begin)
            slot.append(found[found >= 0])
        return (np.concatenate(at), np.concatenate(slot)) if at else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def bands(self, at: np.ndarray, slot: np.ndarray, text: np.ndarray) -> np.ndarray:
        """(text, item, band, position) of hits: every band that a hit's diagonals lie in (three at most for an entry)."""
        count = self.first[slot + 1] - self.first[slot]
        where = np.repeat(self.first[slot] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        item, text, at = self.item[where], np.repeat(text, count), np.repeat(at, count)
        wide = self.edits[item] + 1
        low, high = np.floor_divide(at - self.high[where], wide), np.floor_divide(at - self.low[where], wide)
        two = np.flatnonzero(high > low)
        rows = [np.stack([text, item, low, at]), np.stack([text, item, low - 1, at]), np.stack([text, item, high, at])[:, two]]
        return np.concatenate(rows, 1)

    def candidates(self, x: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Rows (text, item, band) whose band shares enough grams; bands count diagonals of ``x``."""
        at, slot = self.hits(x)
        text = np.searchsorted(begin, at, "right") - 1
        whole = at + self.q <= begin[text + 1]
        at, slot, text = at[whole], slot[whole], text[whole]
        total = np.concatenate([[0], np.cumsum(self.first[slot + 1] - self.first[slot])])
        edge = [0]
        while edge[-1] < len(at):  # runs of text positions with about PAIRS entries
            edge.append(max(edge[-1] + 1, int(np.searchsorted(total, total[edge[-1]] + PAIRS, "right")) - 1))
        runs = [slice(a, b) for a, b in zip(edge, edge[1:], strict=False)]
        # first by a hash of (item, band): a sieve that never undercounts
        mix = lambda rows: (rows[1] * 0x9E3779B1 + rows[2] * 0x85EBCA6B) & MASK
        size = np.zeros(MASK + 1, np.int64)
        laid = None
        for r in runs:
            laid = self.bands(at[r], slot[r], text[r])
            size += np.bincount(mix(laid), minlength=MASK + 1)
        # then exactly: the text positions that a band has, each once; runs hold different positions, so counts add up
        counts: dict[tuple[int, int, int], int] = {}
        for r in runs:
            rows = laid if len(runs) == 1 else self.bands(at[r], slot[r], text[r])
            rows = rows[:, size[mix(rows)] >= self.need[rows[1]]]
            rows = rows[:, np.lexsort(rows[::-1])]
            new = np.ones(rows.shape[1], bool)
            new[1:] = (rows[:, 1:] != rows[:, :-1]).any(0)
            rows = rows[:3, new]
            first = np.ones(rows.shape[1], bool)
            first[1:] = (rows[:, 1:] != rows[:, :-1]).any(0)
            first = np.flatnonzero(first)
            for key, n in zip(map(tuple, rows[:, first].T.tolist()), np.diff(np.append(first, rows.shape[1])).tolist(), strict=True):
                counts[key] = counts.get(key, 0) + n
        full = [key for key, n in counts.items() if n >= self.need[key[1]]]
        return np.array(sorted(full), np.int64).reshape(-1, 3)

    def verified(self, text: np.ndarray, item: int, low: int, high: int) -> tuple[int, int, int] | None:
        """(edits, begin, end) in ``text`` of the item's best region on the diagonals low .. high, and ``edits`` more on
        either side."""
        k, m, target = int(self.edits[item]), len(self.texts[item]), self.texts[item]
        left, right = max(0, low - k), min(len(text), high + m + k + 1)
        if right <= left:
            return None
        found = text[left:right].tobytes().find(target.tobytes())
        if found >= 0:
            return 0, left + found, left + found + m
        got = align(target, text[left:right], low - k - left, high - low + 2 * k + 2, k)
        return None if got is None else (got[0], left + got[1], left + got[2])

    def stretches(self, rows: np.ndarray):
        """(text, item, first band, last band): candidate bands of a text and item, neighbours taken together, so that a
        periodic text is aligned once and not band by band. ``rows`` are sorted."""
        if not len(rows):
            return
        new = np.ones(len(rows), bool)
        new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(1) | (rows[1:, 2] > rows[:-1, 2] + 2)
        at = np.flatnonzero(new)
        for a, b in zip(at.tolist(), np.append(at[1:], len(rows)).tolist(), strict=True):
            yield *rows[a].tolist(), int(rows[b - 1, 2])


@dataclass
class ShortItems:
    """Items that are found word for word."""

    ids: list[int]
    texts: list[bytes]

    def plain(self) -> tuple:
        return self.ids, self.texts

    def found(self, x: np.ndarray, begin: np.ndarray):
        """(text, item, begin, end) of the first place of each item in each text."""
        whole, edge = x.tobytes(), set(begin.tolist())
        for item, target in enumerate(self.texts):
            last, at = -1, whole.find(target)
            while at >= 0:
                end = at + len(target)
                text = int(np.searchsorted(begin, at, "right")) - 1
                clear = (at in edge or not WORD[x[at - 1]]) and (end == len(x) or end in edge or not WORD[x[end]])
                if text != last and clear and end <= begin[text + 1]:
                    yield text, item, at - int(begin[text]), end - int(begin[text])
                    last = text
                at = whole.find(target, at + 1)


def indexes(items: list[tuple[int, str]], rate: float) -> list[tuple]:
    """One index for each gram length in use and one of short items, as plain values."""
    chosen: dict[int, list] = {}
    short = []
    for item_id, raw in items:
        text = normal_text(raw)
        k = int(rate * len(text))
        q = next((q for q in GRAMS if bound(len(text), k, q) >= MIN_SHARED), None)
        if q is not None and len(text) >= MIN_CHARS:
            chosen.setdefault(q, []).append((item_id, text))
        elif len(text):
            short.append((item_id, text.tobytes()))
    found = [GramIndex.build(q, group, rate).plain() for q, group in sorted(chosen.items())]
    return found + ([ShortItems([i for i, _ in short], [t for _, t in short]).plain()] if short else [])


def opened(plain: list[tuple]) -> list[GramIndex | ShortItems]:
    return [ShortItems(*p) if len(p) == 2 else GramIndex(*p) for p in plain]


def scan(data: np.ndarray, offsets: np.ndarray, found: list[GramIndex | ShortItems]):
    """(text, item_id, edits, begin, end) of the best region of every item_id in every text."""
    x, begin = normal(data, offsets)
    whole: dict[tuple[int, int | None], tuple] = {}
    for index in found:
        if isinstance(index, ShortItems):
            for text, item, *place in index.found(x, begin):
                key, got = (text, index.ids[item]), (0, *place)
                whole[key] = min(got, whole.get(key, got))
            continue
        best: dict[tuple[int, int], tuple] = {}
        for text, item, band, last in index.stretches(index.candidates(x, begin)):
            if best.get((text, item), (1,))[0] == 0:
                continue
            wide = int(index.edits[item]) + 1
            low, high = band * wide - int(begin[text]), (last + 2) * wide - 1 - int(begin[text])
            got = index.verified(x[begin[text] : begin[text + 1]], item, low, high)
            if got and got < best.get((text, item), (1 << 20,)):
                best[text, item] = got
        for (text, item), got in best.items():
            key = text, index.ids[item]
            whole[key] = min(got, whole.get(key, got))
    for (text, item_id), got in whole.items():
        yield text, item_id, *got


def distinct_items(benchmark: DataFrame) -> DataFrame:
    """item_id, text: the distinct rows that have a text."""
    rows = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.filter(F.col("text").isNotNull()).distinct()


def blocks(benchmark: DataFrame, block_chars: int) -> int:
    total = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    return int(total // block_chars) + 1 if total else 0


def block_items(items: DataFrame, n: int, block: int) -> list[tuple[int | None, str]]:
    """The distinct items of one block, brought to the driver: about BLOCK_CHARS characters."""
    rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == block).orderBy("item_id", "text")
    return [(r.item_id, r.text) for r in rows.collect()]


def best_of_blocks(found: DataFrame) -> DataFrame:
    """The best region of each item_id over all blocks. A block gives one match for each item_id and document row;
    rows of equal id and text are told by their number in a block."""
    region = F.struct("edits", "begin", "end")
    best = found.groupBy("doc_id", "tkey", "item_id", "block").agg(F.min(region).alias("region"), F.count("*").alias("copies"))
    best = best.groupBy("doc_id", "tkey", "item_id").agg(F.min("region").alias("region"), F.max("copies").alias("copies"))
    best = best.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return best.select("doc_id", "item_id", "region.*")


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, item_id, edits, begin, end: for each item that a document holds, its best region (in the
    document's normal form)."""
    spark = prepared(docs.sparkSession)
    schema = "doc_id bigint, item_id bigint, edits int, begin bigint, end bigint"
    items = distinct_items(benchmark)
    n, out = blocks(items, block_chars), None
    spread = n > 1 and items.groupBy("item_id").count().filter("count > 1").limit(1).count() > 0
    text = F.col("text").cast("string")
    tkey = F.xxhash64(text) if spread else F.lit(0).cast("bigint")
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), tkey.alias("tkey"))
    for block in range(n):
        index = spark.sparkContext.broadcast(indexes(block_items(items, n, block), rate))

        def run(batches, index=index):
            found = opened(index.value)
            for batch in batches:
                rows = []
                for block, data, offsets in text_blocks([batch], "text", SCAN_CHARS):
                    keys = block.column(0), block.column(2)
                    rows += [(*(k[t].as_py() for k in keys), *rest) for t, *rest in scan(data, offsets, found)]
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 6
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                    names=["doc_id", "tkey", "item_id", "edits", "begin", "end"],
                )

        part = source.mapInArrow(run, "doc_id bigint, tkey bigint" + schema.removeprefix("doc_id bigint")).withColumn("block", F.lit(block))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], schema)
    return best_of_blocks(out) if spread else out.drop("tkey", "block")


def keep_clean(docs: DataFrame, benchmark: DataFrame, rate: float = EDIT_RATE, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents that hold no benchmark item, with their own columns; one scan for each block."""
    spark = prepared(docs.sparkSession)
    items = distinct_items(benchmark)
    n = blocks(items, block_chars)
    schema = docs.schema
    for block in range(n):
        index = spark.sparkContext.broadcast(indexes(block_items(items, n, block), rate))

        def run(batches, index=index):
            found = opened(index.value)
            for batch in batches:
                for block, data, offsets in text_blocks([batch], "text", SCAN_CHARS):
                    clean = np.ones(block.num_rows, bool)
                    clean[[t for t, *_ in scan(data, offsets, found)]] = False
                    yield block.filter(pa.array(clean))

        docs = docs.mapInArrow(run, schema)
    return docs
