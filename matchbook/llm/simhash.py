"""SimHash near-duplicate components by multi-index hashing.

A text's words (A-Z lower-cased, cut at ASCII white space) give its 4-word shingles, repeats included, joined by one
space (all its words where it has fewer); h is a shingle's XXH64 with seed 42. A bit of the fingerprint is 1 if it
is set in more than half of the h; a text without words has fingerprint 0. Fingerprints that differ in at most
``RADIUS`` = 4 bits are linked; components are the connected sets of documents.

Search works on distinct fingerprints (equal ones are counted and hold the least doc_id, map side first). A
fingerprint is cut into segments of 21, 21 and 22 bits. Of two fingerprints within 4 bits, the first or the second
segment differs in at most one bit or the third is equal; so every fingerprint stands in the three segment tables
under its own values, and asks the first two for the values in the Hamming ball of radius 1 around its own. Of two
values that differ in one bit only the one with a 0 there asks. What meets under a table value is compared in full.
Rows of a table value lie in one task, sorted, and are compared in pieces of ``PAIRS``; of the links found the task
gives back only a forest (fan-out ``FAN``), whose components are the same.

A table value that is shared by more than ``CROWD`` fingerprints is not compared pair by pair. Two fingerprints within
4 bits have a midpoint within 2 bits of both, and any two that share such a midpoint are within 4: all values of the
ball of radius 2 (2,081) around each fingerprint of a crowd are grouped, and each group is linked to its least member.
That costs rows in proportion to the crowd, whole or not in one task, and finds the same components.

Results, one row for each row of ``docs``: doc_id, fingerprint (16 hex digits), component_id (least doc_id of the
component), links (other fingerprints that a link of the forest joins to this one). Defined results: null and blank texts
have fingerprint 0 and are linked like any other; a null doc_id is never the least one; a component of null ids alone
has a null id; repeated rows are results of their own; an empty table gives an empty table. Extra columns of any
name are ignored. Texts of any length are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchbook.llm.common import kept, looked_up, prepared, released
from matchbook.llm.near_dedup import components

WORDS = 4
SEED = 42
RADIUS = 4
#: Segments as (lowest bit, bits, radius of the ball that is asked for).
SEGMENTS = ((0, 21, 1), (21, 21, 1), (42, 22, 0))
#: Shingles counted at once, pairs compared at once, links of one fingerprint in a forest.
PIECE = 1 << 16
PAIRS = 1 << 17
FAN = 32
#: Fingerprints under one table value that are still compared pair by pair.
CROWD = 1 << 14
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def fingerprint(text: str | None) -> int:
    """The 64-bit fingerprint of a text."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    whole = b" ".join(words)
    ends = np.cumsum(np.array([len(w) + 1 for w in words])) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    span = min(WORDS, len(words))
    begins, ends = begins[: len(words) - span + 1].tolist(), ends[span - 1 :].tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, len(begins), PIECE):
        part = zip(begins[at : at + PIECE], ends[at : at + PIECE], strict=True)
        h = np.array([xxh64_intdigest(whole[a:b], SEED) for a, b in part], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(begins), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed number) of each row; one scan."""

    def run(batches):
        try:
            for batch in batches:
                found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])
        finally:
            released()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, fp bigint")


def table_rows(fps: DataFrame) -> DataFrame:
    """segment, value, fp, own: where a fingerprint stands (own) and what it asks for."""
    out = []
    for i, (low, bits, radius) in enumerate(SEGMENTS):
        value = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << bits) - 1))
        out.append(F.struct(F.lit(i).alias("segment"), value.alias("value"), F.lit(True).alias("own")))
        for bit in range(bits if radius else 0):
            zero = value.bitwiseAND(F.lit(1 << bit)) == 0
            out.append(F.when(zero, F.struct(F.lit(i).alias("segment"), value.bitwiseOR(F.lit(1 << bit)).alias("value"), F.lit(False).alias("own"))))
    rows = fps.select("fp", F.explode(F.array_compact(F.array(*out))).alias("x"))
    return rows.select("x.segment", "x.value", "fp", "x.own")


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links with the same components as the links a-b: at most one for each node, up to a node of the same component,
    ``FAN`` of them to one node."""
    nodes, code = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = code[: len(a)], code[len(a) :]
    root = np.arange(len(nodes))
    while True:  # the least root of the neighbours, then the root's root
        low = root.copy()
        np.minimum.at(low, x, root[y])
        np.minimum.at(low, y, root[x])
        np.minimum.at(low, root, low)
        low = low[low]
        if (low == root).all():
            break
        root = low
    order = np.lexsort((np.arange(len(nodes)), root))
    first = np.searchsorted(root[order], root[order])
    rank = np.arange(len(nodes)) - first
    up = first + (rank - 1) // FAN
    child = rank > 0
    return nodes[order[child]], nodes[order[up[child]]]


def met(value: np.ndarray, fp: np.ndarray, own: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Forest of the links among rows sorted by (value, own first): each own row with the rows after it in its value."""
    n = len(value)
    end = np.searchsorted(value, value, "right")
    count = np.where(own, end - np.arange(n) - 1, 0)
    found_a, found_b, size = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    total = np.concatenate([[0], np.cumsum(count)])
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS, "right")) - 1)
        left = np.repeat(np.arange(at, to), count[at:to])
        right = left + 1 + np.arange(len(left)) - np.repeat(total[at:to] - total[at], count[at:to])
        near = (np.bitwise_count(fp[left] ^ fp[right]) <= radius) & (fp[left] != fp[right])
        a, b = forest(fp[left[near]].view(np.int64), fp[right[near]].view(np.int64))
        found_a.append(a)
        found_b.append(b)
        size += len(a)
        if size > PAIRS:  # no more links are held than pairs are compared at once
            found_a, found_b = ([x] for x in forest(np.concatenate(found_a), np.concatenate(found_b)))
            size = 0
        at = to
    return forest(np.concatenate(found_a), np.concatenate(found_b))


def compared(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b: a forest of the links within each table value of the rows (segment, value, fp, own)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select((F.col("value") * len(SEGMENTS) + F.col("segment")).alias("value"), "fp", "own").repartition(n, "value")

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if held[0].column(0)[0].as_py() == batch.column(0)[batch.num_rows - 1].as_py() or sum(x.num_rows for x in held) < PIECE:
                continue
            yield from links_of(held, False)
        if held:
            yield from links_of(held, True)

    def links_of(held: list[pa.RecordBatch], last: bool):
        t = pa.Table.from_batches(held)
        value = t.column(0).to_numpy()
        stop = len(value) if last else int(np.searchsorted(value, value[-1]))  # the last value may go on
        fp = t.column(1).to_numpy()[:stop].view(np.uint64)
        own = t.column(2).to_numpy()[:stop].astype(bool)
        rest = t.slice(stop).combine_chunks().to_batches()
        held[:] = rest
        a, b = met(value[:stop], fp, own, radius)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.sortWithinPartitions("value", F.desc("own"), "fp").mapInArrow(run, "a bigint, b bigint").distinct()


def ball(radius: int = RADIUS) -> list[int]:
    """All signed 64-bit numbers with at most ``radius`` / 2 bits set."""
    one = [1 << i for i in range(64)]
    two = [x | y for i, x in enumerate(one) for y in one[i + 1 :]] if radius >= 4 else []
    return [int(np.uint64(x).view(np.int64)) for x in [0, *one, *two]]


def by_midpoint(crowd: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b: links that join all fingerprints (column fp) with a common midpoint to the least of them."""
    masks = F.array(*[F.lit(x).cast("bigint") for x in ball(radius)])
    spread = crowd.select("fp", F.explode(F.transform(masks, lambda m: F.col("fp").bitwiseXOR(m))).alias("mid"))
    least = spread.groupBy("mid").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1").select("mid", "b")
    # a crowd's midpoints are many and even: the group of one midpoint has 2,081 members at most
    return spread.join(least, "mid").filter("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def linked(fps: DataFrame, radius: int = RADIUS, crowd: int = CROWD) -> DataFrame:
    """a, b: links among the distinct fingerprints (column fp), with all components of those within ``radius`` bits."""
    rows = kept(table_rows(fps), "simhash-tables")
    sizes = rows.groupBy("segment", "value").agg(F.count("*").alias("n"), F.count_if("own").alias("own"))
    sizes = kept(sizes.filter("n > 1 and own > 0"), "simhash-sizes")
    normal = rows.join(sizes.filter(F.col("n") <= crowd).select("segment", "value"), ["segment", "value"])
    found = kept(compared(normal, radius), "simhash-links")
    many = sizes.filter(F.col("n") > crowd).select("segment", "value")
    if many.limit(1).count():
        crowded = kept(rows.join(many, ["segment", "value"]).select("fp").distinct(), "simhash-crowd")
        found = found.unionByName(kept(by_midpoint(crowded, radius), "simhash-links"))
    return found


def simhash_dedup(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, fingerprint, component_id, links: one row for each row of ``docs``."""
    prepared(docs.sparkSession)
    rows = kept(fingerprints(docs), "simhash")
    fps = kept(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "simhash-distinct")
    found = linked(fps.select("fp"), crowd=crowd)
    classes = components(found.filter("a <> b"))
    degree = found.select(F.explode(F.array("a", "b")).alias("fp")).groupBy("fp").agg(F.count("*").alias("links"))
    named = fps.join(classes.withColumnRenamed("member", "fp"), "fp", "left").join(degree, "fp", "left")
    named = kept(named.select("fp", "least", "copies", F.coalesce("class", "fp").alias("class"), F.coalesce("links", F.lit(0)).alias("links")), "simhash-classes")
    least = named.groupBy("class").agg(F.min("least").alias("component_id"))
    total = rows.count()
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    found = kept(named.join(least, "class").select("fp", "copies", "component_id", "links"), "simhash-components")
    return looked_up(rows, found, "fp", "copies", total).select("doc_id", hexed, "component_id", "links")
