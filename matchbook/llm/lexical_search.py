"""Ranked lexical search over an index whose documents are stratified by length.

Terms are the maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. With N documents that
hold a term, L terms in all, n terms of a document, df documents with a term and tf its count in one of them:

    w = floor(1000 ln((2N+2) / (2df+1)))        m = 100 - 25 + ((25 n N) div L)
    score = sum over the item's terms, repeats included, of w * ((1000000000 tf) div (1000 tf + 12 m))

Index. All documents of one normaliser m are a stratum, so within a stratum what a term adds depends on its tf alone.
A first scan counts document lengths, which fixes N, L and m; a second one counts each document's terms. Documents
are dealt by stratum; a stratum of more than ``BLOCK`` terms is split into blocks by row. The table holds, for each
(m, block): one row with the documents' ids (term null), and for each term and tf one row with the places of its
documents in that list. Every document and every term is in the index.

Search. The postings of the items' terms are taken out, with df and the largest tf of each term in each stratum. A
stratum's bound for an item is the score of a document that has every term at that tf. Each item first visits the
``FIRST`` strata with the highest bounds; the 20th best score found there is what others must reach: in a second
visit it skips every stratum with a lower bound, which loses nothing. In a block the impact of a posting list is
computed once per (term, tf) and added to the documents of the list. Tasks keep the best ``k`` of each item over
their blocks, a window then ranks them. Items are handled in groups of bounded size (terms, and items times strata),
which are broadcast.

Defined results: each row of ``items`` is an item, a row that repeats another gives the same results again; an item
that is null or has no term of the documents has no rows; each row of ``docs`` is a document; null texts hold no term;
equal scores go by ascending doc_id, null ids last; an empty table gives an empty table. Extra columns of any name
are ignored. Texts of any length are read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchbook.llm.common import kept, prepared, text_blocks

K = 20
#: Terms (with repeats) of a block's documents, about; bytes of text cut into terms at once.
BLOCK = 1 << 20
PIECE = 1 << 20
#: Strata that an item visits first.
FIRST = 4
#: Terms of a group of items, and items times strata, at most (8 bytes each in a broadcast).
GROUP_TERMS = 1 << 17
GROUP_BOUNDS = 1 << 20

IN_TERM = np.zeros(256, bool)
IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def term_edges(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mask of the bytes inside terms, where each term begins, index of each text's first term)."""
    inside = IN_TERM[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    starts = at[:-1][at[:-1] < len(data)]
    first[starts] |= inside[starts]
    begins = np.flatnonzero(first)
    return inside, begins, np.searchsorted(begins, at)


def terms_of(data: np.ndarray, at: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct terms; text, term and tf of each distinct term of each text, by text), from the bytes of texts."""
    inside, begins, edge = term_edges(data, at)
    letters = LOWER[data[inside]]
    place = np.cumsum(inside) - 1
    offsets = np.append(place[begins], len(letters)).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_string(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = words.dictionary_encode()
    text = np.repeat(np.arange(len(at) - 1), np.diff(edge))
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key, tf = np.unique(text * max(len(coded.dictionary), 1) + code, return_counts=True)
    return coded.dictionary, *np.divmod(key, max(len(coded.dictionary), 1)), tf


@dataclass
class Index:
    """``table``: m, block, term, tf, docs (places), ids (of the row without a term); N and L of the documents."""

    table: DataFrame
    n_docs: int
    n_terms: int


def _lengths(docs: DataFrame) -> DataFrame:
    """n, docs: how many documents have n terms."""

    def run(batches):
        for block, data, at in text_blocks(batches, "text", PIECE):
            _, _, edge = term_edges(data, at)
            n, docs = np.unique(np.diff(edge), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(n.astype(np.int64)), pa.array(docs.astype(np.int64))], names=["n", "docs"])

    return docs.select("text").mapInArrow(run, "n bigint, docs bigint").groupBy("n").agg(F.sum("docs").alias("docs"))


def _counted(docs: DataFrame, n_docs: int, n_terms: int, blocks: dict[int, int]) -> DataFrame:
    """m, block, doc_id, terms, tfs of every document that has a term."""
    sent = docs.sparkSession.sparkContext.broadcast(blocks)

    def run(batches):
        split = sent.value
        for block, data, at in text_blocks(batches, "text", PIECE):
            names, text, code, tf = terms_of(data, at)
            has = np.unique(text)
            edge = np.searchsorted(text, np.append(has, len(at))).astype(np.int32)
            n = np.add.reduceat(tf, edge[:-1]) if len(has) else np.zeros(0, np.int64)
            m = [75 + 25 * int(x) * n_docs // n_terms for x in n]
            row = block.column(1).to_numpy()[has]
            number = [r * 0x9E3779B97F4A7C15 % 2**64 % split.get(x, 1) for r, x in zip(row.tolist(), m, strict=True)]
            terms = names.take(pa.array(code)).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(m, pa.int64()), pa.array(number, pa.int64()), block.column(2).take(pa.array(has)),
                    pa.ListArray.from_arrays(pa.array(edge), terms), pa.ListArray.from_arrays(pa.array(edge), pa.array(tf.astype(np.int64))),
                ],
                names=["m", "block", "doc_id", "terms", "tfs"],
            )

    rows = docs.select("text", F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"))
    return rows.mapInArrow(run, "m bigint, block bigint, doc_id bigint, terms array<string>, tfs array<bigint>")


INDEX = "m bigint, block bigint, term string, tf bigint, docs array<int>, ids array<bigint>"


def _posted(m: int, block: int, held: list[pa.RecordBatch]):
    """The index rows of one block."""
    t = pa.Table.from_batches(held).combine_chunks()
    ids = t.column("doc_id").combine_chunks()
    lists = t.column("terms").combine_chunks()
    sizes = pc.list_value_length(lists).to_numpy()
    coded = lists.flatten().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    tf = t.column("tfs").combine_chunks().flatten().to_numpy()
    doc = np.repeat(np.arange(len(ids), dtype=np.int32), sizes)
    order = np.lexsort((doc, tf, code))
    code, tf, doc = code[order], tf[order], doc[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (tf[1:] != tf[:-1])
    at = np.flatnonzero(new)
    n = len(at)
    docs = pa.ListArray.from_arrays(pa.array(np.append(at, len(code)).astype(np.int32)), pa.array(doc))
    names = "m", "block", "term", "tf", "docs", "ids"
    whole = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    yield pa.RecordBatch.from_arrays(
        [pa.array([m]), pa.array([block]), pa.array([None], pa.string()), pa.array([0]), pa.array([[]], pa.list_(pa.int32())), whole], names=names
    )
    for a in range(0, n, 1 << 16):
        part = slice(a, min(n, a + (1 << 16)))
        k = part.stop - a
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(k, m)), pa.array(np.full(k, block)), coded.dictionary.take(pa.array(code[at[part]])), pa.array(tf[at[part]]),
                docs.slice(a, k), pa.nulls(k, pa.list_(pa.int64())),
            ],
            names=names,
        )


def _runs(batches):
    """(m, block, rows) of each run of rows with the same m and block, which may cross batches."""
    held, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        m, block = (batch.column(i).to_numpy() for i in (0, 1))
        edge = np.flatnonzero((m[1:] != m[:-1]) | (block[1:] != block[:-1])) + 1
        for a, b in zip([0, *edge], [*edge, len(m)], strict=True):
            if held and key != (int(m[a]), int(block[a])):
                yield *key, held
                held = []
            key = int(m[a]), int(block[a])
            held.append(batch.slice(a, b - a))
    if held:
        yield *key, held


def build_index(docs: DataFrame) -> Index:
    """The index of all documents, written into the shared folder."""
    spark = prepared(docs.sparkSession)
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    lengths = kept(_lengths(docs), "lengths").filter("n > 0")
    n_docs, n_terms = lengths.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum(F.col("n") * F.col("docs")), F.lit(0))).first()
    stratum = (75 + F.floor(F.lit(25).cast("decimal(38,0)") * F.col("n") * n_docs / max(n_terms, 1))).cast("bigint")
    crowded = lengths.groupBy(stratum.alias("m")).agg(F.ceil(F.sum(F.col("n") * F.col("docs")) / BLOCK).alias("blocks")).filter("blocks > 1")
    # strata of more than BLOCK terms: at most n_terms / BLOCK of them, and no more than there are lengths
    blocks = {r.m: int(r.blocks) for r in crowded.collect()}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = _counted(docs, n_docs, max(n_terms, 1), blocks).repartition(parts, "m", "block").sortWithinPartitions("m", "block")

    def run(batches):
        for m, block, held in _runs(batches):
            yield from _posted(m, block, held)

    return Index(kept(dealt.mapInArrow(run, INDEX), "index"), n_docs, n_terms)


def impact(w, tf, m):
    """What a term of weight w adds to a document; whole numbers."""
    return w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def _impact(tf: Column, m: Column) -> Column:
    return F.expr(f"(1000000000L * {tf}) div (1000L * {tf} + 12L * {m})")


def item_terms(items: DataFrame) -> DataFrame:
    """item (number of the row), item_id, term, reps."""

    def run(batches):
        for block, data, at in text_blocks(batches, "text", PIECE):
            names, text, code, tf = terms_of(data, at)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(1).take(pa.array(text)), block.column(2).take(pa.array(text)), names.take(pa.array(code)).cast(pa.string()),
                    pa.array(tf.astype(np.int64)),
                ],
                names=["item", "item_id", "term", "reps"],
            )

    kind = items.schema["item_id"].dataType.simpleString()
    rows = items.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("item"), "item_id")
    return rows.mapInArrow(run, f"item bigint, item_id {kind}, term string, reps bigint")


class Best:
    """The k best documents of each item seen so far: highest score, then least id, null ids last."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.rows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def least(self, item: int, floor: int) -> int:
        have = self.rows.get(item)
        return max(floor, int(have[0][-1])) if have is not None and len(have[0]) == self.k else floor

    def add(self, item: int, score: np.ndarray, null: np.ndarray, ids: np.ndarray) -> None:
        new = score, null, ids
        if item in self.rows:
            new = tuple(np.concatenate([x, y]) for x, y in zip(self.rows[item], new, strict=True))
        best = np.lexsort((new[2], new[1], -new[0]))[: self.k]
        self.rows[item] = tuple(x[best] for x in new)

    def batches(self):
        for item, (score, null, ids) in self.rows.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), item)), pa.array(ids, mask=null), pa.array(score)], names=["item", "doc_id", "score"]
            )


def _visited(hits: DataFrame, group: dict, chosen: dict[int, np.ndarray], floor: np.ndarray, bounds: dict[int, np.ndarray], k: int) -> DataFrame:
    """item, doc_id, score: each task's best of the strata chosen for each item. ``group``: terms -> [(item, w * reps)]."""
    spark = hits.sparkSession
    sent = spark.sparkContext.broadcast((group, chosen, floor, bounds))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = hits.filter(F.col("m").isin([int(m) for m in chosen])) if len(chosen) <= 1000 else hits
    dealt = rows.repartition(parts, "m", "block").sortWithinPartitions("m", "block", F.asc_nulls_first("term"))

    def run(batches):
        terms, picks, least, bound = sent.value
        best = Best(k)
        for m, _, held in _runs(batches):
            wanted = picks.get(m)
            if wanted is not None:
                score_block(m, held, terms, wanted, least, bound[m], best)
        yield from best.batches()

    return dealt.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def score_block(m: int, held: list[pa.RecordBatch], terms: dict, wanted: np.ndarray, floor: np.ndarray, bound: np.ndarray, best: Best) -> None:
    t = pa.Table.from_batches(held)
    ids = t.column("ids")[0].values  # the row without a term comes first
    null = ids.is_null().to_numpy(zero_copy_only=False)
    ids = ids.fill_null(0).to_numpy()
    lists = t.column("docs").combine_chunks()
    edge, docs = lists.offsets.to_numpy() - lists.offsets[0].as_py(), lists.flatten().to_numpy()
    tf = t.column("tf").to_numpy()
    adds: dict[int, list] = {}  # item -> posting lists, each with its impact, computed once per tf
    for i, term in enumerate(t.column("term").to_pylist()):
        if term is not None:
            unit = impact(1, int(tf[i]), m)
            for item, w in terms.get(term, ()):
                adds.setdefault(item, []).append((docs[edge[i] : edge[i + 1]], w * unit))
    for item in wanted.tolist():
        lists = adds.get(item)
        if lists is None or bound[item] < best.least(item, int(floor[item])):
            continue
        score = np.zeros(len(ids), np.int64)
        for places, add in lists:
            score[places] += add  # a list names a document once
        least = max(best.least(item, int(floor[item])), 1)
        found = np.flatnonzero(score >= least)
        if len(found):
            if len(found) > 4 * best.k:  # what is below the k-th best score can't enter
                cut = np.partition(score[found], len(found) - best.k)[len(found) - best.k]
                found = found[score[found] >= cut]
            best.add(item, score[found], null[found], ids[found])


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(index: Index, items: DataFrame, k: int = K, group_terms: int = GROUP_TERMS, group_bounds: int = GROUP_BOUNDS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each row of ``items`` (item_id, text)."""
    prepared(items.sparkSession)
    asked = kept(item_terms(items), "asked")
    hits = index.table.join(asked.select("term").distinct(), "term", "left_semi").unionByName(index.table.filter("term is null"))
    hits = kept(hits.select(*index.table.columns), "hits")
    tops = kept(hits.filter("term is not null").groupBy("m", "term").agg(F.max("tf").alias("tf"), F.sum(F.size("docs")).alias("docs")), "tops")
    w = F.floor(1000 * F.log((2.0 * index.n_docs + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weights = tops.groupBy("term").agg(F.sum("docs").alias("df")).select("term", w.alias("w"))
    weighted = kept(asked.join(weights, "term").select("item", "item_id", "term", (F.col("w") * F.col("reps")).alias("w")), "weighted")
    strata = tops.select("m").distinct().count()
    per_item = weighted.groupBy("item").agg(F.count("*").alias("n"))
    # items in groups: both the terms and the bounds of a group fit its broadcast
    n_items, n_terms, widest = per_item.agg(F.count("*"), F.sum("n"), F.max("n")).first()
    if not n_items:
        return weighted.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("bigint").alias("doc_id"), F.lit(0).cast("bigint").alias("score")).limit(0)
    groups = max(-(-n_terms // group_terms), -(-n_items * strata // group_bounds))
    found = None
    for g in range(groups):
        part = weighted.filter(F.pmod(F.xxhash64("item"), F.lit(groups)) == g)
        ranked = _search_group(hits, part, tops, k)
        if ranked is not None:
            found = ranked if found is None else found.unionByName(ranked)
    names = weighted.select("item", "item_id").distinct()
    return found.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _search_group(hits: DataFrame, weighted: DataFrame, tops: DataFrame, k: int) -> DataFrame | None:
    rows = weighted.select("item", "term", "w").toArrow()
    if not rows.num_rows:
        return None
    number, item = np.unique(rows.column("item").to_numpy(), return_inverse=True)
    terms: dict[str, list[tuple[int, int]]] = {}
    for term, i, w in zip(rows.column("term").to_pylist(), item.tolist(), rows.column("w").to_pylist(), strict=True):
        terms.setdefault(term, []).append((i, w))
    add = F.col("w") * _impact("tf", "m")
    bound = weighted.join(tops, "term").groupBy("item", "m").agg(F.sum(add).alias("bound")).toArrow()
    at, m, value = np.searchsorted(number, bound.column("item").to_numpy()), bound.column("m").to_numpy(), bound.column("bound").to_numpy()
    bounds = {int(x): np.zeros(len(number), np.int64) for x in np.unique(m)}
    for i, x, v in zip(at.tolist(), m.tolist(), value.tolist(), strict=True):
        bounds[x][i] = v
    order = np.lexsort((m, -value, at))
    rank = np.empty(len(m), np.int64)
    rank[order] = np.arange(len(m)) - np.searchsorted(at[order], at[order])
    first, floor = rank < FIRST, np.zeros(len(number), np.int64)

    def picked(mask: np.ndarray) -> dict[int, np.ndarray]:
        x, i = m[mask], at[mask]
        by = np.lexsort((i, x))
        return {int(s): i[by][a:b] for s, a, b in _segments(x[by])}

    best = kept(_ranked(_visited(hits, terms, picked(first), floor, bounds, k), k), "first-visit").select("item", "doc_id", "score", "rank")
    last = best.filter(F.col("rank") == k).select("item", "score").toArrow()
    floor[last.column("item").to_numpy()] = last.column("score").to_numpy()
    again = ~first & (value >= floor[at])  # a stratum below the floor can't hold one of the k best
    if again.any():
        more = _visited(hits, terms, picked(again), floor, bounds, k)
        best = _ranked(best.drop("rank").unionByName(more), k)
    best = kept(best, "second-visit")
    to_item = best.sparkSession.createDataFrame(pa.table({"item": np.arange(len(number)), "real": number}))
    return best.join(to_item, "item").select(F.col("real").alias("item"), "doc_id", "score", "rank")


def _segments(x: np.ndarray):
    edge = np.flatnonzero(x[1:] != x[:-1]) + 1
    for a, b in zip([0, *edge], [*edge, len(x)], strict=True):
        if b > a:
            yield x[a], a, b


def lexical_search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """item_id, rank, doc_id, score of the k best of all ``docs`` for each row of ``items``."""
    return search(build_index(docs), items, k)


SQL = r"""
    WITH d AS (SELECT doc_id, row_number() OVER () AS r,
                      unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
         n AS (SELECT r, doc_id, CAST(count(*) AS BIGINT) AS n FROM d GROUP BY ALL),
         g AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM n),
         q AS (SELECT item_id, row_number() OVER () AS i,
                      unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
         qt AS (SELECT i, item_id, term, count(*) AS reps FROM q GROUP BY ALL),
         tf AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM d WHERE term IN (SELECT term FROM qt) GROUP BY ALL),
         w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(nn) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, g GROUP BY term),
         m AS (SELECT r, doc_id, 75 + (25 * n * nn) // ll AS m FROM n, g),
         s AS (SELECT i, item_id, doc_id, r, CAST(sum(reps * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
               FROM qt JOIN w USING (term) JOIN tf USING (term) JOIN m USING (r) GROUP BY ALL),
         o AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM s WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM o WHERE rank <= 20
"""
