"""Substring dedup by minimizer runs, grouped by hash, against an index of everything with a smaller doc_id.

A window is ``WINDOW`` consecutive words of one text (words: maximal runs without ASCII white space). A word
goes if a window that covers it also stands in a document with a smaller doc_id; windows are judged on the
input. Each text is cut, left to right, into factors: maximal runs of windows that share their
anchor, the least hash of ``ANCHOR`` consecutive words in a window. The anchor depends on a window's words
alone, so an equal window elsewhere lies in a factor with the same anchor. This stands in place of a relative
Lempel-Ziv parse: no factor is a match in a reference or is extended to the longest one. The reference is not a string that
every document is held against (that would be documents times blocks): it is the index of all factors, cut into
hash blocks that Spark deals out by anchor. Three steps:

1. Anchors that only one document has can't be in a shared window; most factors end here.
2. A factor that also stands, word for word, in a smaller document is a duplicate span as a whole.
3. At factor boundaries, where an anchor occurs with different surroundings, the first document of each distinct
   factor has its single windows checked by two 64-bit hashes against all others of that anchor.

Hashes of 128 bits together (anchor and factor, or two window hashes) stand for equal words.

Defined results: a null or blank text has no words, is kept whole and has the digest of the empty text; texts
under ``WINDOW`` words lose nothing; a null doc_id counts as larger than every other; rows with the same doc_id
don't remove from each other; an empty table gives an empty table. Extra columns of any name are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchbook.llm.common import WORD_BASE_2, PhraseHasher, kept, mixed, prepared, sliding_min, text_blocks

WINDOW = 50
ANCHOR = 12
LAST = 2**63 - 1


def factors(hasher: PhraseHasher, sums: np.ndarray, sums2: np.ndarray, a: int, b: int, window: int = WINDOW) -> tuple:
    """(first window, end window, anchor, factor hash) of each factor of the words a..b-1, windows counted from a."""
    if b - a < window:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    at = np.arange(a, b - ANCHOR + 1)
    least = sliding_min(hasher.run(sums, at, at + ANCHOR), window - ANCHOR + 1)
    begin = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    end = np.append(begin[1:], len(least))
    whole = hasher.run(sums2, a + begin, a + end + window - 1, WORD_BASE_2)
    return begin, end, least[begin], mixed(whole + (end - begin).astype(np.uint64))


def block_words(hasher: PhraseHasher, data: np.ndarray, offsets: np.ndarray):
    words, first = hasher.words(data, offsets)
    return first, hasher.sums(words), hasher.sums(words, WORD_BASE_2)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the pair that names a row's content: the id (null: the largest) and a hash of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("oid"),
        F.xxhash64(text).alias("tkey"),
        text.alias("text"),
    )


def parsed(rows: DataFrame) -> DataFrame:
    """One scan: number of words, digest of all words, anchors and factor hashes of each text."""

    def run(batches):
        hasher = PhraseHasher()
        for block, data, offsets in text_blocks(batches, "text", 1 << 20):
            first, sums, sums2 = block_words(hasher, data, offsets)
            found = [factors(hasher, sums, sums2, a, b) for a, b in zip(first, first[1:], strict=False)]
            sha = [
                hashlib.sha256(b" ".join(data[a:b].tobytes().split())).hexdigest()
                for a, b in zip(offsets, offsets[1:], strict=False)
            ]
            lists = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *(block.column(i) for i in range(3)),
                    pa.array(np.diff(first).astype(np.int64)),
                    pa.array(sha),
                    pa.array([f[2].view(np.int64) for f in found], lists),
                    pa.array([f[3].view(np.int64) for f in found], lists),
                ],
                names=["doc_id", "oid", "tkey", "n_words", "sha", "anchors", "factors"],
            )

    return rows.mapInArrow(
        run, "doc_id bigint, oid bigint, tkey bigint, n_words bigint, sha string, anchors array<bigint>, factors array<bigint>"
    )


def decisions(scan: DataFrame) -> DataFrame:
    """For each text with a shared anchor: ``sure``, the factors that go as a whole, and ``check``, those whose
    windows are compared one by one."""
    rows = scan.filter(F.size("anchors") > 0).select(
        "oid", "tkey", F.posexplode(F.arrays_zip("anchors", "factors")).alias("ord", "f")
    ).select("oid", "tkey", "ord", F.col("f.anchors").alias("anchor"), F.col("f.factors").alias("factor"))
    shared = (
        rows.groupBy("anchor")
        .agg(F.min("oid").alias("first"), F.max("oid").alias("last"), F.min("factor").alias("f1"), F.max("factor").alias("f2"))
        .filter("first < last")
        .select("anchor", F.col("first").alias("first_of_anchor"), (F.col("f1") == F.col("f2")).alias("single"))
    )
    found = kept(rows.join(shared, "anchor"), "shared")
    whole = found.filter("single").select("oid", "tkey", "ord", (F.col("oid") > F.col("first_of_anchor")).alias("sure"))
    several = found.filter("not single")
    firsts = several.groupBy("anchor", "factor").agg(F.min("oid").alias("first_of_factor"))
    mixed_rows = several.join(firsts, ["anchor", "factor"]).select(
        "oid", "tkey", "ord", (F.col("oid") > F.col("first_of_factor")).alias("sure"), F.lit(True).alias("several")
    )
    both = whole.filter("sure").withColumn("several", F.lit(False)).unionByName(mixed_rows)
    return both.groupBy("oid", "tkey").agg(
        F.array_distinct(F.collect_list(F.when(F.col("sure"), F.col("ord")))).alias("sure"),
        F.array_distinct(F.collect_list(F.when(~F.col("sure") & F.col("several"), F.col("ord")))).alias("check"),
    )


def boundary_windows(involved: DataFrame) -> DataFrame:
    """w1, w2, oid, tkey, start: the single windows of the factors to check."""

    def run(batches):
        hasher = PhraseHasher()
        for block, data, offsets in text_blocks(batches, "text", 1 << 19):
            first, sums, sums2 = block_words(hasher, data, offsets)
            check = block.column(block.schema.get_field_index("check"))
            oid, tkey = (block.column(block.schema.get_field_index(c)) for c in ("oid", "tkey"))
            out, row = [], []
            for i, (a, b) in enumerate(zip(first, first[1:], strict=False)):
                wanted = check[i].as_py()
                if not wanted:
                    continue
                begin, end, *_ = factors(hasher, sums, sums2, a, b)
                begin, end = begin[wanted], end[wanted]
                size = end - begin
                at = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                out.append(np.stack([at, at + a]))
                row.append(np.full(len(at), i))
            if not out:
                continue
            at, row = np.concatenate(out, 1), np.concatenate(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hasher.run(sums, at[1], at[1] + WINDOW).view(np.int64)),
                    pa.array(hasher.run(sums2, at[1], at[1] + WINDOW, WORD_BASE_2).view(np.int64)),
                    oid.take(pa.array(row)), tkey.take(pa.array(row)), pa.array(at[0].astype(np.int32)),
                ],
                names=["w1", "w2", "oid", "tkey", "start"],
            )

    return involved.mapInArrow(run, "w1 bigint, w2 bigint, oid bigint, tkey bigint, start int")


def cut(involved: DataFrame) -> DataFrame:
    """What is left of the texts with decisions: doc_id, n_words, n_removed, spans of removed words, kept text."""

    def run(batches):
        hasher = PhraseHasher()
        for block, data, offsets in text_blocks(batches, "text", 1 << 20):
            first, sums, sums2 = block_words(hasher, data, offsets)
            sure, starts = (block.column(block.schema.get_field_index(c)) for c in ("sure", "starts"))
            n_words, n_removed, spans, texts = [], [], [], []
            for i, (a, b) in enumerate(zip(first, first[1:], strict=False)):
                n = int(b - a)
                cover = np.zeros(n + 1, np.int32)
                begin, end, *_ = factors(hasher, sums, sums2, a, b)
                whole = sure[i].as_py() or []
                np.add.at(cover, begin[whole], 1)
                np.add.at(cover, end[whole] - 1 + WINDOW, -1)
                single = np.asarray(starts[i].as_py() or [], np.int64)
                np.add.at(cover, single, 1)
                np.add.at(cover, single + WINDOW, -1)
                gone = np.cumsum(cover[:n]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
                words = data[offsets[i] : offsets[i + 1]].tobytes().split()
                n_words.append(n)
                n_removed.append(int(gone.sum()))
                spans.append([{"begin": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)])
                texts.append(b" ".join([words[j] for j in np.flatnonzero(~gone)]).decode("utf-8", "replace"))
            span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, span), pa.array(texts, pa.string())],
                names=["doc_id", "n_words", "n_removed", "spans", "kept_text"],
            )

    return involved.mapInArrow(
        run, "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<begin: bigint, end: bigint>>, kept_text string"
    )


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, spans (word ranges that go), kept_sha256, and kept_text where words go (null: all
    words stay). One row for each row of ``docs``."""
    prepared(docs.sparkSession)
    rows = keyed(docs)
    scan = kept(parsed(rows), "factors")
    found = kept(decisions(scan), "decisions")
    involved = kept(rows.join(found, ["oid", "tkey"]).select("doc_id", "oid", "tkey", "text", "sure", "check"), "involved")
    windows = kept(boundary_windows(involved.filter(F.size("check") > 0).dropDuplicates(["oid", "tkey"])), "windows")
    shared = windows.groupBy("w1", "w2").agg(F.min("oid").alias("first"), F.max("oid").alias("last")).filter("first < last")
    starts = (
        windows.join(shared, ["w1", "w2"]).filter("first < oid").groupBy("oid", "tkey").agg(F.collect_list("start").alias("starts"))
    )
    left = cut(involved.join(starts, ["oid", "tkey"], "left").select("doc_id", "text", "sure", "starts"))
    untouched = scan.join(found.select("oid", "tkey"), ["oid", "tkey"], "left_anti")
    spans = "array<struct<begin: bigint, end: bigint>>"
    return left.withColumn("kept_sha256", F.sha2("kept_text", 256)).unionByName(
        untouched.select(
            "doc_id", "n_words", F.lit(0).cast("bigint").alias("n_removed"), F.array().cast(spans).alias("spans"),
            F.lit(None).cast("string").alias("kept_text"), F.col("sha").alias("kept_sha256"),
        )
    )
