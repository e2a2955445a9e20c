"""Near-duplicate classes by ProbMinHash, banding and exact verification.

A text's elements are its shingles of ``SHINGLE`` consecutive words (all its words where it has fewer), each
with weight ``1 + ln(count)``. Every element is a Poisson process whose rate is its weight: its arrivals come
at exponential gaps and each picks a register at random, all from the element's hash. A register keeps the
element that arrived first; a process ends as soon as its arrival is later than what every register holds.
Two texts agree in a register with their probability-Jaccard similarity. ``ROWS`` registers make a band.
That similarity falls below the verified one where shingles repeat unequally, so a text with repeated shingles is
signed with unit weights too (without repeats the two signatures are the same), and the bands of both are its
bands. With unit weights two texts agree in a register with the Jaccard similarity of their shingle sets, which
is what is verified: ``BANDS`` equal-band chances lose a pair of Jaccard similarity 0.8 with probability 6e-5,
whatever the counts; the weighted bands only add candidates.

Texts with equal words are one member (the least doc_id stands for all). Members with an equal band and sizes
that allow the similarity make a bucket. No bucket is spread into all its pairs. First each bucket's
leader, the member that meets most others in all its buckets (the text that others were made from, rather than
one of its copies; of equals the one with the largest number), is paired with its others; the pairs are verified by the exact Jaccard similarity of the shingle sets (0.8
or more) and classes merged. Buckets that are not one class by then are
joined into families (connected through shared buckets), and a family is compared exactly: its members are dealt
into blocks of about ``BLOCK``, members of one class together, and each two blocks that are not of one class
meet in a task, which counts common shingles by a matrix product and gives back only true links. So every pair
with an equal band is compared unless both are in one class already, and no group is ever whole in one task.

Classes are the connected components of the links. Results: doc_id, class_id (least doc_id of the class),
class_size (documents), n_links (of the verified links that were used to join the class, those of the text that
stands for the document: no degree, as members of one class are not compared again), kept (the class's
first row). Defined results: null and blank texts have no shingle and each is a class of its own; a null
doc_id counts as larger than every other; an empty table gives an empty table. Extra columns of any name are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchbook.llm.common import WORD_BASE_2, PhraseHasher, kept, mixed, prepared, text_blocks

SHINGLE = 5
THRESHOLD = 0.8
ROWS = 6
BANDS = 32
REGISTERS = ROWS * BANDS
#: Members of a family that are compared with as many others in one task.
BLOCK = 400
LAST = 2**63 - 1
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(hasher: PhraseHasher, data: np.ndarray, offsets: np.ndarray) -> tuple:
    """(text, hash, count) of each distinct shingle, by text; number of words; 128-bit digest of the words."""
    words, first = hasher.words(data, offsets)
    sums, sums2 = hasher.sums(words), hasher.sums(words, WORD_BASE_2)
    n = np.diff(first)
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    text = np.repeat(np.arange(len(n)), count)
    begin = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[:-1][text]
    h = hasher.run(sums, begin, np.minimum(begin + SHINGLE, first[1:][text]))
    edge = np.concatenate([[0], np.cumsum(count)])
    for a, b in zip(edge, edge[1:], strict=False):
        h[a:b].sort()
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    whole = [hasher.run(s, first[:-1], first[1:], b) for s, b in ((sums, 0xD1342543DE82EF95), (sums2, WORD_BASE_2))]
    return text[at], h[at], np.diff(np.append(at, len(h))), n, whole


def registers(text: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """ProbMinHash signatures of n texts: (n, m) hashes of the elements that arrived first."""
    best = np.full(n * m, np.inf)
    time = np.zeros(len(element))
    seen, live, turn = [], np.arange(len(element)), 0
    while len(live):
        turn += 1
        draw = mixed(element[live] + np.uint64(int(GOLDEN) * turn % 2**64))
        gap = -np.log1p(-(draw >> np.uint64(11)).astype(np.float64) * 2.0**-53)
        time[live] += gap / weight[live]
        key = text[live] * m + (mixed(draw ^ GOLDEN) >> np.uint64(32)).astype(np.int64) % m
        early = time[live] < best[key]
        np.minimum.at(best, key[early], time[live][early])
        seen.append((key[early], time[live][early], live[early]))
        last = best.reshape(n, m).max(1)
        live = live[time[live] < last[text[live]]]
    out = np.zeros(n * m, np.uint64)
    for key, when, who in seen:
        first = when == best[key]
        out[key[first]] = element[who[first]]
    return out.reshape(n, m)


def band_hashes(signature: np.ndarray) -> np.ndarray:
    """(n, BANDS) hashes of the bands; equal only for the same band."""
    out = np.empty((len(signature), BANDS), np.uint64)
    for b in range(BANDS):
        h = np.full(len(signature), b + 1, np.uint64) * GOLDEN
        for r in range(ROWS):
            h = mixed((h ^ signature[:, b * ROWS + r]) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(r + 1))
        out[:, b] = h
    return out


def bands_of(text: np.ndarray, element: np.ndarray, count: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(band hashes by text, how many each of n texts has): those of the weights 1 + ln(count), and those of unit
    weights where they differ. A text without shingles has none."""
    weighted = band_hashes(registers(text, element, 1.0 + np.log(count), n))
    unit = weighted.copy()
    odd = np.zeros(n, bool)
    odd[text[count > 1]] = True
    if odd.any():
        use = odd[text]
        place = (np.cumsum(odd) - 1)[text[use]]
        unit[odd] = band_hashes(registers(place, element[use], np.ones(int(use.sum())), int(odd.sum())))
    worded = np.bincount(text, minlength=n) > 0
    fresh = np.concatenate([np.ones(weighted.shape, bool), unit != weighted], 1) & worded[:, None]
    return np.concatenate([weighted, unit], 1)[fresh], fresh.sum(1)


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the pair that names a row's content: the id (null: the largest) and a hash of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("oid"),
        F.xxhash64(text).alias("tkey"),
        text.alias("text"),
    )


def signed(rows: DataFrame) -> DataFrame:
    """One scan: digest of the words, number of words and of distinct shingles, band hashes (none without words)."""

    def run(batches):
        hasher = PhraseHasher()
        for block, data, offsets in text_blocks(batches, "text", 1 << 19):
            text, element, count, n, whole = shingles(hasher, data, offsets)
            bands, each = bands_of(text, element, count, len(n))
            edge = np.concatenate([[0], np.cumsum(each)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(block.column(i) for i in range(3)),
                    *(pa.array(w.view(np.int64)) for w in whole),
                    pa.array(n.astype(np.int64)),
                    pa.array(np.bincount(text, minlength=len(n)).astype(np.int64)),
                    pa.ListArray.from_arrays(pa.array(edge), pa.array(bands.view(np.int64))),
                ],
                names=["doc_id", "oid", "tkey", "d1", "d2", "n_words", "size", "bands"],
            )

    return rows.mapInArrow(
        run, "doc_id bigint, oid bigint, tkey bigint, d1 bigint, d2 bigint, n_words bigint, size bigint, bands array<bigint>"
    )


def shingle_sets(rows: DataFrame) -> DataFrame:
    """member, set: distinct shingle hashes of each text."""

    def run(batches):
        hasher = PhraseHasher()
        for block, data, offsets in text_blocks(batches, "text", 1 << 19):
            text, element, *_ = shingles(hasher, data, offsets)
            edge = np.searchsorted(text, np.arange(block.num_rows + 1)).astype(np.int32)
            sets = pa.ListArray.from_arrays(pa.array(edge), pa.array(element.view(np.int64)))
            yield pa.RecordBatch.from_arrays([block.column(0), sets], names=["member", "set"])

    return rows.select("member", "text").mapInArrow(run, "member bigint, set array<bigint>")


def components(links: DataFrame) -> DataFrame:
    """member, class: connected components of the links (a, b), named by their least member. Each round every
    member takes the least class among its neighbours, then its class's class (pointer jumping)."""
    both = kept(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    state = kept(both.groupBy("a").agg(F.least("a", F.min("b")).alias("class")).withColumnRenamed("a", "member"), "classes")
    while True:
        seen = both.join(state.select(F.col("member").alias("b"), "class"), "b").groupBy("a").agg(F.min("class").alias("near"))
        step = state.join(seen, state["member"] == seen["a"]).select("member", "class", F.least("class", "near").alias("next"))
        jump = state.select(F.col("member").alias("m"), F.col("class").alias("far"))
        step = kept(
            step.join(jump, step["next"] == jump["m"], "left").select("member", "class", F.least("next", F.coalesce("far", "next")).alias("next")),
            "classes",
        )
        changed = step.filter("next <> class").limit(1).count()
        state = step.select("member", F.col("next").alias("class"))
        if not changed:
            return state


def verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) with ``sim``, where the Jaccard similarity of their sets reaches the threshold."""
    left = sets.select(F.col("member").alias("a"), F.col("set").alias("sa"))
    right = sets.select(F.col("member").alias("b"), F.col("set").alias("sb"))
    small, large = F.least(F.size("sa"), F.size("sb")), F.greatest(F.size("sa"), F.size("sb"))
    both = pairs.join(left, "a").join(right, "b").filter(small >= threshold * large)
    both = both.withColumn("same", F.size(F.array_intersect("sa", "sb")))
    sim = F.col("same") / (F.size("sa") + F.size("sb") - F.col("same"))
    return both.select("a", "b", sim.alias("sim")).filter(F.col("sim") >= threshold).distinct()


def sized(buckets: DataFrame, threshold: float) -> DataFrame:
    """Buckets (band, member, size) cut by size: members whose sizes allow the similarity share one of two keys."""
    step = F.floor(F.log("size") / float(np.log(1 / threshold)) + 1e-9).cast("bigint")
    keys = buckets.select("member", "size", F.explode(F.array(step, step + 1)).alias("step"), "band")
    keys = keys.select(F.xxhash64("band", "step").alias("band"), "member", "size")
    return met(keys)


def met(keys: DataFrame) -> DataFrame:
    """The buckets (band, member, size) of several members, with each member's ``weight``: how many rows its buckets
    have together. A member has a bounded number of buckets."""
    several = keys.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    own = Window.partitionBy("member")
    return keys.join(several, "band").withColumn("weight", F.sum("n").over(own)).drop("n")


def classed(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """``rows`` with the class of each member so far (its own number: none)."""
    return rows.join(classes, "member", "left").withColumn("class", F.coalesce("class", "member"))


def similar(t: pa.Table, threshold: float) -> pa.Table:
    """Links between members of different classes among the rows (member, class, set) of two blocks."""
    member, place = np.unique(t.column("member").to_numpy(), return_index=True)
    cls = t.column("class").to_numpy()[place]
    lists = t.column("set").combine_chunks().take(pa.array(place))
    size = np.diff(lists.offsets.to_numpy())
    owner = np.repeat(np.arange(len(member)), size)
    shingle, code, n = np.unique(lists.flatten().to_numpy(), return_inverse=True, return_counts=True)
    shared = np.cumsum(n > 1) - 1
    use = n[code] > 1
    owner, code, width = owner[use], shared[code[use]], int((n > 1).sum())
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    common = np.zeros((len(member),) * 2, np.float32)
    for begin in range(0, width, 4096):
        a, b = np.searchsorted(code, [begin, begin + 4096])
        table = np.zeros((len(member), min(4096, width - begin)), np.float32)
        table[owner[a:b], code[a:b] - begin] = 1
        common += table @ table.T
    sim = common / (size[:, None] + size[None, :] - common)
    a, b = np.nonzero(np.triu((sim >= threshold - 1e-6) & (cls[:, None] != cls[None, :]), 1))
    return pa.table({"a": pa.array(member[a]), "b": pa.array(member[b]), "sim": pa.array(sim[a, b].astype(np.float64))})


def family_links(members: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """a, b, sim: the links between different classes of each family; members: member, family, class, set."""
    alone = F.count("*").over(Window.partitionBy("family", "class")) == 1
    group = members.select("member", "family", "class").withColumn("group", F.when(alone, F.lit(-1)).otherwise(F.col("class")))
    sizes = group.groupBy("family", "group").agg(F.ceil(F.count("*") / block).alias("n"))
    dealt = group.join(sizes, ["family", "group"]).withColumn("block", F.pmod(F.xxhash64("member"), F.col("n")))
    dealt = kept(dealt.select("member", "family", "class", "group", "block"), "blocks")
    blocks = dealt.select("family", F.struct("group", "block").alias("x")).distinct()
    pairs = blocks.join(blocks.withColumnRenamed("x", "y"), "family").filter(
        (F.col("x") <= F.col("y")) & ((F.col("x.group") != F.col("y.group")) | (F.col("x.group") == -1))
    )
    sides = pairs.select("family", "x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("side"))
    sides = sides.select(F.xxhash64("family", "x", "y").alias("pair"), "family", F.col("side.group").alias("group"), F.col("side.block").alias("block"))
    rows = sides.join(dealt, ["family", "group", "block"]).select("pair", "member", "class").join(members.select("member", "set"), "member")

    def compare(t: pa.Table) -> pa.Table:
        return similar(t, threshold)

    return rows.groupBy("pair").applyInArrow(compare, "a bigint, b bigint, sim double").distinct()


def links(buckets: DataFrame, sets: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(links a, b, sim; classes member, class) among the members of buckets (band, member, size, weight)."""
    alike = F.least("size", "lsize") >= threshold * F.greatest("size", "lsize")
    leaders = buckets.groupBy("band").agg(F.max(F.struct("weight", "member"))["member"].alias("leader"))
    leaders = kept(leaders.join(buckets.select("band", F.col("member").alias("leader"), F.col("size").alias("lsize")), ["band", "leader"]), "leaders")
    pairs = buckets.join(leaders, "band").filter((F.col("member") != F.col("leader")) & alike)
    tried = kept(pairs.select(F.least("member", "leader").alias("a"), F.greatest("member", "leader").alias("b")).distinct(), "pairs")
    found = kept(verified(tried, sets, threshold), "found")
    classes = components(found)
    mixed_bands = classed(buckets, classes).groupBy("band").agg(F.min("class").alias("c1"), F.max("class").alias("c2"))
    rest = kept(buckets.join(mixed_bands.filter("c1 <> c2").select("band"), "band").select("band", "member"), "rest")
    if not rest.limit(1).count():
        return found, classes
    heads = rest.groupBy("band").agg(F.min("member").alias("a"))
    family = components(rest.join(heads, "band").select("a", F.col("member").alias("b"))).withColumnRenamed("class", "family")
    members = kept(classed(sets.join(family, "member"), classes).select("member", "family", "class", "set"), "families")
    new = kept(family_links(members, threshold), "found")
    if new.limit(1).count():
        found = found.unionByName(new)
        classes = components(found)
    return found, classes


def near_dedup(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, class_size, n_links, kept, and the row's key (oid, tkey): one row for each row of ``docs``."""
    prepared(docs.sparkSession)
    rows = keyed(docs)
    scan = kept(signed(rows).withColumn("row_no", F.monotonically_increasing_id()), "signed")
    # one member for each sequence of words; its number is the row of the least doc_id
    texts = kept(
        scan.filter("n_words > 0").groupBy("d1", "d2").agg(F.min_by("row_no", "oid").alias("member"), F.count("*").alias("copies")),
        "texts",
    )
    first = scan.join(texts.select(F.col("member").alias("row_no")), "row_no", "left_semi")
    bands = first.select(F.col("row_no").alias("member"), "size", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    buckets = kept(sized(bands.join(shared, "band").select("band", "member", "size"), threshold), "buckets")
    involved = scan.select(F.col("row_no").alias("member"), "oid", "tkey").join(buckets.select("member").distinct(), "member")
    sets = kept(shingle_sets(rows.select("oid", "tkey", "text").join(involved, ["oid", "tkey"])), "sets")
    found, classes = links(buckets, sets, threshold)
    degree = found.select(F.explode(F.array("a", "b")).alias("member")).groupBy("member").agg(F.count("*").alias("n_links"))
    member = (
        texts.join(classes, "member", "left").withColumn("class", F.coalesce("class", "member"))
        .join(degree, "member", "left").join(scan.select(F.col("row_no").alias("member"), "oid", F.col("doc_id").alias("id")), "member")
    )
    member = kept(member, "members")
    classes = member.groupBy("class").agg(
        F.min("id").alias("class_id"), F.sum("copies").alias("class_size"), F.min_by("member", "oid").alias("keep_row")
    )
    member = member.join(classes, "class").select("d1", "d2", "class_id", "class_size", "keep_row", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    worded = scan.filter("n_words > 0").select("doc_id", "oid", "tkey", "row_no", "d1", "d2").join(member, ["d1", "d2"])
    blank = scan.filter("n_words = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("bigint").alias("class_size"),
        F.lit(0).cast("bigint").alias("n_links"), F.lit(True).alias("kept"), "oid", "tkey",
    )
    return worded.select(
        "doc_id", "class_id", "class_size", "n_links", (F.col("row_no") == F.col("keep_row")).alias("kept"), "oid", "tkey"
    ).unionByName(blank)


def drop_near(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, with its own columns; rows that repeat id and text are one."""
    stay = kept(near_dedup(docs, threshold).filter("kept").select(F.col("oid").alias("__oid"), F.col("tkey").alias("__tkey")), "stay")
    marked = docs.withColumns(
        {
            "__oid": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)),
            "__tkey": F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))),
        }
    )
    left = marked.join(stay, ["__oid", "__tkey"], "left_semi")
    return left.dropDuplicates(["__oid", "__tkey"]).drop("__oid", "__tkey")
