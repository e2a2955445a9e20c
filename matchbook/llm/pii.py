"""Personal data: fixed patterns, and identifiers found by bootstrapped contextual extraction.

DataFrame functions only. Base spans are the leftmost non-overlapping matches of ``BASE`` that pass their check. They
are the seeds, with the rest of the white-space tokens that they begin and end in. A token is met by lexical patterns: the word before it,
the word after it, and each of these together with the token's shape (letters and digits folded, runs collapsed:
``a@a.a``, ``+9``). Patterns that meet ``SUPPORT`` different seeds are candidates; a scan of the whole corpus counts their words
and drops those that less than ``START`` of the time stand next to a seed, so what the others meet is at most a fixed
multiple of the seeds; a second scan gives every token that they meet, seed or not (of a seed of several tokens the one
next to the word counts). Patterns and instances (a token without outer punctuation, in lower case) make a
graph, scored in rounds: a pattern's confidence is the sum of the scores of all tokens it meets over their number plus
one, so a pattern that meets ordinary words as well scores low; patterns with ``CONFIDENCE`` are accepted; an instance's
score is the noisy-or of its accepted patterns, and counts for its other patterns in the next round. Occurrences of
instances above ``ACCEPT`` after the last round that an accepted pattern meets, and that no base span overlaps, are added
as spans of kind ``context``.

The scan deals out narrow rows (context word, token) that are joined to the few candidates before anything is shuffled;
edges are counted map-side, and each round is an aggregate and a join by pattern and by instance. Frequent patterns meet
their instances in the narrow edge table, one row for each pair. Nothing is collected by group but the spans of one
document. Offsets are code points, end exclusive.

Defined results: a null text counts as empty; a text without spans has counts 0 and the digest of the empty
text; repeated rows get the same spans; without seeds there are no context spans; a neighbour of any length makes a
pattern, text ends make none; an empty table gives an empty table. Extra columns of any name are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchbook.llm.common import kept

#: Fixed patterns, in the order of the kinds. Possessive runs and the look-behinds only keep a failed
#: attempt from being tried again at every character of the same run.
BASE = (
    ("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", r"[0-9](?:[\x20-]?[0-9])++"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)
KINDS = [k for k, _ in BASE] + ["context"]
ROUNDS = 3
CONFIDENCE = 0.5
SUPPORT = 3
ACCEPT = 0.5
#: Share of a word's places next to which a seed stands, at least, for its patterns to take part.
START = 0.01
LAST = 2**63 - 1
#: Stands for every shape.
ANY = "*"
SPACE = " \t\n\x0b\x0c\r"


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes the Luhn check."""
    each = F.transform(
        F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
    )
    return F.aggregate(each, F.lit(0), lambda s, x: s + x - F.when(x > 9, 9).otherwise(0)) % 10 == 0


def passes(kind: Column, match: Column) -> Column:
    """Whether a match of a base kind is a span."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    parts = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    byte = F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(F.try_to_number(p, F.lit("999")), F.lit(0)) <= 255))
    return (
        F.when(kind == "email", True)
        .when(kind == "ip", byte)
        .when(kind == "card", n.between(13, 19) & luhn(digits))
        .otherwise(n.between(9, 15))
    )


def _matches(text: Column, pattern: str, needs: str | None) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<string>")
    return F.when(F.contains(text, F.lit(needs)), found).otherwise(none) if needs else found


def _places(kind: str, pattern: str) -> Column:
    """For each match of a kind: its number and the characters since the match before."""
    found, parts = F.col(f"m_{kind}"), F.split("text", pattern, -1)
    rows = F.transform(
        F.arrays_zip(found.alias("match"), F.slice(parts, 1, F.size(found)).alias("gap")),
        lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(x["gap"]).alias("gap"), x["match"].alias("match")),
    )
    return F.when(F.size(found) > 0, rows).otherwise(F.array().cast("array<struct<kind:string,i:int,gap:int,match:string>>"))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and the pair that names a row's content: the id (null: the largest) and a hash of the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("oid"), F.xxhash64(text).alias("tkey"), text.alias("text"))


def located(docs: DataFrame) -> DataFrame:
    """row, doc_id, oid, tkey, and every match of every kind, one array for each document: one scan."""
    needs = {"email": "@", "ip": ".", "phone": "+"}
    rows = keyed(docs).withColumns({f"m_{k}": _matches(F.col("text"), p, needs.get(k)) for k, p in BASE})
    rows = rows.select("doc_id", "oid", "tkey", F.concat(*[_places(k, p) for k, p in BASE]).alias("found"))
    return kept(rows.withColumn("row", F.monotonically_increasing_id()), "matches")


def spans(found: DataFrame) -> DataFrame:
    """row, oid, tkey, kind, begin, end of the base spans."""
    rows = found.filter(F.size("found") > 0).select("row", "oid", "tkey", F.explode("found").alias("f")).select("row", "oid", "tkey", "f.*").repartition("row")
    here = Window.partitionBy("row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("match")).over(here).cast("bigint"))
    rows = rows.withColumn("begin", F.col("end") - F.length("match")).filter(passes(F.col("kind"), F.col("match")))
    return rows.select("row", "oid", "tkey", "kind", "begin", "end")


def tokens(rows: DataFrame) -> DataFrame:
    """oid, tkey, i, piece, before, after: every white-space token (with the white space behind it) of ``rows``, and its
    neighbours; one narrow row each."""
    pieces = F.split("text", r"(?<=\s)(?=\S)")
    cut = rows.select("oid", "tkey", pieces.alias("p"))
    none = F.array(F.lit(None).cast("string"))
    n = F.size("p")
    before, after = F.concat(none, F.slice("p", 1, n - 1)), F.concat(F.slice("p", 2, n), none)
    zipped = F.arrays_zip(F.col("p").alias("piece"), before.alias("before"), after.alias("after"))
    each = cut.select("oid", "tkey", F.posexplode(zipped).alias("i", "x")).select("oid", "tkey", "i", "x.*")
    return each.filter(F.rtrim("piece", F.lit(SPACE)) != "")


def _word(c: str) -> Column:
    return F.lower(F.rtrim(F.col(c), F.lit(SPACE)))


def instance(piece: Column) -> Column:
    """A token without outer punctuation, in lower case."""
    outer = "\"'([{<>}])|,;:!?.*#$%&"
    return F.lower(F.trim(F.rtrim(piece, F.lit(SPACE)), F.lit(outer)))


def shape(token: Column) -> Column:
    """Letters and digits folded, runs collapsed."""
    folded = F.regexp_replace(F.regexp_replace(token, r"[0-9]+", "9"), r"\p{L}+", "a")
    return F.regexp_replace(folded, r"(.)\1+", "$1")


def shaped(rows: DataFrame) -> DataFrame:
    """The rows (piece, ...) with a token, twice: with the token's ``shape``, and with ANY."""
    rows = rows.withColumn("instance", instance(F.col("piece"))).filter("instance <> ''").drop("piece")
    return rows.withColumn("shape", F.explode(F.array(shape(F.col("instance")), F.lit(ANY))))


def sided(rows: DataFrame) -> DataFrame:
    """The rows (before, after, ...) twice: ``side`` and ``word``, the neighbour on that side."""
    sides = F.array(*[F.struct(F.lit(side).alias("side"), _word(side).alias("word")) for side in ("before", "after")])
    both = rows.select(*[c for c in rows.columns if c not in ("before", "after")], F.explode(sides).alias("x"))
    return both.select(*[c for c in both.columns if c != "x"], "x.*").filter("word <> ''")


def seeds(docs: DataFrame, base: DataFrame) -> DataFrame:
    """side, word, piece: the word before and the word after each base span, and the span's token next to it."""
    lists = base.groupBy("oid", "tkey").agg(F.collect_set(F.struct("begin", "end")).alias("at"))
    texts = keyed(docs).join(lists, ["oid", "tkey"]).dropDuplicates(["oid", "tkey"])

    def around(x: Column) -> Column:
        left, right = F.reverse(F.left("text", x["begin"])), F.substring(F.col("text"), x["end"] + 1, F.length("text"))
        whole = F.concat(
            F.reverse(F.regexp_extract(left, r"\A\S*", 0)), F.substring(F.col("text"), x["begin"] + 1, x["end"] - x["begin"]),
            F.regexp_extract(right, r"\A\S*", 0),
        )
        return F.array(
            F.struct(
                F.lit("before").alias("side"), F.lower(F.reverse(F.regexp_extract(left, r"\A\S*\s+(\S+)", 1))).alias("word"),
                F.regexp_extract(whole, r"\A\S+", 0).alias("piece"),
            ),
            F.struct(
                F.lit("after").alias("side"), F.lower(F.regexp_extract(right, r"\A\S*\s+(\S+)", 1)).alias("word"),
                F.regexp_extract(whole, r"\S+\z", 0).alias("piece"),
            ),
        )

    found = texts.select(F.explode(F.flatten(F.transform("at", around))).alias("x")).select("x.*")
    return found.filter("piece <> ''")


def candidates(seeded: DataFrame) -> DataFrame:
    """side, word, shape of the patterns that meet ``SUPPORT`` different seeds."""
    distinct = shaped(seeded.filter("word <> ''")).groupBy("side", "word", "shape", "instance").agg(F.count("*").alias("n"))
    return distinct.groupBy("side", "word", "shape").agg(F.count("*").alias("seeds")).filter(F.col("seeds") >= SUPPORT).drop("seeds")


def meetings(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """oid, tkey, i, instance, side, word, shape: every token of the corpus that a pattern meets; one scan."""
    words = patterns.select("side", "word").distinct()
    near = sided(tokens(keyed(docs))).join(words, ["side", "word"])
    return shaped(near).join(patterns, ["side", "word", "shape"]).select("oid", "tkey", "i", "instance", "side", "word", "shape")


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: how often each word stands in the corpus; one scan. Words are counted map-side, before any join, so what is
    shuffled is a task's different words and not every word of the corpus."""
    each = F.explode(F.split(F.lower("text"), r"\s+")).alias("word")
    return keyed(docs).select(each).groupBy("word").agg(F.count("*").alias("n"))


def bootstrap(edges: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(accepted patterns with their confidence; instance, score) from edges (side, word, shape, instance, n, seed)."""
    pattern = ["side", "word", "shape"]
    scored, accepted, found = edges.withColumn("score", F.col("seed")), None, None
    for _ in range(rounds):
        weight = scored.groupBy(*pattern).agg(F.sum(F.col("score") * F.col("n")).alias("sum"), F.sum("n").alias("n"))
        weight = weight.withColumn("confidence", F.col("sum") / (F.col("n") + 1)).filter(F.col("confidence") >= CONFIDENCE)
        accepted = kept(weight.select(*pattern, "confidence"), "patterns")
        miss = F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.99))))
        found = kept(edges.join(accepted, pattern).groupBy("instance").agg((1 - F.exp(miss)).alias("score")), "instances")
        scored = edges.join(found, "instance", "left").select(
            *pattern, "instance", "n", "seed", F.greatest("seed", F.coalesce("score", F.lit(0.0))).alias("score")
        )
    return accepted, found


def context_spans(docs: DataFrame, base: DataFrame) -> DataFrame:
    """oid, tkey, begin, end, confidence: tokens that accepted patterns take for identifiers, outside base spans."""
    pattern = ["side", "word", "shape"]
    seeded = kept(seeds(docs, base), "seeds")
    patterns = kept(candidates(seeded), "candidates")
    known = kept(seeded.select(instance(F.col("piece")).alias("instance"), F.lit(1.0).alias("seed")).distinct(), "known")
    # seeds are counted where they stand, words by a scan
    sure = seeded.groupBy("side", "word").agg(F.count("*").alias("seeds")).join(patterns.select("side", "word").distinct(), ["side", "word"])
    sure = kept(sure, "sure")
    words = sure.join(word_counts(docs).join(sure.select("word").distinct(), "word"), "word").filter(F.col("seeds") >= START * F.col("n")).select("side", "word")
    patterns = kept(patterns.join(words, ["side", "word"]), "patterns")
    if not patterns.limit(1).count():
        return base.select("oid", "tkey", "begin", "end", F.lit(1.0).alias("confidence")).limit(0)
    met = kept(meetings(docs, patterns), "meetings")
    edges = met.groupBy(*pattern, "instance").agg(F.count("*").alias("n")).join(known, "instance", "left")
    edges = kept(edges.select(*pattern, "instance", "n", F.coalesce("seed", F.lit(0.0)).alias("seed")), "edges")
    accepted, found = bootstrap(edges)
    hits = met.join(accepted, pattern).join(found.filter(F.col("score") >= ACCEPT), "instance")
    hits = hits.groupBy("oid", "tkey", "i").agg(F.max("confidence").alias("confidence"))
    # where the tokens stand: once for each document that has one
    wanted = hits.groupBy("oid", "tkey").agg(F.sort_array(F.collect_list(F.struct("i", "confidence"))).alias("hits"))
    texts = keyed(docs).join(wanted, ["oid", "tkey"]).dropDuplicates(["oid", "tkey"]).withColumn("p", F.split("text", r"(?<=\s)(?=\S)"))
    start = lambda h: F.length(F.array_join(F.slice(F.col("p"), 1, h["i"]), "")).cast("bigint")
    size = lambda h: F.length(F.rtrim(F.get(F.col("p"), h["i"]), F.lit(SPACE)))
    placed = F.transform("hits", lambda h: F.struct(start(h).alias("begin"), (start(h) + size(h)).alias("end"), h["confidence"].alias("confidence")))
    found = kept(texts.select("oid", "tkey", F.explode(placed).alias("x")).select("oid", "tkey", "x.*"), "found")
    held = base.select("oid", "tkey", F.col("begin").alias("b0"), F.col("end").alias("e0"))
    clash = (found["oid"] == held["oid"]) & (found["tkey"] == held["tkey"]) & (F.col("b0") < found["end"]) & (F.col("e0") > found["begin"])
    return found.join(held, clash, "left_anti")


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, spans (kind, begin, end; by kind as in KINDS, then begin): one row for each row of ``docs``."""
    found = located(docs)
    base = kept(spans(found), "spans")
    context = kept(context_spans(docs, base), "context")
    context = context.join(found.select("row", "oid", "tkey"), ["oid", "tkey"]).select("row", F.lit("context").alias("kind"), "begin", "end")
    every = base.select("row", "kind", "begin", "end").unionByName(context)
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    every = every.withColumn("span", F.struct(place.alias("no"), "begin", "end", "kind"))
    lists = every.groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("spans"))
    shape = "array<struct<kind:string,begin:bigint,end:bigint>>"
    out = found.select("row", "doc_id").join(lists, "row", "left")
    return out.select(
        "doc_id",
        F.coalesce(F.transform("spans", lambda s: F.struct(s["kind"], s["begin"], s["end"])).cast(shape), F.array().cast(shape)).alias("spans"),
    )


def digested(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, digest of the base spans and all spans as text."""

    def text(items: Column) -> Column:
        return F.array_join(F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")

    def of_kind(kind: str) -> Column:
        return F.filter("spans", lambda s: s["kind"] == kind)

    counts = [F.size(of_kind(k)).cast("bigint").alias(f"n_{k}") for k, _ in BASE]
    base = F.filter("spans", lambda s: s["kind"] != "context")
    return found.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
