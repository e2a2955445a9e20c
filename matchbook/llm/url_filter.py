"""URL filter: host/path rules, and gradient-boosted trees on lexical features for what no rule covers.

DataFrame functions and ``pyspark.ml`` only. The trees learn from labelled URLs: the caller's own, or else
the URLs that the rules themselves judge. Features of a URL: its length, path depth, digit ratio, character
entropy, number of query parameters, hyphens and subdomain labels, and statistics of its suffixes (share
of blocked labelled URLs with the same top-level domain, and with the same path ending, smoothed).

Defined results: a null URL or one without ``://`` has an empty host and path, meets no rule and is judged
by the trees; repeated rows are judged alike; without labelled URLs of both kinds the verdict is the kind
there is (``allow`` where there is none). Extra columns of any name are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchbook.llm.common import kept

#: (rule, verdict); a rule is a host, then the beginning of a path.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: Suffixes are counted by bucket, so that their table has at most so many rows and may be broadcast.
SUFFIX_BUCKETS = 4096
#: About so many labelled URLs, dealt out by hash, train the trees.
TRAIN_ROWS = 20_000
FEATURES = (
    "f_length", "f_host_length", "f_depth", "f_digit_ratio", "f_entropy", "f_params", "f_hyphens", "f_labels",
    "f_fragment", "f_host_suffix", "f_path_suffix",
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) as plain text functions; A-Z of the host in lower case."""
    rest = F.substring_index(url, "://", 1)
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.length(F.substring_index(url, "://", 1)) + 4, F.length(url)))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls; of equally long ones the first in text order."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (-len(r[0]), r[0]), reverse=True):
        domain, _, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits; 0 for the empty text."""
    chars = F.array_distinct(F.split(text, ""))
    n = F.length(text).cast("double")

    def share(c: Column) -> Column:
        return (n - F.length(F.replace(text, c, F.lit("")))) / n

    return F.when(
        n > 0, F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0.0), lambda s, c: s - share(c) * F.log2(share(c)))
    ).otherwise(0.0)


def _suffix(kind: str, text: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(kind), text), F.lit(SUFFIX_BUCKETS)).cast("int")


def lexical(pages: DataFrame, url: str = "url", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep``, url, host, path and the lexical features; no shuffle."""
    host, path = url_parts(F.col("url"))
    text = F.coalesce("url", F.lit(""))
    out = pages.select(*keep, F.col(url).cast("string").alias("url")).withColumns({"host": host, "path": path})
    return out.withColumns(
        {
            "f_length": F.length(text).cast("double"),
            "f_host_length": F.length("host").cast("double"),
            "f_depth": F.size(F.filter(F.split("path", "/"), lambda p: p != "")).cast("double"),
            "f_digit_ratio": F.length(F.regexp_replace(text, "[^0-9]", "")) / F.greatest(F.length(text), F.lit(1)),
            "f_entropy": entropy(text),
            "f_params": (F.length(text) - F.length(F.regexp_replace(text, "[=]", ""))).cast("double"),
            "f_hyphens": (F.length("host") - F.length(F.regexp_replace("host", "-", ""))).cast("double"),
            "f_labels": F.size(F.split("host", r"\.")).cast("double"),
            "f_fragment": F.locate("#", text).cast("boolean").cast("double"),
            "host_suffix": _suffix("host", F.substring_index("host", ".", -1)),
            "path_suffix": _suffix("path", F.regexp_extract("path", r"(\.[A-Za-z0-9]+|/[^/]*?[0-9]*|/)\z", 1)),
        }
    )


@dataclass
class UrlModel:
    """Trees, suffix statistics, and the share of blocked URLs among the labelled ones (null: none)."""

    trees: GBTClassificationModel | None
    suffixes: DataFrame
    blocked: float | None

    def with_suffixes(self, rows: DataFrame) -> DataFrame:
        prior = float(self.blocked or 0.0)
        for kind in ("host", "path"):
            side = self.suffixes.filter(F.col("kind") == kind).select(
                F.col("bucket").alias(f"{kind}_suffix"), F.col("share").alias(f"f_{kind}_suffix")
            )
            rows = rows.join(F.broadcast(side), f"{kind}_suffix", "left").fillna(prior, [f"f_{kind}_suffix"])
        return rows


def fit(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> UrlModel:
    """Learn from rows with url and label (1: block). Suffix statistics count every labelled row; the trees
    see about ``train_rows`` of them, chosen by the URL's hash."""
    rows = lexical(labelled.filter("label is not null"), keep=("label",))
    n, blocked = rows.agg(F.count("*"), F.sum(F.col("label").cast("double"))).first()
    share = float(blocked / n) if n else None
    smooth = F.lit(20.0)
    stats = (
        rows.select("label", F.explode(F.create_map(F.lit("host"), "host_suffix", F.lit("path"), "path_suffix")).alias("kind", "bucket"))
        .groupBy("kind", "bucket")
        .agg(((F.sum("label") + smooth * float(share or 0)) / (F.count("*") + smooth)).alias("share"))
    )
    model = UrlModel(None, kept(stats, "suffixes"), share)
    if not n or share in (0.0, 1.0):
        return model
    part = F.pmod(F.xxhash64("url"), F.lit(1 << 30)) < int(min(1.0, train_rows / n) * (1 << 30))
    sample = model.with_suffixes(rows.filter(part)).select(F.col("label").cast("double").alias("label"), *FEATURES)
    sample = kept(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample).select("label", "features").coalesce(8), "urls")
    if sample.select("label").distinct().count() == 2:
        model.trees = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.3, seed=7, maxMemoryInMB=64).fit(sample)
    return model


def judge(pages: DataFrame, rules=RULES, model: UrlModel | None = None, page_id: str = "page_id") -> DataFrame:
    """page_id, host, path, rule, verdict, and the trees' ``block_score`` (null without trees)."""
    if model is None:
        ruled = pages.select(F.col("url").cast("string").alias("url"))
        rule, verdict = rule_of(*url_parts(F.col("url")), rules)
        labelled = ruled.filter("url is not null").select("url", (verdict == "block").cast("int").alias("label"))
        model = fit(labelled)
    rows = lexical(pages, keep=(page_id,))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    if model.trees is None:
        rows = rows.withColumn("block_score", F.lit(None).cast("double"))
        other = F.lit("block" if (model.blocked or 0.0) > 0.5 else "allow")
    else:
        from pyspark.ml.functions import vector_to_array

        rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(model.with_suffixes(rows))
        rows = model.trees.transform(rows).withColumn("block_score", vector_to_array("probability")[1])
        other = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return rows.select(
        F.col(page_id).alias("page_id"), "host", "path", rule.alias("rule"), F.coalesce(verdict, other).alias("verdict"),
        "block_score",
    )
