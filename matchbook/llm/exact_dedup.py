"""Exact dedup with a heavy-hitter split; DataFrame functions only.

Texts are equal when their UTF-8 bytes are (SHA-256). A Misra-Gries summary of the digests
(``DataFrame.stat.freqItems``: mergeable counters, one pass, at most ``1 / support`` of them) names every
digest that more than ``support`` of the rows carry. Its candidates are counted exactly; the verified
winners, at most ``1 / support`` small rows, are broadcast, and their rows are decided map-side without a
shuffle. All other digests, each of at most ``support`` of the rows, go through an ordinary aggregate
and join.

Defined results: a null text counts as the empty text; an empty table gives an empty table; among equal
texts the row with the largest ``doc_id`` stays (a null id is the smallest); of rows that repeat both the
text and the id, exactly one stays. Extra columns of any name are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchbook.llm.common import kept

#: A digest on more than this share of the rows is found for certain and split off.
SUPPORT = 1 / 2000
#: A candidate with fewer rows is left to the ordinary path.
MIN_ROWS = 32


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One narrow row for each document: id, SHA-256 of the text, and a row number that stays fixed
    because the table is written."""
    return kept(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("text_sha256"),
        ).withColumn("row_no", F.monotonically_increasing_id()),
        "digests",
    )


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("text_sha256").agg(
        F.count("*").alias("group_size"),
        F.max("doc_id").alias("keep_id"),
        F.max_by("row_no", F.coalesce("doc_id", F.lit(-(2**63)))).alias("keep_row"),
    )


def heavy_groups(rows: DataFrame, support: float = SUPPORT, min_rows: int = MIN_ROWS) -> DataFrame:
    """Verified heavy hitters: group figures of the frequent digests, at most ``1 / support`` rows."""
    candidates = rows.stat.freqItems(["text_sha256"], support).select(
        F.explode("text_sha256_freqItems").alias("text_sha256")
    )
    found = _groups(rows.join(F.broadcast(candidates), "text_sha256", "left_semi"))
    return kept(found.filter(F.col("group_size") >= min_rows), "heavy")


def decided(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The decision for each row of ``digests``: frequent digests map-side, the rest by a shuffle."""
    heavy = heavy_groups(rows, support)
    frequent = rows.join(F.broadcast(heavy), "text_sha256")
    others = rows.join(F.broadcast(heavy.select("text_sha256")), "text_sha256", "left_anti")
    rest = others.join(_groups(others), "text_sha256")
    return frequent.unionByName(rest).select(
        "doc_id", "keep_id", "group_size", (F.col("row_no") == F.col("keep_row")).alias("kept"), "text_sha256", "row_no"
    )


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", support: float = SUPPORT) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, row_no: one row for each row of ``docs``."""
    return decided(digests(docs, doc_id, text), support)


def drop_copies(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    marked = kept(
        docs.withColumns(
            {"__row": F.monotonically_increasing_id(), "__sha": F.sha2(F.coalesce("text", F.lit("")), 256)}
        ),
        "marked",
    )
    rows = marked.select("doc_id", F.col("__sha").alias("text_sha256"), F.col("__row").alias("row_no"))
    stay = decided(rows, support).filter("kept").select(F.col("row_no").alias("__row"))
    return marked.join(stay, "__row", "left_semi").drop("__row", "__sha")
