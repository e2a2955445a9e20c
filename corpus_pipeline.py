"""The corpus pipeline: language ID, exact dedup, MinHash near-dedup, benchmark decontamination, SentencePiece.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet and
reread as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchbook.llm import decontaminate, exact_dedup, language_id, near_dedup, sentencepiece
from matchbook.llm.common import kept, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language the network can't tell, go."""
    return language_id.keep_known(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the least doc_id stays."""
    return near_dedup.drop_near(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of ``benchmark`` go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digest of the token ids, digest of the text decoded from them."""
    return sentencepiece.encoded_digests(docs)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("benchmark_decontamination", without_benchmark),
    ("sentencepiece", tokenized),
]

#: Neither the trained network of the first stage nor piece merging can be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = kept(docs, f"stage-{name}")
    return docs
