"""Driver queries of the corpus operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchbook.llm import alignment as _alignment
from matchbook.llm import decontaminate as _decontaminate
from matchbook.llm import exact_dedup as _exact
from matchbook.llm import language_id as _language
from matchbook.llm import lexical_search as _search
from matchbook.llm import near_dedup as _near
from matchbook.llm import pii as _pii
from matchbook.llm import quality as _quality
from matchbook.llm import sentencepiece as _pieces
from matchbook.llm import simhash as _simhash
from matchbook.llm import substring_dedup as _substring
from matchbook.llm import toxicity as _toxicity
from matchbook.llm import url_filter as _urls
from matchbook.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces.encoded_digests(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pii.digested(_pii.personal_data(table(spark, sf_dir, "documents")))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _urls.judge(table(spark, sf_dir, "pages"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _substring.substring_dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact.exact_dedup(table(spark, sf_dir, "documents")).drop("row_no")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _language.language_id(table(spark, sf_dir, "documents"))


def op9_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near.near_dedup(table(spark, sf_dir, "documents")).drop("oid", "tkey")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search.lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _simhash.simhash_dedup(table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alignment.align(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_personal_data": op3_personal_data,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_url_filter": op5_url_filter,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_language_id": op8_language_id,
    "op9_minhash_near_dedup": op9_minhash_near_dedup,
    "op10_quality": op10_quality,
    "op11_lexical_search": op11_lexical_search,
    "op12_simhash_near_dedup": op12_simhash_near_dedup,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}

ORACLE = {
    "op11_lexical_search": _search.SQL,
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
    """,
}
