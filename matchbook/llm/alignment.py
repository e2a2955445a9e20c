"""Alignment of the tokens of two tokenizers over the same bytes, each distinct text worked on once.

Tokenizer A is byte-level merging (the vocabulary of a ``tokenizers`` file, read as ranks), tokenizer B a
SentencePiece model that puts a space in front; so A encodes a space and the text, B the text. The byte offsets
where a token of A and a token of B both end cut the two rows of tokens into groups, and the two tokens that end
at such an offset are a link.

Texts are shuffled whole, so equal texts meet and are counted (map side first); each distinct text is encoded and
aligned once, and what it adds to the corpus-wide count of an (A, B) id pair is weighted by how many documents have
it. Pair counts are an aggregate by pair. They go back to the texts by broadcast while they are at most
``PAIRS_AT_ONCE``, else by a join whose pairs are dealt over ``SALTS`` keys each (a frequent pair is in every
text). The measures of a text reach its documents by the digest of the text.

Results, one row for each row of ``docs``: doc_id, n_a, n_b (tokens), n_groups, n_links, n_best (links whose pair
count is the highest of their B id, ties included), count_sum (sum of the pair counts over the links),
groups_sha256 (digest of ``a1,a2|b1;a3|b2,b3``). Defined results: a text that is null or empty, or whose joined
bytes of A or of B differ from a space and the text, has no tokens: zeros and the empty string; repeated rows and
ids are results of their own and count as often as they occur; an empty table gives an empty table. Extra columns
of any name are ignored. Texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchbook.llm.common import kept, looked_up, prepared, released

#: Bytes of text aligned at once (one text at least).
BLOCK = 1 << 20
#: Largest pair table that is sent to every task (24 bytes a pair).
PAIRS_AT_ONCE = 1 << 20
SALTS = 32
#: The split of text before merging that the byte-level vocabulary was made with (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def default_paths() -> tuple[str, str]:
    """Paths of the two public vocabularies installed with Python."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves, the others,
    in order, for the letters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Aligner:
    """Both tokenizers and the tables of their tokens' bytes; made in a worker from the files' contents."""

    def __init__(self, file_a: bytes, file_b: bytes) -> None:
        import sentencepiece
        import tiktoken

        spec, letters = json.loads(file_a), byte_letters()
        special = {t["content"] for t in spec["added_tokens"] if t["special"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=file_b)
        self.n_a, self.n_b = max(ranks.values()) + 1, self.b.get_piece_size()
        bytes_a = [b""] * self.n_a
        for token, i in ranks.items():
            bytes_a[i] = token
        bytes_b = []
        for i in range(self.n_b):
            piece = self.b.id_to_piece(i)
            bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.bytes = pa.array(bytes_a, pa.large_binary()), pa.array(bytes_b, pa.large_binary())
        n = max(self.n_a, self.n_b)
        self.n = n
        self.written = pa.array([f"{i}{end}" for end in ",|;" for i in range(n)], pa.large_binary())

    @staticmethod
    def flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        edge = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
        return np.fromiter((i for x in ids for i in x), np.int64, edge[-1]), edge

    def spelled(self, side: int, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The joined bytes of tokens, and where each token begins in them (and the end)."""
        return joined(self.bytes[side], ids)

    def align(self, texts: list[str]) -> dict[str, np.ndarray | list]:
        """n_a, n_b, n_groups, groups_sha256 of each text; pairs (a * n_b + b) with ``times``, and their edges by text."""
        a, edge_a = self.flat([self.a.encode_ordinary(" " + t) for t in texts])
        b, edge_b = self.flat(self.b.encode(texts, num_threads=1))
        text_a, at_a = self.spelled(0, a)
        text_b, at_b = self.spelled(1, b)
        good = np.zeros(len(texts), bool)
        for i, t in enumerate(texts):
            whole = (" " + t).encode()
            good[i] = bool(t) and all(
                text[at[edge[i]] : at[edge[i + 1]]] == whole for text, at, edge in ((text_a, at_a, edge_a), (text_b, at_b, edge_b))
            )
        n_a, n_b = np.diff(edge_a) * good, np.diff(edge_b) * good
        keep_a, keep_b = np.repeat(good, np.diff(edge_a)), np.repeat(good, np.diff(edge_b))
        a, b, size_a, size_b = a[keep_a], b[keep_b], np.diff(at_a)[keep_a], np.diff(at_b)[keep_b]
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)  # the same bytes lie under both
        last_a, last_b = np.isin(end_a, end_b, assume_unique=True), np.isin(end_b, end_a, assume_unique=True)
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        n = int(last_a.sum())
        first_a, first_b = np.searchsorted(group_a, np.arange(n + 1)), np.searchsorted(group_b, np.arange(n + 1))
        # where each token stands when every group's A tokens are followed by its B tokens
        place_a, place_b = np.arange(len(a)) + first_b[group_a], np.arange(len(b)) + first_a[group_b + 1]
        code = np.empty(len(a) + len(b), np.int64)
        code[place_a] = a + last_a * self.n
        code[place_b] = b + last_b * 2 * self.n
        written, at = joined(self.written, code)
        edge = np.concatenate([[0], np.cumsum(n_a + n_b)])
        digests = [hashlib.sha256(written[at[x] : at[y] - 1]).hexdigest() if y > x else "" for x, y in zip(edge, edge[1:], strict=False)]
        doc = np.repeat(np.arange(len(texts)), n_a)[last_a]
        key, times = np.unique((doc * self.n_a + a[last_a]) * self.n_b + b[last_b], return_counts=True)
        owner, pair = np.divmod(key, self.n_a * self.n_b)
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": np.bincount(doc, minlength=len(texts)), "groups_sha256": digests,
            "pairs": pair, "times": times, "edge": np.searchsorted(owner, np.arange(len(texts) + 1)),
        }


def joined(table: pa.Array, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The entries ``ids`` of a table of byte strings, joined, and where each begins (and the end)."""
    taken = table.take(pa.array(ids))
    _, at, data = taken.buffers()
    return memoryview(data if data is not None else b"").cast("B"), np.frombuffer(at, np.int64, len(ids) + 1) if len(ids) else np.zeros(1, np.int64)


def _blocks(batches, column: str):
    """Runs of rows with at most ``BLOCK`` bytes of text (one row at least)."""
    try:
        for batch in batches:
            sizes = np.cumsum(pc.binary_length(batch.column(batch.schema.get_field_index(column))).to_numpy(zero_copy_only=False).astype(np.int64))
            begin = 0
            while begin < batch.num_rows:
                done = sizes[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(sizes, done + BLOCK, "right")))
                yield batch.slice(begin, end - begin)
                begin = end
    finally:
        released()


def aligned_texts(texts: DataFrame, paths: tuple[str, str]) -> DataFrame:
    """Of each row (text, copies): key (digest), copies, n_a, n_b, n_groups, groups_sha256, pairs and times."""
    files = []
    for path in paths:
        with open(path, "rb") as f:
            files.append(f.read())
    sent = texts.sparkSession.sparkContext.broadcast(tuple(files))

    def run(batches):
        aligner = None
        for rows in _blocks(batches, "text"):
            aligner = aligner or Aligner(*sent.value)
            found = aligner.align(rows.column(2).to_pylist())
            edge = pa.array(found["edge"].astype(np.int32))
            lists = [pa.ListArray.from_arrays(edge, pa.array(found[c])) for c in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), *(pa.array(found[c]) for c in ("n_a", "n_b", "n_groups", "groups_sha256")), *lists],
                names=["key", "copies", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"],
            )

    return texts.select("key", "copies", "text").mapInArrow(
        run, "key binary, copies bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"
    )


def pair_counts(aligned: DataFrame, n_b: int) -> DataFrame:
    """pair (a * n_b + b), n: links of the whole corpus that hold it; best: no A id has more with its B id."""
    rows = aligned.select("copies", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    counts = kept(rows.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum(F.col("x.times") * F.col("copies")).alias("n")), "pairs")
    counts = counts.withColumn("b", F.col("pair") % n_b)
    return counts.join(counts.groupBy("b").agg(F.max("n").alias("top")), "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _scored_by_broadcast(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    spark = aligned.sparkSession
    found = counts.toArrow().sort_by("pair")
    sent = spark.sparkContext.broadcast(tuple(found.column(c).to_numpy() for c in ("pair", "n", "best")))

    def run(batches):
        pair, n, best = sent.value
        for batch in batches:
            lists, times = (batch.column(i) for i in (1, 2))
            edge = lists.offsets.to_numpy().astype(np.int64)
            at = np.searchsorted(pair, lists.flatten().to_numpy())
            weight = times.flatten().to_numpy()
            sums = [np.concatenate([[0], np.cumsum(x)]) for x in (weight * best[at], weight * n[at])]
            edge -= edge[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array((s[edge[1:]] - s[edge[:-1]]).astype(np.int64)) for s in sums)], names=["key", "n_best", "count_sum"]
            )

    return aligned.select("key", "pairs", "times").mapInArrow(run, "key binary, n_best bigint, count_sum bigint")


def _scored_by_join(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    rows = aligned.select("key", F.posexplode(F.arrays_zip("pairs", "times")).alias("i", "x"))
    rows = rows.select("key", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"), F.pmod(F.xxhash64("key"), F.lit(SALTS)).alias("salt"))
    salted = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
    met = rows.join(salted, ["pair", "salt"])
    sums = met.groupBy("key").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum")
    )
    none = aligned.filter(F.size("pairs") == 0).select("key", F.lit(0).cast("bigint").alias("n_best"), F.lit(0).cast("bigint").alias("count_sum"))
    return sums.unionByName(none)


def text_key(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def align(docs: DataFrame, paths: tuple[str, str] | None = None, at_once: int = PAIRS_AT_ONCE) -> DataFrame:
    """doc_id and the measures of its text, for each row of ``docs``; see the module's docstring."""
    spark = prepared(docs.sparkSession)
    paths = paths or default_paths()
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = rows.filter("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    aligned = kept(aligned_texts(texts.withColumn("key", text_key(F.col("text"))), paths), "aligned")
    import sentencepiece

    n_b = sentencepiece.SentencePieceProcessor(model_file=paths[1]).get_piece_size()
    counts = kept(pair_counts(aligned, n_b), "pair-counts")
    score = _scored_by_broadcast if counts.count() <= at_once else _scored_by_join
    own = aligned.select("key", "copies", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "groups_sha256")
    measured = kept(own.join(score(aligned, counts), "key"), "measures")
    named = kept(rows.select("doc_id", text_key(F.col("text")).alias("key"), (F.col("text") == "").alias("blank")), "named")
    total = named.count()
    columns = ["doc_id", *MEASURES, "groups_sha256"]
    found = looked_up(named.filter("not blank").select("doc_id", "key"), measured, "key", "copies", total).select(*columns)
    zeros = [F.lit(0).cast("bigint").alias(c) for c in MEASURES]
    return found.unionByName(named.filter("blank").select("doc_id", *zeros, F.lit("").alias("groups_sha256")))
