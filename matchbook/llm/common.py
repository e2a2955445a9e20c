"""Helpers shared by the corpus operators: shared-folder tables, Arrow text blocks, word and phrase hashes.

Nothing here keeps more than one Arrow batch in memory. Text is handled as the UTF-8 bytes of the
Arrow buffer; words are hashed with NumPy prefix sums, without making a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchbook.session import new_folder, ship_package

#: Odd 64-bit multipliers of the two polynomial hashes (bytes, words) and of the mixer.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95
WORD_BASE_2 = 0xAF251AF3B0F025B5
#: Bytes hashed at once; a longer document is hashed in several pieces.
PIECE = 1 << 18
#: Rows of an Arrow batch, at most.
BATCH_ROWS = 1000


def prepared(spark: SparkSession) -> SparkSession:
    """Ship the package to the Python workers and bound the rows of an Arrow batch (whole texts are wide rows;
    a batch lies in the JVM and in the worker at once). Every operator that runs Python calls this first."""
    ship_package(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def kept(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    The lineage is cut: a lost executor costs a re-read of files every executor can see. ``session.release`` deletes
    the files once the results are written.
    """
    spark = df.sparkSession
    path = new_folder(spark, f"llm-{tag}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def looked_up(rows: DataFrame, found: DataFrame, key: str, copies: str, total: int, share: int = 1000) -> DataFrame:
    """``rows`` joined to ``found``, which has one row for each value of ``key`` and counts its rows in ``copies``.

    A key of more than 1 / ``share`` of all ``total`` rows would be one long task of a shuffle: there are at most
    ``share`` such keys, whose rows are broadcast; the other keys are joined by a shuffle. ``rows`` is read twice.
    """
    often = F.col(copies) > max(total // share, 1)
    heavy = F.broadcast(found.filter(often))
    return rows.join(heavy, key).unionByName(rows.join(heavy.select(key), key, "left_anti").join(found.filter(~often), key))


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def text_blocks(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[tuple]:
    """Cut batches into runs of rows with at most ``limit`` bytes of text (one row at least).

    Yields (rows, bytes, offsets): the row slice, its texts' UTF-8 bytes, and where each text begins.
    A null text has no bytes.
    """
    try:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            texts = pc.fill_null(batch.column(batch.schema.get_field_index(column)).cast(pa.large_string()), "")
            buffers = texts.buffers()
            at = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + n + 1]
            data = np.frombuffer(buffers[2] if buffers[2] is not None else b"", np.uint8)
            begin = 0
            while begin < n:
                end = int(np.searchsorted(at, at[begin] + limit, "right")) - 1
                end = min(n, max(end, begin + 1))
                yield batch.slice(begin, end - begin), data[at[begin] : at[end]], at[begin : end + 1] - at[begin]
                begin = end
    finally:  # a worker is used again: give back what this task no longer holds
        released()


def released() -> None:
    """Return freed memory of Arrow's pools and of the allocator to the system."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (xor-shift and multiply, twice)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class PhraseHasher:
    """Hashes words of UTF-8 bytes and runs of words; the power tables grow with the longest run seen."""

    def __init__(self) -> None:
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        space = np.zeros(256, bool)
        space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
        self.letter = ~space

    def _powers(self, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = self.tables.get(base)
        if have is None or len(have[0]) < n:
            size = 1 << max(12, int(n).bit_length())
            have = powers(base, size), powers(pow(base, -1, 1 << 64), size)
            self.tables[base] = have
        return have

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each word, index of each text's first word). Words are maximal runs without
        ASCII white space; a text's end also ends its last word."""
        total = len(data)
        hashes, starts, begin = [], [], 0
        breaks = np.zeros(total + 1, bool)
        breaks[offsets] = True
        while begin < total:
            end = min(total, begin + PIECE)
            while end < total and self.letter[data[end]] and not breaks[end]:
                tail = data[end : end + PIECE]
                stop = np.flatnonzero(~self.letter[tail] | breaks[end : end + len(tail)])
                end = end + (int(stop[0]) if len(stop) else len(tail))
            part = data[begin:end]
            inside = self.letter[part]
            first = inside.copy()
            first[1:] &= ~inside[:-1] | breaks[begin + 1 : end]
            last = inside.copy()
            last[:-1] &= ~inside[1:] | breaks[begin + 1 : end]
            a, b = np.flatnonzero(first), np.flatnonzero(last) + 1
            up, down = self._powers(BYTE_BASE, len(part) + 1)
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
            hashes.append(mixed((sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)))
            starts.append(a + begin)
            begin = end
        at = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), np.searchsorted(at, offsets)

    def sums(self, words: np.ndarray, base: int = WORD_BASE) -> np.ndarray:
        """Prefix sums from which ``run`` takes the hash of any run of words."""
        up, _ = self._powers(base, len(words) + 1)
        out = np.zeros(len(words) + 1, np.uint64)
        np.cumsum(words * up[: len(words)], out=out[1:])
        return out

    def run(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int = WORD_BASE) -> np.ndarray:
        """Hash of the words begin..end-1, equal for equal runs wherever they stand."""
        _, down = self._powers(base, len(sums))
        return mixed((sums[end] - sums[begin]) * down[begin])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Least value of each ``width`` neighbours, by doubling."""
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have :])
    return out
