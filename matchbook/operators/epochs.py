"""Time-split batch matching: bounded work per task for hot symbols.

Matching inside one symbol is sequential by definition (each order sees the
book its predecessors left), so a symbol cannot be salted across tasks. What
can be bounded is how much of it one task handles at once: the log is cut
into consecutive offset ranges ("epochs"); each epoch runs all books over its
range, starting from the books the previous epoch left. A range carries the
books of the whole log before it, and they grow with the log; so ranges are of
the given width at first and then as wide as a fixed share of that log. Ranges
of one width would carry rows in proportion to the square of the log. The end-of-epoch
books (flat header + resting-order rows, no arrays) and the epoch's output
are written to the shared checkpoint folder and read back, which cuts the
lineage: a lost executor costs one epoch, and a rerun of an epoch overwrites
its own folder. Offset-range filters reach the Parquet scan.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import KIND_BOOK, KIND_REST, TAGGED
from . import book as book_ops
from .snapshots import books_as_restore_rows

#: A range is at least 1 / ``SHARE`` as wide as the log before it.
SHARE = 2


def epoch_bounds(lo: int, hi: int, width: int, share: int = SHARE) -> list[tuple[int, int]]:
    """Inclusive offset ranges that cover lo .. hi, each a multiple of ``width`` wide: ``width``, or 1 / ``share`` of the log
    before it where that is more. Their number grows with the logarithm of the log's length, what all of them carry with the
    length, and their edges don't move when the log grows."""
    first = a = lo // width * width
    out = []
    while a <= hi:
        b = a + max((a - first) // share // width, 1) * width
        out.append((a, b - 1))
        a = b
    return out


def log_extent(requests: DataFrame, version: str | None) -> tuple[int | None, int | None, str]:
    """(least offset, greatest offset, version) of the log, in one pass. ``version``, where the caller has one that
    names the input (a table version, a list of files), spares the hash of the rows: only offsets are read then."""
    parts = [F.min("offset"), F.max("offset")]
    if version is None:
        row = F.xxhash64(*[F.col(c) for c in requests.columns]).cast("decimal(38,0)")
        parts += [F.count(F.lit(1)), F.sum(row)]
    lo, hi, *rest = requests.agg(*parts).first()
    return lo, hi, version if version is not None else repr([str(x) for x in rest])


def _committed(spark, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def match_in_epochs(requests: DataFrame, out_dir: str, width: int, snapshot_every: int = 0,
                    num_partitions: int | None = None, resume: bool = True, version: str | None = None) -> DataFrame:
    """Tagged output equal to ``match_batch(requests)``, computed one offset range (``epoch_bounds``) at a time, so that a
    range costs no more than in proportion to the books it carries, and all ranges together in proportion to the log.

    Fills, snapshots and rejects come from every epoch; ``rest`` and ``book``
    rows (the final books) from the last one. The epochs of a run lie in a
    folder of ``out_dir`` named after the input's version (see ``log_extent``), the ranges
    and the snapshot cadence. With ``resume``, epochs already committed there
    (``_SUCCESS`` present) are read back instead of recomputed, so a restarted
    driver continues after the last finished epoch; folders of another input
    or width are never read.
    """
    spark = requests.sparkSession
    lo, hi, version = log_extent(requests, version)
    ranges = epoch_bounds(lo, hi, width) if lo is not None else []
    name = hashlib.md5(repr((version, ranges, snapshot_every)).encode()).hexdigest()[:16]
    out_dir = os.path.join(out_dir, f"run-{name}")
    restored = None
    for k, (a, b) in enumerate(ranges):
        path = os.path.join(out_dir, f"epoch={k}")
        if not (resume and _committed(spark, path)):
            part = requests.filter(F.col("offset").between(a, b))
            tagged = book_ops.match_batch(part, restored, snapshot_every, num_partitions)
            tagged.write.mode("overwrite").parquet(path)
        done = spark.read.schema(TAGGED).parquet(path)
        restored = books_as_restore_rows(book_ops.book_headers(done), book_ops.resting_orders(done))
    last = len(ranges) - 1
    with_epoch = T.StructType(TAGGED.fields + [T.StructField("epoch", T.IntegerType())])
    if not ranges:
        return spark.createDataFrame([], TAGGED)
    out = spark.read.schema(with_epoch).parquet(out_dir)
    return out.filter(~F.col("kind").isin(KIND_REST, KIND_BOOK) | (F.col("epoch") == last)).drop("epoch")
