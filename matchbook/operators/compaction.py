"""Compacted snapshot log: the latest snapshot of each symbol, kept up to date from the growing log.

The store keeps, by symbol bucket, each symbol's latest header and the steps that still matter: the last step of
every order that rests at the header, and all steps after it. A compaction reads the log batches it has not seen,
rewrites only the buckets in which a symbol has a newer header or a new step, into a new generation, and names the
generation of every bucket in a pointer that is written last. A compaction that dies leaves no pointer: its files are
overwritten by the next one, and readers go on with the old generation.
"""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ORDER_STEP, ORDER_STEP_COLUMNS, SNAPSHOT_HEADER, SNAPSHOT_HEADER_COLUMNS
from .lifetimes import books_of_latest
from .snapshots import latest_snapshots
from .trades import _exists

BUCKETS = 32
HEADERS, ORDERS, DONE, POINTERS = "headers", "orders", "done", "pointers"
BATCH = T.StructType([T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType())])


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("symbol"), F.lit(buckets)).cast("int")


def _pointers(spark: SparkSession, store: str) -> list[int]:
    """Committed generations, ascending."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(os.path.join(store, POINTERS))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(int(n[2:]) for n in names if n.startswith("v=") and _exists(spark, os.path.join(store, POINTERS, n, "_SUCCESS")))


def current(spark: SparkSession, store: str) -> dict:
    """The pointer: ``generation``, ``buckets`` (their number), and ``at`` (bucket -> generation that holds it)."""
    found = _pointers(spark, store)
    if not found:
        return {"generation": -1, "buckets": None, "at": {}}
    return json.loads(spark.read.text(os.path.join(store, POINTERS, f"v={found[-1]}")).first().value)


def _read(spark: SparkSession, store: str, kind: str, schema: T.StructType, at: dict[str, int]) -> DataFrame:
    paths = [os.path.join(store, kind, f"gen={g}", f"bucket={b}") for b, g in sorted(at.items())]
    paths = [p for p in paths if _exists(spark, p)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def read_compacted(spark: SparkSession, store: str) -> tuple[DataFrame, DataFrame]:
    """(latest header of each symbol, steps): what ``lifetimes.books_of_latest`` takes."""
    at = current(spark, store)["at"]
    return _read(spark, store, HEADERS, SNAPSHOT_HEADER, at), _read(spark, store, ORDERS, ORDER_STEP, at)


def compacted_books(spark: SparkSession, store: str) -> DataFrame:
    """The resting orders of every symbol's latest snapshot (BOOK_COLUMNS)."""
    return books_of_latest(*read_compacted(spark, store))


def still_needed(headers: DataFrame, steps: DataFrame) -> DataFrame:
    """The steps that the books of ``headers`` (one for each symbol) and of any later snapshot are made of."""
    heads = headers.select(F.col("symbol").alias("_symbol"), F.col("orderbook_seq").alias("_at"))
    joined = steps.distinct().join(heads, F.col("symbol") == F.col("_symbol"), "left")
    later = F.col("_at").isNull() | (F.col("book_seq") > F.col("_at"))
    own = Window.partitionBy("symbol", "seq", "_later").orderBy(F.desc("book_seq"))
    ranked = joined.withColumn("_later", later).withColumn("_no", F.row_number().over(own))
    return ranked.filter(F.col("_later") | ((F.col("_no") == 1) & (F.col("size") > 0))).select(*ORDER_STEP_COLUMNS)


def compact(spark: SparkSession, snapshots: DataFrame, orders: DataFrame, store: str, buckets: int = BUCKETS) -> list[int]:
    """Bring the store up to date with the log (``snapshots`` and ``orders`` as the stream sink writes them, with
    run_id and batch_id); returns the buckets that were rewritten."""
    now = current(spark, store)
    buckets, generation = now["buckets"] or buckets, now["generation"] + 1
    kept = [os.path.join(store, DONE, f"gen={g}") for g in _pointers(spark, store)]
    done = spark.read.schema(BATCH).parquet(*kept) if kept else spark.createDataFrame([], BATCH)
    new_heads, new_steps = (d.join(done, ["run_id", "batch_id"], "left_anti").withColumn("bucket", _bucket(buckets)) for d in (snapshots, orders))
    batches = new_heads.select("run_id", "batch_id").unionByName(new_steps.select("run_id", "batch_id")).distinct()
    batches.write.mode("overwrite").parquet(os.path.join(store, DONE, f"gen={generation}"))
    batches = spark.read.schema(BATCH).parquet(os.path.join(store, DONE, f"gen={generation}"))
    if not batches.limit(1).count():
        return []
    # only the batches named in this generation, also if the log grows meanwhile
    new_heads, new_steps = (d.join(batches, ["run_id", "batch_id"], "left_semi") for d in (new_heads, new_steps))
    changed = sorted(r.bucket for r in new_heads.select("bucket").unionByName(new_steps.select("bucket")).distinct().collect())
    old = {b: g for b, g in now["at"].items() if int(b) in set(changed)}
    heads = _read(spark, store, HEADERS, SNAPSHOT_HEADER, old).select(*SNAPSHOT_HEADER_COLUMNS).unionByName(new_heads.select(*SNAPSHOT_HEADER_COLUMNS))
    heads = latest_snapshots(heads).withColumn("bucket", _bucket(buckets))
    place = os.path.join(store, HEADERS, f"gen={generation}")
    heads.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(place)
    heads = spark.read.schema(SNAPSHOT_HEADER).parquet(place)
    steps = _read(spark, store, ORDERS, ORDER_STEP, old).unionByName(new_steps.select(*ORDER_STEP_COLUMNS))
    steps = still_needed(heads, steps).withColumn("bucket", _bucket(buckets))
    # a bucket's steps are dealt by order as well: no task holds a whole symbol
    (steps.repartition("bucket", F.pmod("seq", F.lit(8))).write.mode("overwrite").partitionBy("bucket")
     .parquet(os.path.join(store, ORDERS, f"gen={generation}")))
    pointer = {"generation": generation, "buckets": buckets, "at": now["at"] | {str(b): generation for b in changed}}
    _swap(spark, store, pointer)
    return changed


def _swap(spark: SparkSession, store: str, pointer: dict) -> None:
    """Commit a generation: readers follow the pointer of the highest number that was written whole."""
    path = os.path.join(store, POINTERS, f"v={pointer['generation']}")
    spark.range(1).select(F.lit(json.dumps(pointer)).alias("value")).write.mode("overwrite").text(path)
