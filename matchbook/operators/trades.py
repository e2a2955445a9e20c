"""Trades table: insert-if-absent by execution id, and the queries over it.

The table is plain Parquet partitioned by ``run_id``, ``batch_id``
and ``id_bucket`` (hash of the execution id). A micro-batch is written with dynamic
partition overwrite, so replaying the same batch of the same run rewrites only its own
partitions; another run, whose batch ids start at 0 again, never touches them. Ids
already present from *other* batches or runs are removed by an anti-join on
``(id_bucket, execution_id)`` first. Within a batch the first row per id wins
(by stream position), chosen with an aggregate, not a window: the map-side
partial aggregate collapses copies of an id before the shuffle.

Beside the table lies an id index: for each batch and bucket, pages of 64-bit hashes of the stored ids. A new batch asks
the index which stored batches may hold one of its ids and reads the ids of those alone; a batch of new ids reads none,
however many ids it and the table have. The index has no false negatives, so the result is that of the full anti-join.
It is written before the rows it speaks of.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.unsigned import is_wide
from ..schemas import MAX_BIGINT, TRADES_COLUMNS, TRADES_TABLE
from ..session import new_folder

ID_BUCKETS = 16
EPOCH = "1970-01-01 00:00:00"

# Stored layout: table columns plus the partition columns.
STORED = T.StructType(TRADES_TABLE.fields + [T.StructField("run_id", T.StringType()),
                                             T.StructField("batch_id", T.LongType()),
                                             T.StructField("id_bucket", T.IntegerType())])
STAGE_TABLE = "table"
#: Folder of the id index inside the table's folder (a leading underscore hides it from the table).
ID_INDEX = "_ids"
INDEX = T.StructType([T.StructField("id_bucket", T.IntegerType()), T.StructField("pages", T.LongType()),
                      T.StructField("page", T.LongType()), T.StructField("hashes", T.ArrayType(T.LongType())),
                      T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType())])
#: Ids meant for a page.
IDS_PER_PAGE = 1 << 11
#: Rows of a batch meant for a task.
ROWS_PER_TASK = 1 << 15
#: Stored batches that are named one by one in a filter; beyond that every stored id is read.
OPEN_AT_ONCE = 1000


def table_rows(executions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Project executions to table columns; split off rows without a symbol, price or size, and those whose price or
    size is beyond BIGINT (only executions that carry ``decimal(20,0)`` can have such).

    The stored columns are STRING, so texts of any length are kept.
    """
    rows = executions.select(
        "execution_id", "symbol", "price", "size", "bid_request_id", "ask_request_id",
        F.coalesce(F.col("executed_at").cast("timestamp_ntz"), F.lit(EPOCH).cast("timestamp_ntz"))
        .alias("executed_at"),
        *[c for c in ("partition", "offset", "fill_no") if c in executions.columns],
    )
    empty: Column = F.col("symbol").isNull() | F.col("price").isNull() | F.col("size").isNull()
    beyond = F.lit(False)
    for c in ("price", "size"):
        if is_wide(rows, c):
            beyond = beyond | F.coalesce(F.col(c) > MAX_BIGINT, F.lit(False))
    judged = rows.withColumn("reason", F.when(empty, F.lit("not_null")).when(beyond, F.lit("out_of_range")))
    good = judged.filter("reason is null").drop("reason").withColumns({c: F.col(c).cast("long") for c in ("price", "size") if is_wide(rows, c)})
    return good, judged.filter("reason is not null")


def table_rejects(executions: DataFrame) -> DataFrame:
    """Quarantine rows (REJECT columns) of the executions that the table refuses."""
    bad = table_rows(executions)[1]
    place = [F.col(c) if c in bad.columns else F.lit(None).cast(t).alias(c)
             for c, t in (("partition", "int"), ("offset", "long"))]
    return bad.select(F.lit(STAGE_TABLE).alias("stage"), "reason", *place,
                      F.col("execution_id").alias("raw"))


def first_per_id(rows: DataFrame, order_by: list[str]) -> DataFrame:
    """First row per execution id in ``order_by`` order (insert-if-absent within one batch)."""
    value_cols = [c for c in rows.columns if c != "execution_id"]
    picked = rows.groupBy("execution_id").agg(
        F.min_by(F.struct(*value_cols), F.struct(*order_by)).alias("r"))
    return picked.select("execution_id", "r.*")


def _with_bucket(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("id_bucket", F.pmod(F.xxhash64("execution_id"), F.lit(buckets)).cast("int"))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def _id_hash() -> Column:
    """What the index keeps of an id; another hash than those of its bucket and page."""
    return F.xxhash64("execution_id", F.lit("bits"))


def _page(pages: Column) -> Column:
    """An id's page; another hash than that of its bucket, which would put a bucket's ids into one page."""
    return F.pmod(F.xxhash64("execution_id", F.lit("page")), pages)


def pages_for(ids: int, buckets: int) -> int:
    """Pages of a bucket (a power of two) for a batch of ``ids`` ids."""
    return 1 << max(0, (max(ids, 1) // (buckets * IDS_PER_PAGE)).bit_length())


def tasks_for(rows: int) -> int:
    """Tasks that shall hold a batch of ``rows`` rows."""
    return max(1, -(-rows // ROWS_PER_TASK))


def id_pages(rows: DataFrame, pages: int) -> DataFrame:
    """id_bucket, pages, page, hashes: the index of the ids in ``rows``, ``pages`` pages for each bucket."""
    hashed = rows.select("id_bucket", F.lit(pages).cast("long").alias("pages"), _page(F.lit(pages)).alias("page"), _id_hash().alias("hash"))
    return hashed.groupBy("id_bucket", "pages", "page").agg(F.collect_list("hash").alias("hashes"))


def batches_that_may_hold(rows: DataFrame, index: DataFrame, own_pages: int = 1) -> DataFrame:
    """run_id, batch_id of the index's batches that may hold an id of ``rows`` (execution_id, id_bucket).

    The ids asked for are put into pages too and compared page by page, so each stored batch costs a pass over its hashes
    and not a test of every row. ``own_pages`` (a power of two) is the least number of pages they are put into; pages of
    a stored batch that has fewer are compared with several of them.
    """
    sizes = [r.pages for r in index.select("pages").distinct().collect()]  # powers of two: a few values
    if not sizes:
        return index.select("run_id", "batch_id")
    asked = rows.select("execution_id", "id_bucket", F.explode(F.array(*[F.lit(n).cast("long") for n in sizes])).alias("pages"))
    own = _page(F.greatest(F.col("pages"), F.lit(own_pages).cast("long")))
    asked = asked.select("id_bucket", "pages", own.alias("own_page"), _id_hash().alias("hash"))
    asked = asked.groupBy("id_bucket", "pages", "own_page").agg(F.collect_list("hash").alias("asked")).withColumn("page", F.col("own_page") % F.col("pages"))
    held = F.coalesce(F.arrays_overlap("asked", "hashes"), F.lit(True))  # an index of older make has no hashes: look
    return asked.join(index, ["id_bucket", "pages", "page"]).filter(held).select("run_id", "batch_id").distinct()


def _stored_ids(spark: SparkSession, path: str, rows: DataFrame, other: Column, pages: int) -> DataFrame | None:
    """id_bucket, execution_id of the stored batches (those that ``other`` admits) that may hold an id of ``rows``."""
    index = spark.read.schema(INDEX).parquet(os.path.join(path, ID_INDEX)).filter(other)
    found = batches_that_may_hold(rows, index, pages).limit(OPEN_AT_ONCE + 1).collect()
    if not found or not _exists(spark, path):
        return None
    stored = spark.read.schema(STORED).parquet(path).filter(other)
    if len(found) <= OPEN_AT_ONCE:
        runs: dict[str, list[int]] = {}
        for r in found:
            runs.setdefault(r.run_id, []).append(r.batch_id)
        named = F.lit(False)
        for run, batches in runs.items():
            named = named | ((F.col("run_id") == run) & F.col("batch_id").isin(batches))
        stored = stored.filter(named)
    return stored.select("id_bucket", "execution_id")


def insert_trades(spark: SparkSession, executions: DataFrame, path: str, batch_id: int,
                  buckets: int = ID_BUCKETS, run_id: str = "0", table: str | None = None, tasks: int | None = None) -> DataFrame:
    """Append one batch of executions to the table at ``path``, skipping ids already stored.

    Returns the rejected rows (NOT NULL and BIGINT violations) for the quarantine (see ``table_rejects``).
    Safe to call again with the same ``run_id`` and ``batch_id`` (a replay rewrites itself).
    One task writes each bucket of a batch. With ``table`` the batch's partitions are also added to the catalog
    table of that name (made if absent), so that it shows the batch as soon as it is written. ``tasks`` is the most tasks
    that hold the batch's rows (see ``tasks_for``): these rows are gone over several times, and a small batch in as many
    tasks as the session's shuffles have costs more to schedule than to do.
    """
    good, bad = table_rows(executions)
    order = [c for c in ("partition", "offset", "fill_no") if c in good.columns] or ["executed_at"]
    rows = _with_bucket(first_per_id(good, order), buckets).select(*TRADES_COLUMNS, "id_bucket")
    rows = (rows if tasks is None else rows.coalesce(tasks)).persist()
    fresh = rows
    try:
        pages = pages_for(rows.count(), buckets)
        index = os.path.join(path, ID_INDEX)
        if _exists(spark, index):
            stored = _stored_ids(spark, path, rows, (F.col("run_id") != F.lit(run_id)) | (F.col("batch_id") != F.lit(batch_id)), pages)
            if stored is not None:
                fresh = rows.join(stored, ["id_bucket", "execution_id"], "left_anti").persist()
        own = {"run_id": F.lit(run_id), "batch_id": F.lit(batch_id).cast("long")}
        (id_pages(fresh, pages).withColumns(own).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id", "batch_id").parquet(index))
        placed = fresh.withColumns(own).select(*[f.name for f in STORED.fields]).repartition(buckets, "id_bucket")
        (placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id", "batch_id", "id_bucket").parquet(path))
        if table is not None:
            _commit_partitions(spark, fresh, path, table, run_id, batch_id)
    finally:
        fresh.unpersist()
        rows.unpersist()
    return bad


def _commit_partitions(spark: SparkSession, rows: DataFrame, path: str, table: str, run_id: str, batch_id: int) -> None:
    """Tell the catalog which partitions a batch wrote (at most one for each bucket); known ones stay."""
    ensure_trades_table(spark, path, table)
    run = run_id.replace("\\", "\\\\").replace("'", "\\'")
    named = [f"PARTITION (run_id='{run}', batch_id={int(batch_id)}, id_bucket={r.id_bucket})" for r in rows.select("id_bucket").distinct().collect()]
    if named:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(named)}")
    spark.catalog.refreshTable(table)


def ensure_trades_table(spark: SparkSession, path: str, name: str = "trades") -> None:
    """CREATE TABLE IF NOT EXISTS over the table folder (columns per the trades DDL)."""
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {name} (
          execution_id STRING, symbol STRING, price BIGINT, size BIGINT,
          bid_request_id STRING, ask_request_id STRING, executed_at TIMESTAMP_NTZ,
          run_id STRING, batch_id BIGINT, id_bucket INT)
        USING parquet PARTITIONED BY (run_id, batch_id, id_bucket) LOCATION '{path}'""")


def read_trades(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(path).select(*TRADES_COLUMNS)


def trade_count(trades: DataFrame) -> DataFrame:
    return trades.agg(F.count(F.lit(1)).alias("trade_count"))


def recent_trades(trades: DataFrame, n: int, nulls_first: bool, columns: list[str] | None = None) -> DataFrame:
    """Latest ``n`` trades by execution time; execution id breaks ties (top-k, no full sort)."""
    ts = F.col("executed_at")
    key = ts.desc_nulls_first() if nulls_first else ts.desc_nulls_last()
    return trades.orderBy(key, F.col("execution_id").asc()).limit(n).select(*(columns or TRADES_COLUMNS))


def table_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (``session.release`` deletes it)."""
    return new_folder(spark, name)
