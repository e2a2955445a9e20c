"""Trades table: insert-if-absent, replays, NULL handling, top-k NULL order."""

import datetime as dt
import os

from pyspark.sql import functions as F

from matchbook.operators import trades

COLS = "symbol string, price long, size long, bid_request_id string, ask_request_id string, " \
       "executed_at timestamp_ntz, execution_id string, partition int, offset long, fill_no int"


def ex(spark, rows):
    return spark.createDataFrame(rows, COLS)


def t(s):
    return dt.datetime(2024, 1, 1, 0, 0, s)


def test_replay_same_batch_is_idempotent(spark, scratch):
    path = os.path.join(scratch, "trades")
    b0 = ex(spark, [("A", 1, 1, "b1", "a1", t(1), "b1-a1", 0, 1, 0), ("A", 1, 2, "b2", "a1", t(2), "b2-a1", 0, 2, 0)])
    trades.insert_trades(spark, b0, path, 0)
    trades.insert_trades(spark, b0, path, 0)
    assert trades.read_trades(spark, path).count() == 2


def test_first_row_per_id_wins(spark, scratch):
    path = os.path.join(scratch, "trades")
    trades.insert_trades(spark, ex(spark, [("A", 1, 1, "b1", "a1", t(1), "b1-a1", 0, 1, 0)]), path, 0)
    # later batch re-delivers the same id with other values, plus a new one twice within the batch
    b1 = ex(spark, [("A", 9, 9, "b1", "a1", t(9), "b1-a1", 0, 1, 0),
                    ("A", 5, 5, "b3", "a3", t(5), "b3-a3", 0, 3, 1),
                    ("A", 6, 6, "b3", "a3", t(6), "b3-a3", 0, 3, 0)])
    trades.insert_trades(spark, b1, path, 1)
    got = {r.execution_id: (r.price, r.size) for r in trades.read_trades(spark, path).collect()}
    assert got == {"b1-a1": (1, 1), "b3-a3": (6, 6)}


def test_missing_time_is_epoch_and_bad_rows_are_returned(spark, scratch):
    path = os.path.join(scratch, "trades")
    bad = trades.insert_trades(spark, ex(spark, [
        ("A", 1, 1, "b1", "a1", None, "b1-a1", 0, 1, 0),
        (None, 1, 1, "b2", "a2", t(1), "b2-a2", 0, 2, 0),
        ("X" * 51, 1, 1, "b3", "a3", t(1), "b3-a3", 0, 3, 0)]), path, 0)
    got = trades.read_trades(spark, path).collect()
    # a long symbol is stored: the columns are STRING; rows in = rows stored + rows returned
    assert sorted((r.execution_id, str(r.executed_at)) for r in got) == [
        ("b1-a1", "1970-01-01 00:00:00"), ("b3-a3", "2024-01-01 00:00:01")]
    assert bad.count() == 1


def test_recent_trades_null_placement(spark):
    tbl = spark.createDataFrame([("e1", "A", 1, 1, "b", "a", t(1)), ("e0", "A", 1, 1, "b", "a", None),
                                 ("e2", "A", 1, 1, "b", "a", t(2)), ("e3", "A", 1, 1, "b", "a", t(2))],
                                "execution_id string, symbol string, price long, size long, bid_request_id string, "
                                "ask_request_id string, executed_at timestamp_ntz")
    first = [r.execution_id for r in trades.recent_trades(tbl, 3, nulls_first=True).collect()]
    last = [r.execution_id for r in trades.recent_trades(tbl, 3, nulls_first=False).collect()]
    assert first == ["e0", "e2", "e3"]
    assert last == ["e2", "e3", "e1"]
    assert trades.trade_count(tbl).first().trade_count == 4


def batch_of(spark, ids, first=0):
    return ex(spark, [("A", 1, i + 1, f"b{i}", f"a{i}", t(i % 60), f"b{i}-a{i}", 0, first + k, 0) for k, i in enumerate(ids)])


def test_catalog_table_knows_each_batch(spark, scratch):
    """The sink commits its partitions to the catalog: the table's count is the folder's after every batch."""
    path = os.path.join(scratch, "trades")
    for k, ids in enumerate((range(5), range(3, 9), range(3, 9), [])):
        for _ in range(2):  # a replay of the batch
            trades.insert_trades(spark, batch_of(spark, ids), path, k, run_id="r", table="trades_t")
        assert spark.table("trades_t").count() == trades.read_trades(spark, path).count() == (5, 9, 9, 9)[k]
    assert spark.sql("SHOW PARTITIONS trades_t").count() > 1
    spark.sql("DROP TABLE trades_t")


def test_id_index_opens_only_batches_that_can_hold_an_id(spark, scratch):
    path = os.path.join(scratch, "trades")
    index = os.path.join(path, trades.ID_INDEX)
    per = 40
    for k in range(20):
        new = batch_of(spark, range(k * per, (k + 1) * per))
        if k:
            rows = trades._with_bucket(new, trades.ID_BUCKETS)
            assert trades.batches_that_may_hold(rows, spark.read.schema(trades.INDEX).parquet(index)).count() <= 1  # by chance
        trades.insert_trades(spark, new, path, k, run_id=f"r{k % 2}")
    old = trades._with_bucket(batch_of(spark, [3 * per + 1, 7 * per]), trades.ID_BUCKETS)
    found = {(r.run_id, r.batch_id) for r in trades.batches_that_may_hold(old, spark.read.schema(trades.INDEX).parquet(index)).collect()}
    assert found >= {("r1", 3), ("r1", 7)} and len(found) <= 3
    trades.insert_trades(spark, batch_of(spark, range(20 * per + 5)), path, 99, run_id="again")
    table = trades.read_trades(spark, path)
    assert table.count() == table.select("execution_id").distinct().count() == 20 * per + 5


def test_id_index_has_no_false_negative_on_many_pages(spark):
    ids = spark.range(30000).selectExpr("concat('b', id, '-a', id) AS execution_id")
    rows = trades._with_bucket(ids, 4)
    index = trades.id_pages(rows, 4).withColumns({"run_id": F.lit("r"), "batch_id": F.lit(1).cast("long")}).cache()
    assert index.select("id_bucket", "page").distinct().count() == 16
    one = trades._with_bucket(ids.filter("execution_id like '%77'"), 4)
    for r in one.limit(8).collect():
        asked = one.filter(F.col("execution_id") == r.execution_id)
        assert trades.batches_that_may_hold(asked, index).count() == 1
    other = trades._with_bucket(spark.range(1000).selectExpr("concat('x', id) AS execution_id"), 4)
    passed = sum(trades.batches_that_may_hold(other.filter(F.col("execution_id") == f"x{i}"), index).count() for i in range(0, 1000, 200))
    assert passed <= 2


def test_a_large_batch_of_new_ids_opens_no_stored_batch(spark):
    """Large batches as well as small ones: chance hits grow with both, and one would have every id of a batch read."""
    def ids(low, high):
        return trades._with_bucket(spark.range(low, high).selectExpr("concat('b', id, '-a', id) AS execution_id"), 4)

    parts = [trades.id_pages(ids(k * 20000, (k + 1) * 20000), trades.pages_for(20000, 4)).withColumns({"run_id": F.lit("r"), "batch_id": F.lit(k).cast("long")})
             for k in range(3)]
    index = parts[0].unionByName(parts[1]).unionByName(parts[2]).cache()
    assert max(r.n for r in index.select(F.size("hashes").alias("n")).collect()) < 2 * trades.IDS_PER_PAGE
    for own in (1, 16):
        assert trades.batches_that_may_hold(ids(60000, 160000), index, own).count() == 0
        found = trades.batches_that_may_hold(ids(59999, 160000).unionByName(ids(0, 1)), index, own)
        assert sorted(r.batch_id for r in found.collect()) == [0, 2]


def test_large_batch_after_a_small_one(spark, scratch):
    path = os.path.join(scratch, "trades")
    small, large = ([("A", 1, 1, f"b{i}", f"a{i}", t(1), f"b{i}-a{i}", 0, i, 0) for i in r] for r in (range(0, 900, 9), range(900)))
    trades.insert_trades(spark, ex(spark, small), path, 0, buckets=1)
    trades.IDS_PER_PAGE, was = 8, trades.IDS_PER_PAGE
    try:
        for _ in range(2):
            trades.insert_trades(spark, ex(spark, large), path, 1, buckets=1)
    finally:
        trades.IDS_PER_PAGE = was
    table = spark.read.schema(trades.STORED).parquet(path)
    assert {r.batch_id: r["count"] for r in table.groupBy("batch_id").count().collect()} == {0: 100, 1: 800}


def test_batches_of_an_older_index_are_read(spark):
    """Index pages without hashes (their batches were written before there were any) may hold every id."""
    rows = trades._with_bucket(spark.range(5).selectExpr("concat('x', id) AS execution_id"), 1)
    index = spark.createDataFrame([(0, 1, 0, None, "r", 4)], trades.INDEX)
    assert [tuple(r) for r in trades.batches_that_may_hold(rows, index).collect()] == [("r", 4)]


def test_more_batches_than_a_filter_names(spark, scratch, monkeypatch):
    monkeypatch.setattr(trades, "OPEN_AT_ONCE", 1)
    path = os.path.join(scratch, "trades")
    for k in range(3):
        trades.insert_trades(spark, batch_of(spark, range(k * 4, k * 4 + 4)), path, k)
    trades.insert_trades(spark, batch_of(spark, range(14)), path, 3)
    assert sorted(r.execution_id for r in trades.read_trades(spark, path).collect()) == sorted(f"b{i}-a{i}" for i in range(14))


def test_values_beyond_bigint_are_refused_by_the_table(spark, scratch):
    rows = ex(spark, [("A", 1, 1, "b1", "a1", t(1), "b1-a1", 0, 1, 0), ("A", 2, 1, "b2", "a2", t(2), "b2-a2", 0, 2, 0)])
    big = F.when(F.col("price") == 2, F.lit(str(2**63)).cast("decimal(20,0)")).otherwise(F.col("price").cast("decimal(20,0)"))
    wide = rows.withColumn("price", big)
    path = os.path.join(scratch, "trades")
    trades.insert_trades(spark, wide, path, 0)
    assert [(r.execution_id, r.price) for r in trades.read_trades(spark, path).collect()] == [("b1-a1", 1)]
    assert [tuple(r) for r in trades.table_rejects(wide).collect()] == [("table", "out_of_range", 0, 2, "b2-a2")]


def test_runs_do_not_overwrite_each_other(spark, scratch):
    """A new run's batch ids start at 0 again; a replay of a run rewrites only that run."""
    path = os.path.join(scratch, "trades")
    first = ex(spark, [("A", 1, 1, "b1", "a1", t(1), "b1-a1", 0, 1, 0)])
    second = ex(spark, [("A", 1, 1, "b1", "a1", t(1), "b1-a1", 0, 1, 0), ("A", 2, 2, "b2", "a2", t(2), "b2-a2", 0, 2, 0)])
    for _ in range(2):
        trades.insert_trades(spark, first, path, 0, run_id="r1")
        trades.insert_trades(spark, second, path, 0, run_id="r2")
    assert sorted(r.execution_id for r in trades.read_trades(spark, path).collect()) == ["b1-a1", "b2-a2"]


def test_table_rejects_name_the_refused_rows(spark):
    rows = ex(spark, [("A", 1, 1, "b1", "a1", t(1), "b1-a1", 0, 1, 0), (None, 1, 1, "b2", "a2", t(1), "b2-a2", 0, 2, 0)])
    got = [tuple(r) for r in trades.table_rejects(rows).collect()]
    assert got == [("table", "not_null", 0, 2, "b2-a2")]
