"""Ingest and persister streams, compaction, duplicates and state by level: restarts and deaths in the middle."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from matchbook.operators import book, compaction, lifetimes, snapshots, trades
from matchbook.operators.validate import ingest
from matchbook.schemas import REQUEST
from matchbook.sources import dirty_requests, order_flow, read_table
from matchbook.streaming import ingest as ingest_job
from matchbook.streaming import persist
from matchbook.streaming.jobs import read_stream_output, run_match_stream
from scenarios import BASIC, rows
from test_streaming import stream, write_files

SF = "/root/testdata/sf0.001"


def same(a, b):
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture()
def raw(spark):
    return dirty_requests(read_table(spark, SF, "events"))


def dies_once(monkeypatch, module, name, after=1):
    """The function ends its job after the ``after``-th call has done its work; later calls are as before."""
    real, calls = getattr(module, name), []

    def wrapped(*args, **kwargs):
        out = real(*args, **kwargs)
        calls.append(1)
        if len(calls) == after:
            raise RuntimeError("job lost")
        return out

    monkeypatch.setattr(module, name, wrapped)


def test_ingest_stream_after_a_death_and_a_restart(spark, scratch, raw, monkeypatch):
    src, out, ckpt = (os.path.join(scratch, d) for d in ("src", "out", "ckpt"))
    for k in range(3):
        raw.filter(F.col("offset") % 3 == k).write.mode("append").parquet(src)
    source = lambda: spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(src)
    real = ingest_job.ingest_sink
    calls = []

    def sink(*args):
        write = real(*args)

        def body(batch, batch_id):
            write(batch, batch_id)
            calls.append(batch_id)
            if len(calls) == 2:  # written, but not committed
                raise RuntimeError("job lost")

        return body

    monkeypatch.setattr(ingest_job, "ingest_sink", sink)
    with pytest.raises(Exception):
        ingest_job.run_ingest_stream(source(), out, ckpt)
    ingest_job.run_ingest_stream(source(), out, ckpt)
    assert calls.count(1) == 2
    accepted, refused = ingest(raw)
    same(ingest_job.accepted_requests(spark, out), accepted)
    same(ingest_job.refused_requests(spark, out), refused.select("stage", "reason", "partition", "offset", "raw"))


def test_ingest_stream_of_json_lines(spark, scratch):
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    os.makedirs(src)
    good = {"trade": {"instrument": {"symbol": " goog "}, "side": "BUY", "price": "18446744073709551615", "size": 2}}
    for name in ("one", "two"):
        with open(os.path.join(src, name), "w") as f:
            f.write(json.dumps(good) + "\n" + '{"trade":\n' + json.dumps(good | {"trade": good["trade"] | {"size": 0}}) + "\n")
    for _ in range(2):
        ingest_job.run_ingest_stream(ingest_job.text_lines(spark, src, 1), out, os.path.join(scratch, "ckpt"), as_text=True)
    got = sorted((r.offset, r.symbol, r.side, int(r.price)) for r in ingest_job.accepted_requests(spark, out, wide=True).collect())
    assert got == [(0, "GOOG", 1, 2**64 - 1)] * 2
    refused = sorted((r.offset, r.stage, r.reason) for r in ingest_job.refused_requests(spark, out).collect())
    assert refused == [(1, "decode", "undecodable")] * 2 + [(2, "ingest", "size")] * 2
    assert ingest_job.accepted_requests(spark, out).select("request_id").distinct().count() == 2


def test_persister_after_a_kill_between_batches(spark, scratch, monkeypatch):
    log, path, ckpt = (os.path.join(scratch, d) for d in ("log", "trades", "ckpt"))
    flow = order_flow(read_table(spark, SF, "events"))
    fills = book.executions_with_position(book.match_batch(flow, emit_final=False)).cache()
    for part in (fills.filter("offset < 500"), fills.filter("offset >= 400"), fills.withColumn("symbol", F.lit(None).cast("string"))):
        part.coalesce(1).write.mode("append").parquet(log)  # the second repeats a slice, the third is refused
    dies_once(monkeypatch, persist, "insert_trades", after=2)
    with pytest.raises(Exception):
        persist.run_persist_stream(persist.execution_stream(spark, log, 1), path, checkpoint=ckpt)
    monkeypatch.undo()
    persist.run_persist_stream(persist.execution_stream(spark, log, 1), path, checkpoint=ckpt)
    same(trades.read_trades(spark, path), fills.select(*trades.TRADES_COLUMNS))
    refused = spark.read.parquet(path + "-rejects")
    assert refused.count() == fills.count() and {r.reason for r in refused.select("reason").distinct().collect()} == {"not_null"}


def test_persister_holds_a_small_batch_in_few_tasks(spark, scratch, monkeypatch):
    held, was = [], trades.id_pages
    monkeypatch.setattr(trades, "id_pages", lambda rows, pages: held.append(rows.rdd.getNumPartitions()) or was(rows, pages))
    monkeypatch.setattr(trades, "ROWS_PER_TASK", 400)
    fills = book.executions_with_position(book.match_batch(order_flow(read_table(spark, SF, "events")), emit_final=False))
    log, path = os.path.join(scratch, "log"), os.path.join(scratch, "trades")
    fills.coalesce(1).write.parquet(log)
    n = fills.count()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        persist.run_persist_stream(persist.execution_stream(spark, log, 1), path, checkpoint=os.path.join(scratch, "ckpt"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert 400 * 32 > n > 0 and held == [trades.tasks_for(n)] and held[0] < 32
    same(trades.read_trades(spark, path), fills.select(*trades.TRADES_COLUMNS))


def test_persister_of_messages_into_the_catalog(spark, scratch):
    src, path = os.path.join(scratch, "src"), os.path.join(scratch, "trades")
    value = '{"symbol":"A","price":"5","size":2,"bid_request_id":"b","ask_request_id":"a","execution_id":"%s","executed_at":"2024-01-01T00:00:01Z"}'
    lines = [(0, i, v) for i, v in enumerate([value % "x", value % "y", value % "x", '{"symbol":'])]
    frame = spark.createDataFrame(lines, "partition int, offset long, value string")
    frame.write.parquet(src)
    persist.run_persist_stream(spark.readStream.schema(frame.schema).parquet(src), path, checkpoint=os.path.join(scratch, "ckpt"), table="persisted", as_text=True)
    assert sorted(r.execution_id for r in spark.table("persisted").collect()) == ["x", "y"]
    assert [(r.offset, r.reason) for r in spark.read.parquet(path + "-rejects").collect()] == [(3, "undecodable")]
    spark.sql("DROP TABLE persisted")


def logged(spark, flow, low, high, run, out):
    """One run of the log from offset ``low`` on, written as the sink does."""
    tagged = book.match_batch(flow.filter(F.col("offset") <= high), snapshot_every=3, emit_final=False).cache()
    for kind, df, at in (("snapshots", book.snapshots(tagged), "last_offset"), ("orders", lifetimes.order_log(tagged).join(
            tagged.filter("kind = 'step'").select("symbol", "seq", "book_seq", "offset"), ["symbol", "seq", "book_seq"]), "offset")):
        part = df.filter(F.col(at) > low)
        part.drop("offset").withColumns({"run_id": F.lit("r"), "batch_id": F.lit(run).cast("long")}).write.mode("append").partitionBy("run_id", "batch_id").parquet(
            os.path.join(out, kind))


def test_compaction_after_runs_and_an_aborted_one(spark, scratch, monkeypatch):
    out, store = os.path.join(scratch, "out"), os.path.join(scratch, "store")
    flow = order_flow(read_table(spark, SF, "events")).cache()
    read = lambda kind: read_stream_output(spark, out, kind)
    cuts = [-1, 300, 301, 1000]
    for run, (low, high) in enumerate(zip(cuts, cuts[1:])):
        logged(spark, flow, low, high, run, out)
        if run == 2:  # dies before the pointer is written: readers keep the old generation
            before = {tuple(r) for r in compaction.compacted_books(spark, store).collect()}
            with monkeypatch.context() as m:
                m.setattr(compaction, "_swap", lambda *_: (_ for _ in ()).throw(RuntimeError("job lost")))
                with pytest.raises(RuntimeError):
                    compaction.compact(spark, read("snapshots"), read("orders"), store, buckets=8)
            assert {tuple(r) for r in compaction.compacted_books(spark, store).collect()} == before
        changed = compaction.compact(spark, read("snapshots"), read("orders"), store, buckets=8)
        assert len(changed) == (8, 1, 8)[run] or run == 1 and len(changed) <= 1  # one order touches one bucket at most
        want = lifetimes.books_of_latest(snapshots.latest_snapshots(read("snapshots").drop("run_id", "batch_id")), read("orders"))
        same(compaction.compacted_books(spark, store), want)
    assert compaction.compact(spark, read("snapshots"), read("orders"), store) == []
    # what is kept: the resting orders and the steps after the snapshots, not the log
    heads, steps = compaction.read_compacted(spark, store)
    assert heads.count() == heads.select("symbol").distinct().count()
    assert steps.count() < read("orders").count()


def test_redelivered_files_and_levels_over_many_batches(spark, scratch):
    """Every row is accounted for: executed or resting, refused, or a duplicate; books equal those of one batch."""
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    data = rows(BASIC + [("GOOG", 7, 100, 1), ("GOOG", 0, 100, 2)])
    write_files(src, data, per_file=4)
    ckpt = os.path.join(scratch, "ckpt")
    run_match_stream(stream(spark, src), out, ckpt, snapshot_every=2)
    write_files(src + "-again", [r for r in data if 5 <= r[1] <= 9], per_file=5, start_mtime=time.time())
    os.rename(os.path.join(src + "-again", "req-00000005.parquet"), os.path.join(src, "again-00000005.parquet"))
    run_match_stream(stream(spark, src), out, ckpt, snapshot_every=2)
    refused = sorted((r.offset, r.reason) for r in read_stream_output(spark, out, "rejects").collect())
    assert refused == [(o, "duplicate_offset") for o in range(5, 10)] + [(16, "unknown_side")]
    one = book.match_batch(spark.createDataFrame(data, REQUEST), snapshot_every=2).cache()
    same(read_stream_output(spark, out).select(*book.executions(one).columns), book.executions(one))
    same(read_stream_output(spark, out, "orders").select(*lifetimes.order_log(one).columns), lifetimes.order_log(one))


def test_wide_values_through_the_stream(spark, scratch):
    base = 2**63 - 2
    raw = spark.createDataFrame([(i, "S", s, str(base + p), str(q)) for i, (s, p, q) in enumerate(
        [(0, 1, 2**64 - 1), (0, 3, 5), (1, 2, 2**63 + 9), (1, 9, 2**64 - 1), (0, 0, 3)])], "offset long, symbol string, side int, p string, q string")
    wide = raw.select(F.lit(0).alias("partition"), "offset", F.concat(F.lit("r"), "offset").alias("request_id"), F.lit(None).cast("timestamp_ntz").alias("received_at"),
                      "symbol", "side", F.col("p").cast("decimal(20,0)").alias("price"), F.col("q").cast("decimal(20,0)").alias("size"))
    from matchbook.functions.unsigned import widened

    want = widened(book.executions(book.match_batch(wide)), "price", "size")
    assert sorted((r.bid_request_id, r.ask_request_id, int(r.price), int(r.size)) for r in want.collect()) == [
        ("r2", "r0", base + 1, 2**63 + 9), ("r3", "r0", base + 1, 2**63 - 10), ("r3", "r1", base + 3, 5), ("r3", "r4", base + 9, 3)]
    src, out = os.path.join(scratch, "src"), os.path.join(scratch, "out")
    for k in range(5):
        wide.filter(F.col("offset") == k).coalesce(1).write.mode("append").parquet(src)
    run_match_stream(spark.readStream.schema(wide.schema).option("maxFilesPerTrigger", 1).parquet(src), out, os.path.join(scratch, "ckpt"))
    same(widened(read_stream_output(spark, out).select(*book.executions(book.match_batch(wide)).columns), "price", "size"), want)
