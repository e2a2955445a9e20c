"""Batch operator on Spark: golden scenarios, restore/resume, snapshots, sequence numbers."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from matchbook.operators import book, lifetimes, snapshots
from matchbook.operators.sequence import with_sequence
from matchbook.schemas import REQUEST
from matchbook.sources import order_flow, read_table
from scenarios import (BASIC, BASIC_BOOKS, BASIC_FILLS, RECOVERY, RECOVERY_BOOKS, RECOVERY_FILLS,
                       expected_executions, rows)


def requests(spark, orders, first=1):
    return spark.createDataFrame(rows(orders, first=first), REQUEST)


def exec_tuples(df):
    return sorted(tuple(r) for r in book.executions(df).select(
        "symbol", "price", "size", "bid_request_id", "ask_request_id").collect())


def books_of(tagged):
    rest = book.resting_orders(tagged).collect()
    heads = {r.symbol: r.orderbook_seq for r in book.book_headers(tagged).collect()}
    out = {}
    for sym, seq in heads.items():
        bids = sorted(((r.price, r.size, r.seq) for r in rest if r.symbol == sym and r.side == "BUY"),
                      key=lambda o: (-o[0], o[2]))
        asks = sorted(((r.price, r.size, r.seq) for r in rest if r.symbol == sym and r.side == "SELL"),
                      key=lambda o: (o[0], o[2]))
        out[sym] = (bids, asks, seq)
    return out


def test_basic_batch(spark):
    tagged = book.match_batch(requests(spark, BASIC)).cache()
    assert exec_tuples(tagged) == expected_executions(BASIC, BASIC_FILLS)
    assert books_of(tagged) == BASIC_BOOKS
    top = {r.symbol: (r.bid_price, r.bid_size, r.ask_price, r.ask_size)
           for r in book.top_of_book(book.resting_orders(tagged)).collect()}
    assert top == {"GOOG": (100, 2, 101, 5), "AAPL": (199, 4, 201, 1), "MSFT": (301, 3, 302, 7)}


def test_execution_ids_and_times(spark):
    ex = book.executions(book.match_batch(requests(spark, BASIC))).filter("bid_request_id = '3'").collect()
    assert sorted(r.execution_id for r in ex) == ["3-1", "3-2"]
    assert all(str(r.executed_at) == "2024-01-01 00:00:03" for r in ex)


def test_recovery_restore_and_resume(spark):
    """Snapshot after #4, restore it, resume at #5 (and replay from #1 with the offset gate)."""
    full = exec_tuples(book.match_batch(requests(spark, RECOVERY)))
    assert full == expected_executions(RECOVERY, RECOVERY_FILLS)
    first = book.match_batch(requests(spark, RECOVERY[:4]), snapshot_every=2)
    latest = snapshots.latest_snapshots(book.snapshots(first))
    restored = snapshots.restore_rows(lifetimes.books_of_latest(latest, lifetimes.order_log(first)))
    after = [f for f in RECOVERY_FILLS if f[0] >= 5]
    resumed = book.match_batch(requests(spark, RECOVERY[4:], first=5), restored=restored).cache()
    assert exec_tuples(resumed) == expected_executions(RECOVERY, after)
    assert books_of(resumed) == RECOVERY_BOOKS
    replayed = book.match_batch(requests(spark, RECOVERY), restored=restored).cache()
    assert exec_tuples(replayed) == expected_executions(RECOVERY, after)
    assert sorted(r.offset for r in book.engine_rejects(replayed).filter("reason = 'duplicate_offset'").collect()) == [1, 2, 3, 4]
    new = snapshots.after_snapshot(requests(spark, RECOVERY), latest)
    assert sorted(r.offset for r in new.collect()) == list(range(5, 15))
    assert exec_tuples(book.match_batch(new, restored=restored)) == expected_executions(RECOVERY, after)


def test_unknown_side_and_engine_rejects(spark):
    data = rows([("X", 7, 100, 1), ("X", 0, 100, 1), ("", 0, 100, 1), ("Y", 1, 0, 1)])
    data.append((0, 9, "", data[0][3], "Z", 0, 100, 1))
    tagged = book.match_batch(spark.createDataFrame(data, REQUEST))
    rej = {r.offset: r.reason for r in book.engine_rejects(tagged).collect()}
    assert rej == {1: "unknown_side", 3: "empty_symbol", 4: "price_or_size", 9: "missing_request_id"}
    assert books_of(tagged)["X"] == ([], [(100, 1, 2)], 2)


def test_latest_snapshot_is_arg_max(spark):
    tagged = book.match_batch(requests(spark, BASIC), snapshot_every=2)
    log = book.snapshots(tagged)
    latest = {r.symbol: r.orderbook_seq for r in snapshots.latest_snapshots(log).collect()}
    assert latest == {"GOOG": 4, "AAPL": 4, "MSFT": 4}
    goog = snapshots.latest_snapshots(log, symbols=["GOOG"]).collect()
    assert len(goog) == 1 and goog[0].symbol == "GOOG"


def test_chunked_sequence_equals_row_number(spark):
    flow = order_flow(read_table(spark, "/root/testdata/sf0.001", "events"))
    got = with_sequence(flow, chunk=7).select("offset", "seq")
    want = flow.select("offset", F.row_number().over(
        Window.partitionBy("symbol").orderBy("partition", "offset")).alias("seq"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_sf0001_totals(spark):
    flow = order_flow(read_table(spark, "/root/testdata/sf0.001", "events"))
    ex = book.executions(book.match_batch(flow))
    r = ex.agg(F.count("*").alias("n"), F.sum("size").alias("q"),
               (F.sum(F.col("size") * F.col("price")) / 1_000_000).cast("long").alias("v")).first()
    assert (flow.count(), r.n, r.q, r.v) == (799, 521, 1502, 157220)


def test_epochs_equal_one_pass(spark, scratch):
    from matchbook.operators.epochs import match_in_epochs

    flow = order_flow(read_table(spark, "/root/testdata/sf0.001", "events"))
    one = book.match_batch(flow, snapshot_every=10)
    split = match_in_epochs(flow, scratch + "/epochs", width=200, snapshot_every=10)
    for f in (book.executions, book.resting_orders, book.snapshots, lifetimes.order_log, book.book_headers):
        a, b = f(one), f(split)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, f.__name__


def test_symbol_filter_reaches_the_scan(spark, scratch):
    path = scratch + "/req"
    spark.createDataFrame(rows(BASIC), REQUEST).write.parquet(path)
    tagged = book.match_batch(spark.read.parquet(path), symbols=["GOOG"])
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert "GOOG" in plan and "PushedFilters" in plan
    assert {r.symbol for r in book.executions(tagged).collect()} == {"GOOG"}
    assert exec_tuples(tagged) == [t for t in expected_executions(BASIC, BASIC_FILLS) if t[0] == "GOOG"]


def test_epochs_resume_after_committed_epochs(spark, scratch, monkeypatch):
    from matchbook.operators import epochs

    flow = order_flow(read_table(spark, "/root/testdata/sf0.001", "events"))
    full = sorted(map(tuple, book.executions(book.match_batch(flow)).collect()))
    out = scratch + "/epochs"
    real, calls = epochs.book_ops.match_batch, []

    def dies_on_fourth(*args, **kwargs):
        calls.append(1)
        if len(calls) == 4:
            raise RuntimeError("driver lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(epochs.book_ops, "match_batch", dies_on_fourth)
    try:
        epochs.match_in_epochs(flow, out, width=250)
    except RuntimeError:
        pass
    monkeypatch.setattr(epochs.book_ops, "match_batch", real)
    resumed_calls = []
    monkeypatch.setattr(epochs.book_ops, "match_batch", lambda *a, **k: resumed_calls.append(1) or real(*a, **k))
    again = sorted(map(tuple, book.executions(epochs.match_in_epochs(flow, out, width=250)).collect()))
    assert again == full
    assert len(resumed_calls) == 1  # only the epoch that never committed ran again


def test_order_log_gives_back_every_book(spark):
    """The books that the log tells, at every sequence number, against a book run one order at a time; one row for
    each change of an order."""
    from matchbook.operators.matching import Book

    flow = order_flow(read_table(spark, "/root/testdata/sf0.001", "events"))
    tagged = book.match_batch(flow, snapshot_every=1).cache()
    log, heads = lifetimes.order_log(tagged).cache(), book.snapshots(tagged)
    want, books, changes = set(), {}, 0
    for r in flow.orderBy("partition", "offset").collect():
        b = books.setdefault(r.symbol, Book(r.symbol))
        steps = []
        b.submit(r.side, r.price, r.size, r.request_id, [], steps)
        changes += len(steps)
        rows_ = [(r.symbol, b.seq, name, o["id"], o["price"], o["size"], o["seq"]) for side, name in ((1, "BUY"), (0, "SELL")) for o in b.side_orders(side)]
        want |= set(rows_ or [(r.symbol, b.seq, None, None, None, None, None)])
    columns = ["symbol", "orderbook_seq", "side", "id", "price", "size", "seq"]
    for width in (1024, 3):
        got = [tuple(r) for r in lifetimes.books_at(heads, log, width).select(*columns).collect()]
        assert len(got) == len(want) and set(got) == want
    assert log.count() == changes
    # a repeated log (a replay) tells the same
    twice = [tuple(r) for r in lifetimes.books_at(heads, log.unionByName(log)).select(*columns).collect()]
    assert len(twice) == len(want) and set(twice) == want
    latest = snapshots.latest_snapshots(heads)
    got = {tuple(r) for r in lifetimes.books_of_latest(latest, log).select(*columns).collect()}
    assert got == {w for w in want if w[1] == books[w[0]].seq}


def test_snapshot_messages_in_priority_order(spark):
    tagged = book.match_batch(requests(spark, BASIC), snapshot_every=5)
    sent = {r.symbol: r for r in snapshots.snapshot_messages(lifetimes.books_at(book.snapshots(tagged), lifetimes.order_log(tagged))).collect()}
    assert [(o.price, o.size, o.seq) for o in sent["GOOG"].bids] == [(100, 2, 4)]
    assert [(o.price, o.size, o.seq) for o in sent["MSFT"].asks] == [(302, 7, 2)]


def test_offset_gaps_across_chunks(spark):
    from matchbook.operators.sequence import offset_gaps

    df = spark.createDataFrame([(0, o) for o in (1, 2, 2, 5, 9, 10, 30)] + [(1, 7), (1, 8)], "partition int, offset long")
    for chunk in (1 << 20, 4):
        got = sorted(tuple(r) for r in offset_gaps(df, chunk).collect())
        assert got == [(0, 3, 4), (0, 6, 8), (0, 11, 29)]


def test_execution_time_now(spark):
    tagged = book.match_batch(requests(spark, BASIC))
    now = spark.range(1).select(F.current_timestamp().cast("timestamp_ntz").alias("t")).first().t
    assert all(r.executed_at >= now for r in book.executions(tagged, now=True).collect())


def test_release_deletes_the_folders_of_a_session(spark):
    import os

    from matchbook.session import new_folder, release

    path = new_folder(spark, "scratch")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    assert release(spark) >= 1 and not os.path.exists(path)
    assert release(spark) == 0
