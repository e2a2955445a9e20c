"""What must not grow with the tables: rows of one task, jobs of one run."""

import datetime as dt
import tracemalloc

import numpy as np
from pyspark.sql import functions as F

from matchbook.functions.render import snapshot_json
from matchbook.functions.symbols import hash_bucket
from matchbook.operators import book, lifetimes, snapshots
from matchbook.operators.epochs import epoch_bounds, match_in_epochs
from matchbook.operators.routing import keyed_messages, write_message_log
from matchbook.plans import queries
from matchbook.schemas import ORDER_STEP, SNAPSHOT, SNAPSHOT_HEADER
from matchbook.sources import order_flow, read_table
from matchbook.sources.requests import decode_json, plain_arrays, split_plain

T0 = dt.datetime(2024, 1, 1)


def event_folder(spark, scratch, n=400, users=39):
    """A folder with an events table of ``n`` orders, every 11th of them broken."""
    rows = [(i, T0 + dt.timedelta(seconds=i), i * 7 % users, "error" if i % 11 == 10 else "click", float(i * 13 % 50)) for i in range(n)]
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    spark.createDataFrame(rows, schema).write.parquet(f"{scratch}/events.parquet")
    return scratch


def test_order_log_is_not_written_by_one_task(spark, scratch):
    headers, steps = queries._books(spark, event_folder(spark, scratch))
    tasks = steps.select(F.input_file_name().alias("file")).groupBy("file").count().collect()
    assert headers.count() > 0
    assert len(tasks) > 1 and max(r["count"] for r in tasks) < steps.count()


def test_ranges_of_a_long_log_are_few():
    bounds = epoch_bounds(0, 5_999_999, 1 << 13)
    assert len(bounds) < 30
    assert bounds[0] == (0, (1 << 13) - 1) and bounds[-1][1] >= 5_999_999
    assert all(b + 1 == c for (_, b), (c, _) in zip(bounds, bounds[1:]))
    # edges stay when the log grows; a hole in the offsets or a late begin makes no more of them
    assert epoch_bounds(0, 999_999, 1 << 13) == bounds[: len(epoch_bounds(0, 999_999, 1 << 13))]
    assert len(epoch_bounds(-5, 10**12, 1 << 13)) < 60
    assert epoch_bounds(10**12, 10**12 + 20_000, 1 << 13)[0][1] - 10**12 < 1 << 13
    # what the ranges carry together is in proportion to the log
    assert sum(a for a, _ in bounds) < 4 * 6_000_000


def test_widening_ranges_equal_one_pass(spark, scratch):
    flow = order_flow(read_table(spark, event_folder(spark, scratch), "events"))
    one, split = book.match_batch(flow), match_in_epochs(flow, scratch + "/epochs", width=32)
    assert len(epoch_bounds(0, 399, 32)) < 400 // 32
    for f in (book.executions, book.resting_orders, book.book_headers):
        a, b = f(one), f(split)
        assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, f.__name__


def test_whole_books_equal_grouped_rows(spark, scratch):
    found = queries._books(spark, event_folder(spark, scratch))
    want = snapshots.snapshot_messages(lifetimes.books_at(*found))
    for width in (1024, 16):
        got = lifetimes.whole_books(*found, width=width)
        assert got.count() > 0 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_whole_books_of_empty_and_crossing_lives(spark):
    steps = [("A", "BUY", "a", 5, 1, 2, 1), ("A", "BUY", "b", 7, 2, 1, 2), ("A", "SELL", "c", 9, 3, 4, 3), ("A", "BUY", "a", 5, 1, 1, 5),
             ("A", "BUY", "b", 7, 2, 0, 6), ("A", "SELL", "c", 9, 3, 0, 6), ("A", "BUY", "a", 5, 1, 0, 7)]
    heads = [("A", n) for n in (2, 5, 6, 8)] + [("B", 3)]
    headers = spark.createDataFrame([(T0, s, 0, 10 * n, n) for s, n in heads], SNAPSHOT_HEADER)
    names = [f.name for f in ORDER_STEP.fields]
    rows = [tuple(dict(zip(("symbol", "side", "id", "price", "seq", "size", "book_seq"), r))[c] for c in names) for r in steps]
    got = lifetimes.whole_books(headers, spark.createDataFrame(rows, ORDER_STEP), width=4).collect()
    books = {(r.symbol, r.orderbook_seq): ([(o.id, o.size) for o in r.bids], [(o.id, o.size) for o in r.asks]) for r in got}
    assert books == {("A", 2): ([("b", 1), ("a", 2)], []), ("A", 5): ([("b", 1), ("a", 1)], [("c", 4)]), ("A", 6): ([("a", 1)], []),
                     ("A", 8): ([], []), ("B", 3): ([], [])}


def test_dealt_messages_are_small_and_complete(spark, scratch):
    # a message like the one before it: 300 of 80 KB
    text = F.concat_ws(",", F.transform(F.sequence(F.lit(0), F.lit(9_000)), lambda i: F.xxhash64(i + F.floor(F.col("id") / 300)).cast("string")))
    rows = spark.range(300, numPartitions=1).select(F.lit("A").alias("symbol"), F.concat(F.col("id").cast("string"), text).alias("value"))
    messages = keyed_messages(rows, F.col("value"), 8, "symbol")
    write_message_log(messages, scratch + "/sorted")
    write_message_log(messages, scratch + "/dealt", dealt=True)
    read = lambda name: spark.read.parquet(f"{scratch}/{name}")
    assert read("dealt").exceptAll(read("sorted")).count() == 0 and read("dealt").count() == 300
    size = lambda name: read(name).select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0]
    assert size("dealt") * 10 < size("sorted")
    assert read("dealt").select("partition").distinct().first()[0] == spark.range(1).select(hash_bucket(F.lit("A"), 8)).first()[0]


def test_words_are_counted_before_they_are_shuffled(spark):
    from matchbook.llm import pii

    docs = spark.createDataFrame([(1, "a B a"), (2, None), (3, "b\tc")], "doc_id bigint, text string")
    found = pii.word_counts(docs)
    assert {(r.word, r.n) for r in found.collect() if r.word} == {("a", 2), ("b", 2), ("c", 1)}
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "partial_count" in plan and "Join" not in plan


def test_comparing_a_large_group_holds_few_pairs():
    from matchbook.llm import simhash

    one = np.uint64(1) << np.random.default_rng(1).integers(0, 64, (3, 12_000)).astype(np.uint64)
    fp = np.unique(np.uint64(0x1234567890ABCDEF) ^ one[0] ^ one[1] ^ one[2])[:9_000]
    tracemalloc.start()
    a, b = simhash.met(np.zeros(len(fp), np.int64), fp, np.ones(len(fp), bool), 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(a) == len(fp) - 1 and len(set(a.tolist()) | set(b.tolist())) == len(fp)
    assert peak < 32e6


def resting_log(spark, n, symbol="A"):
    """Headers after every tenth of ``n`` orders that all come to rest, and their order log."""
    steps = spark.range(1, n + 1).select(F.lit(symbol).alias("symbol"), F.lit("BUY").alias("side"), F.concat(F.lit("r"), F.col("id").cast("string")).alias("id"),
                                         F.lit(5).cast("bigint").alias("price"), F.col("id").alias("seq"), F.lit(1).cast("bigint").alias("size"), F.col("id").alias("book_seq"))
    headers = spark.range(10, n + 1, 10).select(F.lit(T0).cast("timestamp_ntz").alias("created_at"), F.lit(symbol).alias("symbol"),
                                                F.lit(0).alias("trades_partition"), F.col("id").alias("last_offset"), F.col("id").alias("orderbook_seq"))
    return headers, steps


def test_long_lives_are_repeated_as_seldom_in_long_logs(spark):
    for n in (500, 8_000):
        assert lifetimes._binned(*resting_log(spark, n), 4).count() < 10 * n
    numbers = spark.range(0, 200_000).select("id", lifetimes._bin(F.col("id"), 16).alias("bin"))
    found = numbers.groupBy("bin").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).orderBy("bin").collect()
    assert len(found) < 70 and all(a.hi + 1 == b.lo for a, b in zip(found, found[1:]))


def test_log_is_shuffled_once_for_its_lives(spark):
    steps = spark.createDataFrame([("A", "BUY", "a", 5, 1, 2, 1), ("A", "BUY", "a", 5, 1, 0, 2)], ORDER_STEP)
    plan = lifetimes.lifetimes(steps)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_books_take_little_room_in_a_file(spark, scratch):
    headers, steps = resting_log(spark, 3_000)
    books = lifetimes.books_at(headers, steps)
    assert books.count() == sum(range(10, 3_001, 10))
    books.coalesce(1).write.parquet(scratch + "/books")
    size = spark.read.parquet(scratch + "/books").select("_metadata.file_size").first()[0]
    assert size < 0.6 * books.count()


def test_books_of_repeated_empty_and_unnumbered_headers(spark):
    steps = [("A", "BUY", "a", 5, 1, 2, 1), ("A", "BUY", "b", 7, 2, 1, 2), ("A", "BUY", "a", 5, 1, 0, 3), ("A", "BUY", "b", 7, 2, 0, 3), ("A", "BUY", "b", 7, 2, 0, 3),
             ("A", "SELL", "c", 9, 30, 4, 30), ("C", "SELL", "d", 9, 1, 4, 1)]
    steps = spark.createDataFrame([(s, side, i, p, q, z, b) for s, side, i, p, q, z, b in steps], ORDER_STEP)
    heads = [("A", 2), ("A", 2), ("A", 5), ("A", 30), ("A", 700), ("B", 3), ("A", None), (None, 4)]
    headers = spark.createDataFrame([(T0, s, 0, k, n) for k, (s, n) in enumerate(heads)], SNAPSHOT_HEADER)
    want = [("A", 2, 0, "a", 2), ("A", 2, 0, "b", 1), ("A", 2, 1, "a", 2), ("A", 2, 1, "b", 1), ("A", 5, 2, None, None), ("A", 30, 3, "c", 4),
            ("A", 700, 4, "c", 4), ("B", 3, 5, None, None), ("A", None, 6, None, None), (None, 4, 7, None, None)]
    for width in (1024, 2):
        got = lifetimes.books_at(headers, steps, width).collect()
        assert sorted(((r.symbol, r.orderbook_seq, r.last_offset, r.id, r.size) for r in got), key=repr) == sorted(want, key=repr)


def text_of(orders):
    return ",".join('{"id":"%s","price":"%s","size":"%s","seq":"%s"}' % o for o in orders)


def test_texts_of_whole_books_are_the_messages(spark, scratch):
    found = queries._books(spark, event_folder(spark, scratch))
    steps = found[1].withColumn("id", F.when(F.col("seq") % 3 == 0, F.concat(F.lit('"\\},{é\n'), "id")).when(F.col("seq") % 5 != 0, F.col("id")))
    arrays, texts = (lifetimes.whole_books(found[0], steps, width=16, texts=x) for x in (False, True))
    a, b = (x.select(snapshot_json(x).alias("value")) for x in (arrays, texts))
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    lines = b.select(F.lit(0).cast("bigint").alias("offset"), "value")
    want = lifetimes.books_at(found[0], steps).withColumn("id", F.when(F.col("seq").isNotNull(), F.coalesce("id", F.lit(""))))
    got = snapshots.flatten_snapshots(decode_json(lines, SNAPSHOT)[0])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_orders_of_plain_messages_are_read_apart(spark):
    head = '{"created_at":"2024-01-01T00:00:00.000000Z","symbol":"A","trades_partition":1,"last_offset":"7","orderbook_seq":"9",'
    one, two, odd = ("a", 5, 2, 1), ("b", 6, 1, 2), ("},{", 7, 3, 3)
    plain = [(([one, two], [one])), (([], [one])), (([two], [])), (([], []))]
    text = lambda bids, asks: head + '"bids":[' + text_of(bids) + '],"asks":[' + text_of(asks) + "]}"
    other = [text([one], [odd, two]), text([one], []).replace('"5"', "5"), text([one], []).replace('"a"', '"\\u0061"'), text([one, two], []).replace("},{", "} ,{"),
             text([one], [two]).replace('"bids":[', '"bids":[ '), text([one, two], []) + " ", '{"symbol":"A"}', '{"asks":[],"bids":[' + text_of([one]) + "]}"]
    bad = [text([one, two], [one])[:-1], text([one], []).replace('"5"', '"-5"'), text([one, two], []).replace("},{", "},"), text([one, two], []).replace("},{", "}},{"),
           text([one], []).replace('"5"', '"9223372036854775808"'), text([one, two], []).replace("},{", ",{"), "x" + text([one], []), text([one], [])[1:],
           text([one], []).replace("2024-01-01", "2024-02-31"), text([one], []).replace('"7"', '"x"'), ""]
    every = [text(*p) for p in plain] + other + bad
    lines = spark.createDataFrame([(0, i, t) for i, t in enumerate([*every, None])], "partition int, offset bigint, value string").coalesce(1)
    split = split_plain(lines, plain_arrays(SNAPSHOT), "value").collect()
    assert len(split) == len(every) + 1
    read = {r.offset: r for r in split}
    for i, (bids, asks) in enumerate(plain):
        r = read[i]
        assert r.value == text([], [])
        assert [tuple(map(str, o)) for o in r._plain_bids] == [tuple(map(str, o)) for o in bids]
        assert [tuple(map(str, o)) for o in r._plain_asks] == [tuple(map(str, o)) for o in asks]
    for i, t in list(enumerate(every))[len(plain):len(plain) + len(other)]:
        assert read[i].value == t and read[i]._plain_bids is None and read[i]._plain_asks is None, t
    good, rejects = decode_json(lines, SNAPSHOT)
    found = {r.offset: r for r in good.collect()}
    assert sorted(found) == list(range(len(plain) + len(other)))
    ids = lambda orders: [(o.id, o.price, o.size, o.seq) for o in orders]
    assert [(ids(found[i].bids), ids(found[i].asks)) for i in range(5)] == [*plain, ([one], [odd, two])]
    assert found[0].created_at == T0 and (found[0].last_offset, found[0].orderbook_seq, found[0].trades_partition, found[0].symbol) == (7, 9, 1, "A")
    assert all(ids(found[i].bids) == [one] for i in (5, 6, 8, 11)) and all(ids(found[i].bids) == [one, two] for i in (7, 9)) and found[10].bids == []
    refused = {r.offset: r.raw for r in rejects.collect()}
    assert sorted(refused) == list(range(len(found), len(every) + 1))
    assert all(refused[i] == t for i, t in enumerate(every) if i in refused)
