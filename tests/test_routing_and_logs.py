"""Routing placement, request log, message encoding, generic decode, snapshot compaction."""

import json
import os

from pyspark.sql import functions as F

from matchbook.functions.render import execution_json
from matchbook.operators import book
from matchbook.operators.routing import encode_messages, route_requests, write_request_log
from matchbook.schemas import EXECUTION, REQUEST
from matchbook.sources.requests import decode_json, read_submit_json
from scenarios import BASIC, rows


def test_route_requests_places_rows_by_bucket(spark):
    df = spark.createDataFrame(rows([("GOOG", 1, 1, 1), ("MSFT", 1, 1, 1), ("TSLA", 1, 1, 1), ("AAPL", 1, 1, 1)]),
                               REQUEST)
    placed = route_requests(df, 3).select("symbol", "partition", F.spark_partition_id().alias("pid")).collect()
    assert {r.symbol: r.partition for r in placed} == {"GOOG": 0, "MSFT": 1, "TSLA": 2, "AAPL": 0}
    assert all(r.partition == r.pid for r in placed)


def test_request_log_round_trip(spark, scratch):
    path = os.path.join(scratch, "requests")
    write_request_log(spark.createDataFrame(rows(BASIC), REQUEST), path, 3)
    back = spark.read.parquet(path)
    assert back.count() == 15
    assert {r.partition for r in back.select("partition").distinct().collect()} == {0, 1}


def test_message_encoding_and_execution_json(spark):
    ex = book.executions(book.match_batch(spark.createDataFrame(rows(BASIC[:3]), REQUEST)))
    msgs = encode_messages(ex, execution_json(ex)).collect()
    assert {m.key for m in msgs} == {"GOOG"}
    first = json.loads(sorted(m.value for m in msgs)[0])
    assert first["execution_id"] == "3-1" and first["price"] == "100" and first["size"] == "10"
    empty = encode_messages(spark.createDataFrame([("",)], "symbol string"), F.lit("v")).first()
    assert empty.key is None


def test_decode_executions_quarantines_bad_rows(spark):
    lines = spark.createDataFrame([
        (0, 1, '{"symbol":"A","price":5,"size":2,"bid_request_id":"b","ask_request_id":"a","execution_id":"b-a"}'),
        (0, 2, '{"symbol":"A","price":'),
    ], "partition int, offset long, value string")
    good, bad = decode_json(lines, EXECUTION)
    assert [(r.offset, r.execution_id, r.size) for r in good.collect()] == [(1, "b-a", 2)]
    assert [(r.offset, r.reason) for r in bad.collect()] == [(2, "undecodable")]


def test_decode_snapshots_skips_bad_rows(spark):
    from matchbook.schemas import SNAPSHOT

    lines = spark.createDataFrame([
        (0, 1, '{"created_at":"2024-01-01T00:00:00","symbol":"A","trades_partition":0,"last_offset":5,'
               '"orderbook_seq":3,"bids":[{"id":"1","price":10,"size":2,"seq":1}],"asks":[]}'),
        (0, 2, 'not json'),
    ], "partition int, offset long, value string")
    good, bad = decode_json(lines, SNAPSHOT)
    g = good.collect()
    assert [(r.symbol, r.orderbook_seq, [(o.price, o.size) for o in r.bids]) for r in g] == [("A", 3, [(10, 2)])]
    assert [r.offset for r in bad.collect()] == [2]


def test_read_executions_json(spark, scratch):
    from matchbook.sources.requests import read_executions_json

    path = os.path.join(scratch, "ex.json")
    with open(path, "w") as f:
        f.write('{"symbol":"A","price":5,"size":2,"bid_request_id":"b","ask_request_id":"a",'
                '"executed_at":"2024-01-01T00:00:01","execution_id":"b-a"}\n')
    r = read_executions_json(spark, path).first()
    assert (r.symbol, r.price, r.size, r.execution_id, str(r.executed_at)) == ("A", 5, 2, "b-a", "2024-01-01 00:00:01")


def test_decode_request_records(spark):
    from matchbook.operators import book as book_ops
    from matchbook.sources.kafka import decode_request_records

    ev = '{"trade":{"instrument":{"symbol":"GOOG"},"side":"%s","price":"%s","size":%s},' \
         '"received_at":"2024-01-01T00:00:0%dZ","request_id":"r%d"}'
    raw = spark.createDataFrame([
        (0, 1, ev % ("SELL", "100", "10", 1, 1)),
        (0, 2, ev % ("BUY", "100", "4", 2, 2)),
        (0, 3, '{"trade":'),
        (0, 4, ev % ("BUY", "18446744073709551615", "1", 4, 4)),
        (0, 5, (ev % ("BUY", "100", "1", 5, 5)).replace("2024-01-01T00:00:05Z", "noon")),
    ], "partition int, offset long, value string")
    rows = {r.offset: r for r in decode_request_records(raw).collect()}
    assert (rows[1].side, rows[1].price, rows[1].size, rows[2].side) == (0, 100, 10, 1)
    assert (rows[3].reject_reason, rows[4].reject_reason) == ("undecodable", "out_of_range")
    tagged = book_ops.match_batch(decode_request_records(raw))
    assert [(r.price, r.size) for r in book_ops.executions(tagged).collect()] == [(100, 4)]
    assert {(r.offset, r.stage, r.reason) for r in book_ops.engine_rejects(tagged).collect()} == {
        (3, "decode", "undecodable"), (4, "decode", "out_of_range"), (5, "decode", "undecodable")}
    kept = {r.offset: r.raw for r in book_ops.engine_rejects(tagged).collect()}
    assert kept[3] == '{"trade":' and "noon" in kept[5]
    wide = {r.offset: r for r in decode_request_records(raw, wide=True).collect()}
    assert wide[4].reject_reason is None and int(wide[4].price) == 2**64 - 1


def test_bad_execution_values_are_undecodable(spark):
    one = '{"symbol":"A","price":%s,"size":%s,"execution_id":"x","executed_at":%s}'
    values = [("1.5", "2", "null"), ("-4", "2", "null"), ('"abc"', "2", "null"), ("1", "9223372036854775808", "null"),
              ("1", "2", '"noon"'), ('"7"', "2", '"2024-01-01T00:00:01.5Z"'), ("null", "2", "null")]
    lines = spark.createDataFrame([(i, one % v) for i, v in enumerate(values)], "offset long, value string")
    good, bad = decode_json(lines, EXECUTION)
    assert sorted(r.offset for r in bad.collect()) == [0, 1, 2, 3, 4]
    got = {r.offset: (r.price, r.size, r.bid_request_id, str(r.executed_at)) for r in good.collect()}
    assert got == {5: (7, 2, "", "2024-01-01 00:00:01.500000"), 6: (0, 2, "", "None")}


def test_request_log_batches_are_idempotent(spark, scratch):
    path = os.path.join(scratch, "requests")
    flow = spark.createDataFrame(rows(BASIC), REQUEST)
    for batch in (0, 0, 1):
        write_request_log(flow, path, 3, batch_id=batch, width=4)
    assert spark.read.parquet(path).groupBy("batch_id").count().orderBy("batch_id").collect() == [(0, 15), (1, 15)]


def test_line_numbers_do_not_depend_on_splits(spark, scratch):
    """The same positions and ids for one split and for many, over several files of uneven lines."""
    folder = os.path.join(scratch, "lines")
    os.makedirs(folder)
    for name, n in (("a", 300), ("b", 1), ("c", 77)):
        with open(os.path.join(folder, name), "w") as f:
            f.writelines(f"{name}-{i} {'x' * (i * 37 % 400)}\n" for i in range(n))
    seen = []
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("128m", "3000b", "700b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            rows_ = read_submit_json(spark, folder).collect()
            assert all(r.value.split()[0] == f"{os.path.basename(r.source)}-{r.offset}" for r in rows_)
            seen.append({(r.source, r.offset) for r in rows_})
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(seen[0]) == 378 and seen[0] == seen[1] == seen[2]


def test_hash_bucket_is_fnv(spark):
    from matchbook.functions.symbols import hash_bucket

    def fnv(key, n):
        h = 2166136261
        for b in key.encode():
            h = (h ^ b) * 16777619 % 2**32
        h -= 2**32 if h >= 2**31 else 0
        return abs(int(__import__("math").fmod(h, n)))

    keys = ["", "A", "GOOG", "straße", "日本", "a" * 300]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for n in (1, 3, 8, 50):
        assert {r.k: r.p for r in df.select("k", hash_bucket("k", n).alias("p")).collect()} == {k: fnv(k, n) for k in keys}
