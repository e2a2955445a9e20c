"""Scalar goldens, normalisation, validation cases, JSON decode."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from matchbook.functions.render import dump_requests
from matchbook.functions.symbols import lex_bucket, lex_position, normalise_symbol, route
from matchbook.operators.validate import engine_checked, ingest
from matchbook.schemas import REQUEST
from matchbook.sources.requests import decode_submit_json

# Fixed golden values: (key, position, bucket n=3, bucket n=8).
GOLDENS = [
    ("GOOG", 0.25228896047057175, 0, 2), ("AAPL", 0.0008775077903434755, 0, 0),
    ("MSFT", 0.48849173698399917, 1, 3), ("IBM", 0.3098543468365954, 0, 2),
    ("JPM", 0.36902594446973147, 1, 2), ("TSLA", 0.7580223031406464, 2, 6),
    ("ZZZZZZ", 0.9999999158346643, 2, 7), ("1ABC", 6.127236441301076e-05, 0, 0),
    ("BRK.B", 0.06417850929050642, 0, 0), ("ÉAB", 2.1882987290360987e-06, 0, 0), ("A", 0.0, 0, 0),
]


def test_lex_goldens(spark):
    df = spark.createDataFrame([(g[0],) for g in GOLDENS], "k string")
    got = df.select("k", lex_position("k").alias("p"), lex_bucket("k", 3).alias("b3"),
                    lex_bucket("k", 8).alias("b8")).collect()
    assert [(r.k, r.p, r.b3, r.b8) for r in got] == GOLDENS


def test_route_falls_back_to_hash_for_empty_key(spark):
    df = spark.createDataFrame([("", "a"), ("", "b"), ("GOOG", "c")], "s string, id string")
    got = df.select(route("s", "id", 3).alias("p")).collect()
    assert all(0 <= r.p < 3 for r in got) and got[2].p == 0


def test_normalise_unicode_space(spark):
    df = spark.createDataFrame([("\t goog  ",), (" msft",)], "s string")
    assert [r.n for r in df.select(normalise_symbol("s").alias("n")).collect()] == ["GOOG", "MSFT"]


def _raw(spark, rows):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame(
        [("t", i, t, s, side, Decimal(p), Decimal(q)) for i, (s, side, p, q) in enumerate(rows)],
        "source string, offset long, received_at timestamp_ntz, symbol string, side int, "
        "price decimal(20,0), size decimal(20,0)")


def test_front_end_validation_cases(spark):
    raw = _raw(spark, [
        (None, 1, 100, 1),             # missing instrument
        ("  ", 1, 100, 1),             # blank symbol
        ("A", 1, 0, 0),                # size checked before price
        ("A", 1, 0, 5),                # price
        ("\t goog ", 1, 100, 1),       # accepted as GOOG
        ("A", None, 100, 1),           # side absent -> SELL
        ("A", 7, 100, 1),              # unknown side passes the front end
        ("A", 1, 18446744073709551615, 1),
    ])
    acc, rej = ingest(raw)
    assert {r.offset: r.reason for r in rej.collect()} == {
        0: "missing_instrument", 1: "empty_symbol", 2: "size", 3: "price"}
    acc = {r.offset: r for r in acc.collect()}
    assert acc[4].symbol == "GOOG" and acc[5].side == 0 and acc[6].side == 7
    assert int(acc[7].price) == 2**64 - 1
    assert len({r.request_id for r in acc.values()}) == 4 and all(len(r.request_id) == 32 for r in acc.values())


def test_engine_validation_keeps_raw_blank_symbol(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(0, 1, "r1", t, "  ", 1, 5, 1), (0, 2, "r2", t, "", 1, 5, 1),
                                (0, 3, "r3", t, None, 1, 5, 1)], REQUEST)
    got = {r.offset: r.engine_reason for r in engine_checked(df).collect()}
    assert got == {1: None, 2: "empty_symbol", 3: "missing_instrument"}


def test_decode_proto_json_forms(spark):
    lines = spark.createDataFrame([
        ("s", 0, '{"trade":{"instrument":{"symbol":"goog"},"side":"BUY","price":"100","size":5}}'),
        ("s", 1, '{"trade":{"instrument":{"symbol":"A"},"side":1,"price":100,"size":"2"}}'),
        ("s", 2, '{"trade":{"instrument":{},"price":"1","size":"1"}}'),
        ("s", 3, '{"trade":{"side":"SELL","price":"1","size":"1"}}'),
        ("s", 4, '{"trade":{"instrument":{"symbol":"A"'),
    ], "source string, offset long, value string")
    good, bad = decode_submit_json(lines)
    g = {r.offset: r for r in good.collect()}
    assert (g[0].symbol, g[0].side, int(g[0].price), int(g[0].size)) == ("goog", 1, 100, 5)
    assert (g[1].side, int(g[1].size)) == (1, 2)
    assert g[2].symbol == "" and g[2].side is None and g[3].symbol is None
    assert [r.offset for r in bad.collect()] == [4]
    acc, rej = ingest(good)
    assert {r.offset: r.reason for r in rej.collect()} == {2: "empty_symbol", 3: "missing_instrument"}


def test_dump_renders_defaults(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([(0, 1, "r1", t, "GOOG", 0, 100, 5)], REQUEST)
    assert dump_requests(df).first().json == (
        '{"trade":{"instrument":{"symbol":"GOOG"},"side":"SELL","price":"100","size":"5"},'
        '"received_at":"2024-01-01T00:00:07.179575Z","request_id":"r1"}')


def test_bad_field_values_are_undecodable(spark):
    """Unknown side names, fractions, signs and words in a number fail the message; absent fields don't."""
    trade = '{"trade":{"instrument":{"symbol":"A"}%s}}'
    good = ["", ',"side":"BUY","price":"1","size":2', ',"side":7']
    bad = [',"side":"BUYY"', ',"side":"buy"', ',"price":"1.5"', ',"size":"-4"', ',"size":"abc"']
    lines = spark.createDataFrame([("s", i, trade % x) for i, x in enumerate(good + bad)], "source string, offset long, value string")
    from matchbook.sources.requests import decode_submit_json

    decoded, rejects = decode_submit_json(lines)
    assert sorted(r.offset for r in decoded.collect()) == list(range(len(good)))
    assert {r.reason for r in rejects.collect()} == {"undecodable"} and rejects.count() == len(bad)


def test_sequence_keeps_null_keys_and_engine_refuses_negative_values(spark):
    from matchbook.operators.sequence import with_sequence
    from matchbook.operators.validate import engine_reason

    df = spark.createDataFrame([("A", None, i) for i in range(3)], "symbol string, partition int, offset long")
    assert sorted(r.seq for r in with_sequence(df).collect()) == [1, 2, 3]
    row = spark.createDataFrame([("A", "r", -4, 1), ("A", "r", 4, 1)], "symbol string, request_id string, price long, size long")
    assert [r.x is None for r in row.select("price", engine_reason(row).alias("x")).orderBy("price").collect()] == [False, True]
