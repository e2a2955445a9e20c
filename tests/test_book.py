"""Pure book logic (no Spark): golden scenarios and properties."""

from hypothesis import given, settings
from hypothesis import strategies as st

from matchbook.operators.matching import Book, Cadence, TaggedRows, apply_requests
from matchbook.schemas import TAGGED_COLUMNS

C = {name: i for i, name in enumerate(TAGGED_COLUMNS)}
from scenarios import (BASIC, BASIC_BOOKS, BASIC_FILLS, BUY, RECOVERY, RECOVERY_BOOKS, RECOVERY_FILLS,
                       RECOVERY_SNAPSHOT_AFTER_4, SELL, expected_executions, rows)


def run(orders, books=None, snapshot_every=0):
    books = {} if books is None else books
    out = TaggedRows()
    for part, off, rid, at, sym, side, price, size in rows(orders):
        b = books.setdefault(sym, Book(sym))
        apply_requests(b, out, [(part, off, rid, at, side, price, size)], snapshot_every)
    return books, out.rows


def fills_of(tagged):
    return sorted((r[C["symbol"]], r[C["price"]], r[C["size"]], r[C["bid_request_id"]], r[C["ask_request_id"]])
                  for r in tagged if r[C["kind"]] == "fill")


def book_state(b):
    bids = [(o["price"], o["size"], o["seq"]) for o in b.side_orders(BUY)]
    asks = [(o["price"], o["size"], o["seq"]) for o in b.side_orders(SELL)]
    return bids, asks, b.seq


def test_basic_scenario():
    books, out = run(BASIC)
    assert fills_of(out) == expected_executions(BASIC, BASIC_FILLS)
    assert {s: book_state(b) for s, b in books.items()} == BASIC_BOOKS


def test_recovery_scenario_uninterrupted():
    books, out = run(RECOVERY)
    assert fills_of(out) == expected_executions(RECOVERY, RECOVERY_FILLS)
    assert {s: book_state(b) for s, b in books.items()} == RECOVERY_BOOKS


def test_recovery_snapshot_point():
    books, _ = run(RECOVERY[:4])
    assert {s: book_state(b) for s, b in books.items()} == RECOVERY_SNAPSHOT_AFTER_4


def test_smoke_scenario():
    books, out = run([("GOOG", SELL, 100, 10), ("GOOG", BUY, 100, 10)])
    assert fills_of(out) == [("GOOG", 100, 10, "2", "1")]
    assert book_state(books["GOOG"]) == ([], [], 2)


def test_unknown_side_takes_a_sequence_number():
    books, out = run([("X", 7, 100, 1), ("X", SELL, 100, 1)])
    assert [r[0] for r in out] == ["reject"]
    assert out[0][C["reason"]] == "unknown_side" and out[0][C["stage"]] == "engine"
    assert book_state(books["X"]) == ([], [(100, 1, 2)], 2)


def test_execution_price_is_the_resting_price():
    _, out = run([("X", SELL, 90, 5), ("X", BUY, 120, 5)])
    assert fills_of(out) == [("X", 90, 5, "2", "1")]


def test_snapshot_every_n_orders():
    books, out = run(BASIC, snapshot_every=5)
    snaps = [r for r in out if r[0] == "snapshot"]
    assert [(r[C["symbol"]], r[C["seq"]]) for r in snaps] == [("GOOG", 5), ("AAPL", 5), ("MSFT", 5)]
    state = {}
    for r in out:  # the order log tells what rests in the book
        if r[0] == "step" and r[C["symbol"]] == "GOOG" and r[C["book_seq"]] <= 5:
            state[r[C["seq"]]] = (r[C["side"]], r[C["price"]], r[C["size"]])
    assert {k: v for k, v in state.items() if v[2]} == {4: ("BUY", 100, 2), 2: ("SELL", 101, 5)}


def test_interval_snapshots_close_with_a_later_order():
    out, b = TaggedRows(), Book("S")
    cadence = Cadence(interval_us=10_000_000)
    times = [3, 9, 12, 11, 35, None, 36]  # seconds; an earlier time closes nothing, a missing one neither
    for i, t in enumerate(times):
        apply_requests(b, out, [(0, i, str(i), None if t is None else t * 1_000_000, SELL, 100 + i, 1)], cadence)
    got = [(r[C["at"]] // 1_000_000, r[C["seq"]], r[C["offset"]]) for r in out.rows if r[0] == "snapshot"]
    assert got == [(10, 2, 1), (20, 4, 3)]


def test_redeliveries_come_back_as_refused_rows():
    out, b = TaggedRows(), Book("S")
    rows_ = [(0, 1, "a", 0, SELL, 100, 5), (0, 1, "a", 0, SELL, 100, 5), (0, 2, "b", 0, BUY, 100, 2), (0, 1, "a", 0, SELL, 100, 5)]
    apply_requests(b, out, rows_, 0)
    assert [(r[C["offset"]], r[C["reason"]]) for r in out.rows if r[0] == "reject"] == [(1, "duplicate_offset")] * 2
    assert book_state(b) == ([], [(100, 3, 1)], 2)


def test_levels_are_fetched_when_reached():
    asked = []

    def fetch(side, price):
        asked.append((side, price))
        return [[1, "old", 4]]

    b = Book("S", seq=1, fetch=fetch)
    b.add_prices(SELL, [105, 100, 110])
    b.submit(BUY, 99, 1, "x", [])
    assert asked == [] and b.touched == {(BUY, 99)}
    fills = []
    b.submit(BUY, 105, 6, "y", fills)
    assert fills == [(100, 4, "y", "old"), (105, 2, "y", "old")] and asked == [(SELL, 100), (SELL, 105)]
    assert b.prices[SELL] == {105, 110} and (SELL, 110) not in b.touched


def test_values_above_2_63_match_and_wrap():
    top = 2**64 - 1
    out, b = TaggedRows(), Book("S")
    apply_requests(b, out, [(0, 1, "a", 0, SELL, 2**63 + 5, top), (0, 2, "b", 0, BUY, top, 7)], 0)
    t = out.record_batch().to_pylist()
    assert [(r["price"] & top, r["size"]) for r in t] == [(2**63 + 5, 7)] and t[0]["price"] < 0
    assert b.side_orders(SELL)[0]["size"] == top - 7


order = st.tuples(st.sampled_from([BUY, SELL]), st.integers(95, 105), st.integers(1, 20))


@settings(max_examples=200, deadline=None)
@given(st.lists(order, min_size=1, max_size=60))
def test_properties(orders):
    orders = [("S", side, price, size) for side, price, size in orders]
    books, out = run(orders)
    b = books["S"]
    fills = [r for r in out if r[C["kind"]] == "fill"]
    filled = {}
    pairs = set()
    for r in fills:
        bid, ask, price, size = r[C["bid_request_id"]], r[C["ask_request_id"]], r[C["price"]], r[C["size"]]
        assert size > 0
        assert (bid, ask) not in pairs
        pairs.add((bid, ask))
        filled[bid] = filled.get(bid, 0) + size
        filled[ask] = filled.get(ask, 0) + size
        bid_limit = orders[int(bid) - 1][2]
        ask_limit = orders[int(ask) - 1][2]
        assert ask_limit <= price <= bid_limit
    resting = {o["id"]: o["size"] for side in (BUY, SELL) for o in b.side_orders(side)}
    for i, (_s, _side, _p, size) in enumerate(orders, start=1):
        assert filled.get(str(i), 0) + resting.get(str(i), 0) == size
    bids, asks = b.side_orders(BUY), b.side_orders(SELL)
    if bids and asks:
        assert bids[0]["price"] < asks[0]["price"]
    assert b.seq == len(orders)
