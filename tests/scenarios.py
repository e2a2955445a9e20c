"""Golden scenarios as request rows: ``#`` is offset and request id; seq is per symbol from 1."""

import datetime as dt

BUY, SELL = 1, 0

# Fixed scenario data (orders as submitted).
BASIC = [
    ("GOOG", SELL, 100, 10), ("GOOG", SELL, 101, 7), ("GOOG", BUY, 101, 12), ("GOOG", BUY, 100, 5),
    ("GOOG", SELL, 99, 3), ("AAPL", BUY, 200, 8), ("AAPL", BUY, 199, 6), ("AAPL", SELL, 199, 10),
    ("AAPL", SELL, 201, 2), ("AAPL", BUY, 205, 1), ("MSFT", SELL, 300, 4), ("MSFT", SELL, 302, 9),
    ("MSFT", BUY, 305, 6), ("MSFT", BUY, 301, 5), ("MSFT", SELL, 301, 2),
]
# (incoming #, size, price, resting #)
BASIC_FILLS = [
    (3, 10, 100, 1), (3, 2, 101, 2), (5, 3, 100, 4), (8, 8, 200, 6), (8, 2, 199, 7), (10, 1, 201, 9),
    (13, 4, 300, 11), (13, 2, 302, 12), (15, 2, 301, 14),
]
# symbol -> (bids [(price, size, seq)], asks [...], orderbook_seq)
BASIC_BOOKS = {
    "GOOG": ([(100, 2, 4)], [(101, 5, 2)], 5),
    "AAPL": ([(199, 4, 2)], [(201, 1, 4)], 5),
    "MSFT": ([(301, 3, 4)], [(302, 7, 2)], 5),
}

RECOVERY = [
    ("GOOG", SELL, 100, 10), ("GOOG", BUY, 120, 3), ("AAPL", BUY, 200, 5), ("AAPL", SELL, 205, 2),
    ("GOOG", SELL, 101, 6), ("GOOG", BUY, 101, 11), ("GOOG", BUY, 99, 4), ("GOOG", SELL, 98, 2),
    ("AAPL", BUY, 210, 7), ("AAPL", SELL, 200, 9), ("AAPL", SELL, 215, 1), ("GOOG", BUY, 105, 1),
    ("AAPL", BUY, 220, 1), ("AAPL", SELL, 199, 1),
]
RECOVERY_FILLS = [
    (2, 3, 100, 1), (6, 7, 100, 1), (6, 4, 101, 5), (8, 2, 99, 7), (9, 2, 205, 4), (10, 5, 210, 9),
    (10, 4, 200, 3), (12, 1, 101, 5), (13, 1, 215, 11), (14, 1, 200, 3),
]
RECOVERY_BOOKS = {
    "GOOG": ([(99, 2, 5)], [(101, 1, 3)], 7),
    "AAPL": ([], [], 7),
}
# Book after #4 (the snapshot point of the scenario).
RECOVERY_SNAPSHOT_AFTER_4 = {
    "GOOG": ([], [(100, 7, 1)], 2),
    "AAPL": ([(200, 5, 1)], [(205, 2, 2)], 2),
}

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def rows(orders, partition=0, first=1):
    """REQUEST rows: (partition, offset, request_id, received_at, symbol, side, price, size)."""
    return [(partition, i, str(i), T0 + dt.timedelta(seconds=i), sym, side, price, size)
            for i, (sym, side, price, size) in enumerate(orders, start=first)]


def expected_executions(orders, fills):
    """(symbol, price, size, bid_id, ask_id) per fill."""
    out = []
    for inc, size, price, rest in fills:
        sym, side = orders[inc - 1][0], orders[inc - 1][1]
        bid, ask = (str(inc), str(rest)) if side == BUY else (str(rest), str(inc))
        out.append((sym, price, size, bid, ask))
    return sorted(out)
