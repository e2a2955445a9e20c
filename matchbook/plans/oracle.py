"""DuckDB SQL that recomputes every driver query from the raw tables.

Matching is recomputed by a recursive CTE with a different algorithm from the
engine: one step per (symbol, sequence number); books are sorted lists of
``{k, s, id, q}`` (k = price for asks, -price for bids) and each step
allocates the incoming size over the crossing prefix by prefix sums.
"""

from __future__ import annotations

# The order-flow view over ``events`` (integer arithmetic only).
FLOW_ALL = """
flow_all AS (
  SELECT event_id AS "offset",
         'r' || CAST(event_id AS VARCHAR) AS request_id,
         CAST(ts AS TIMESTAMP) AS received_at,
         chr(CAST(65 + user_id % 26 AS INTEGER)) || chr(CAST(65 + (user_id // 26) % 26 AS INTEGER))
           || chr(CAST(65 + (user_id * 7) % 26 AS INTEGER)) AS symbol,
         CAST(CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS side,
         CAST((100 + CAST(floor(value) AS BIGINT) % 11) * 1000000 AS BIGINT) AS price,
         CAST(1 + (event_id // 2) % 9 AS BIGINT) AS size,
         event_type
  FROM events
)"""

# All events as submit requests (error events broken in one field), and the front end's verdict on them.
_DIRTY = FLOW_ALL + r""",
dirty AS (
  SELECT 'events' AS source, "offset", received_at,
         CASE WHEN event_type = 'error' AND "offset" % 5 = 3 THEN '   ' ELSE '  ' || lower(symbol) || ' ' END AS symbol,
         CAST(CASE WHEN event_type = 'error' AND "offset" % 5 = 4 THEN 7 ELSE side END AS INTEGER) AS side,
         CAST(CASE WHEN event_type = 'error' AND "offset" % 5 IN (0, 2) THEN 0 ELSE price END AS BIGINT) AS price,
         CAST(CASE WHEN event_type = 'error' AND "offset" % 5 IN (1, 2) THEN 0 ELSE size END AS BIGINT) AS size,
         event_type
  FROM flow_all
),
norm AS (
  SELECT *, upper(regexp_replace(symbol, '^[\s\pZ]+|[\s\pZ]+$', '', 'g')) AS nsym,
         concat_ws('|', symbol, CAST(side AS VARCHAR), CAST(price AS VARCHAR), CAST(size AS VARCHAR)) AS raw
  FROM dirty
),
ing AS (
  SELECT *, CASE WHEN symbol IS NULL THEN 'missing_instrument' WHEN nsym = '' THEN 'empty_symbol'
                 WHEN size = 0 THEN 'size' WHEN price = 0 THEN 'price' END AS reason
  FROM norm
)"""


def lex_position_sql(expr: str) -> str:
    """Base-26 position of the first five bytes of upper(expr), same summation order as the engine."""
    hexed = f"hex(encode(upper({expr})))"
    terms = []
    for i in range(5):
        byte = f"CASE WHEN length({hexed}) >= {2 * i + 2} THEN ('0x' || substr({hexed}, {2 * i + 1}, 2))::INTEGER ELSE 0 END"
        letter = f"(CASE WHEN {byte} BETWEEN 65 AND 90 THEN {byte} - 65 WHEN {byte} BETWEEN 97 AND 122 THEN {byte} - 97 ELSE 0 END)"
        terms.append(letter)
    score = "CAST(0.0 AS DOUBLE)"
    weight = 1.0 / 26.0
    for t in terms:
        score = f"({score} + CAST({t} AS DOUBLE) * CAST({weight!r} AS DOUBLE))"
        weight /= 26.0
    return score


def lex_bucket_sql(expr: str, n: int) -> str:
    return f"CAST(least(floor({lex_position_sql(expr)} * {float(n)!r}), {n - 1}) AS INTEGER)"


# What the front end accepts.
FLOW = _DIRTY
FLOW_P = f"""
flow_p AS (
  SELECT "offset", md5('events|' || CAST("offset" AS VARCHAR)) AS request_id, received_at, nsym AS symbol, side,
         price, size, {lex_bucket_sql('nsym', 3)} AS "partition"
  FROM ing WHERE reason IS NULL
)"""

_ORDER = "STRUCT(k BIGINT, s BIGINT, id VARCHAR, q BIGINT)"
_FILL = "STRUCT(n INTEGER, price BIGINT, q BIGINT, bid VARCHAR, ask VARCHAR)"


def match_cte(source: str = "seqd") -> str:
    """Recursive matching over ``source(symbol, seq, "offset", partition, request_id, received_at, side, price, size)``.

    Produces ``steps(symbol, seq, "offset", "partition", received_at, bids, asks, fills)``; step 0 is the
    empty book of each symbol.
    """
    alloc = ("list_transform(opp, lambda x, i: CASE WHEN x.k <= lim THEN greatest(0, least(x.q, size - "
             "coalesce(list_sum(list_transform(list_slice(opp, 1, i - 1), lambda y: y.q)), 0))) ELSE 0 END)")
    return f"""
steps(symbol, seq, "offset", "partition", received_at, bids, asks, fills) AS (
  SELECT symbol, CAST(0 AS BIGINT), CAST(-1 AS BIGINT), CAST(NULL AS INTEGER), CAST(NULL AS TIMESTAMP),
         CAST([] AS {_ORDER}[]), CAST([] AS {_ORDER}[]), CAST([] AS {_FILL}[])
  FROM (SELECT DISTINCT symbol FROM {source})
  UNION ALL
  SELECT symbol, seq, "offset", "partition", received_at,
         CASE WHEN side = 1 THEN (CASE WHEN rem > 0 THEN list_sort(list_append(bids, {{'k': -price, 's': seq, 'id': request_id, 'q': rem}})) ELSE bids END)
              WHEN side = 0 THEN kept ELSE bids END,
         CASE WHEN side = 1 THEN kept
              WHEN side = 0 AND rem > 0 THEN list_sort(list_append(asks, {{'k': price, 's': seq, 'id': request_id, 'q': rem}})) ELSE asks END,
         CAST(list_filter(list_transform(opp, lambda x, i: {{'n': CAST(i - 1 AS INTEGER), 'price': CASE WHEN side = 1 THEN x.k ELSE -x.k END,
                 'q': alloc[i], 'bid': CASE WHEN side = 1 THEN request_id ELSE x.id END,
                 'ask': CASE WHEN side = 1 THEN x.id ELSE request_id END}}), lambda f: f.q > 0) AS {_FILL}[])
  FROM (
    SELECT *, size - coalesce(list_sum(alloc), 0) AS rem,
           list_filter(list_transform(opp, lambda x, i: {{'k': x.k, 's': x.s, 'id': x.id, 'q': x.q - alloc[i]}}), lambda x: x.q > 0) AS kept
    FROM (
      SELECT *, {alloc} AS alloc
      FROM (
        SELECT st.symbol, o.seq, o."offset", o."partition", o.received_at, o.side, o.price, o.size, o.request_id,
               st.bids, st.asks,
               CASE o.side WHEN 1 THEN st.asks WHEN 0 THEN st.bids ELSE CAST([] AS {_ORDER}[]) END AS opp,
               CASE WHEN o.side = 1 THEN o.price ELSE -o.price END AS lim
        FROM steps st JOIN {source} o ON o.symbol = st.symbol AND o.seq = st.seq + 1
      )
    )
  )
)"""


SEQD = """
seqd AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "partition", "offset") AS seq FROM flow_p
)"""


def with_match(final_select: str, extra_ctes: str = "") -> str:
    ctes = ",".join([FLOW, FLOW_P, SEQD, match_cte("seqd")])
    if extra_ctes:
        ctes += "," + extra_ctes
    return f"WITH RECURSIVE {ctes}\n{final_select}"



_EXEC_ROWS = """
SELECT symbol, f.price AS price, f.q AS size, f.bid AS bid_request_id, f.ask AS ask_request_id,
       received_at AS executed_at, f.bid || '-' || f.ask AS execution_id
FROM (SELECT symbol, received_at, unnest(fills) AS f FROM steps WHERE seq > 0)"""

EXECUTIONS = with_match(_EXEC_ROWS)

_LAST = """
last AS (SELECT * FROM steps QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY seq DESC) = 1)"""

_RESTING_ROWS = """
SELECT symbol, 'BUY' AS side, b.id AS id, -b.k AS price, b.q AS size, b.s AS seq
FROM (SELECT symbol, unnest(bids) AS b FROM last)
UNION ALL
SELECT symbol, 'SELL' AS side, a.id AS id, a.k AS price, a.q AS size, a.s AS seq
FROM (SELECT symbol, unnest(asks) AS a FROM last)
"""
RESTING = with_match(_RESTING_ROWS, _LAST)

TOP_OF_BOOK = with_match("""
SELECT symbol, bids[1].id AS bid_id, -bids[1].k AS bid_price, bids[1].q AS bid_size,
       asks[1].id AS ask_id, asks[1].k AS ask_price, asks[1].q AS ask_size
FROM last WHERE len(bids) > 0 OR len(asks) > 0
""", _LAST)

_FLAT_ORDER = "STRUCT(side VARCHAR, id VARCHAR, price BIGINT, size BIGINT, seq BIGINT)"
# Every tenth order of a known side; orders of unknown side take a sequence number only.
_SNAP = """
counted AS (
  SELECT symbol, seq, side, count(*) FILTER (WHERE side IN (0, 1)) OVER (PARTITION BY symbol ORDER BY seq) AS known FROM seqd
),
snap AS (
  SELECT symbol, seq AS orderbook_seq, "offset" AS last_offset, received_at AS created_at,
         "partition" AS trades_partition, bids, asks
  FROM steps JOIN counted USING (symbol, seq) WHERE side IN (0, 1) AND known % 10 = 0
)"""


def _flatten(src: str) -> str:
    orders = ("list_concat(list_transform(bids, lambda b: {'side': 'BUY', 'id': b.id, 'price': -b.k, 'size': b.q, 'seq': b.s}), "
              "list_transform(asks, lambda a: {'side': 'SELL', 'id': a.id, 'price': a.k, 'size': a.q, 'seq': a.s}))")
    return f"""
SELECT symbol, orderbook_seq, last_offset, created_at, trades_partition,
       o.side AS side, o.id AS id, o.price AS price, o.size AS size, o.seq AS seq
FROM (SELECT *, unnest(CASE WHEN len(bids) + len(asks) = 0 THEN [CAST(NULL AS {_FLAT_ORDER})]
                            ELSE CAST({orders} AS {_FLAT_ORDER}[]) END) AS o FROM {src})"""


BOOK_SNAPSHOTS = with_match(_flatten("snap"), _SNAP)

LATEST_SNAPSHOTS = with_match(_flatten("latest"), _SNAP + """,
latest AS (SELECT * FROM snap QUALIFY row_number() OVER (
  PARTITION BY symbol ORDER BY created_at DESC, orderbook_seq DESC, trades_partition DESC, last_offset DESC) = 1)""")

_CUT = _SNAP + """,
cut AS (SELECT max("offset") // 2 AS c FROM flow_all),
snapcut AS (
  SELECT symbol, max(orderbook_seq) AS sseq FROM snap WHERE last_offset <= (SELECT c FROM cut) GROUP BY symbol
)"""

RESTORE_AND_RESUME = with_match("""
SELECT symbol, f.price AS price, f.q AS size, f.bid AS bid_request_id, f.ask AS ask_request_id,
       received_at AS executed_at, f.bid || '-' || f.ask AS execution_id
FROM (SELECT s.symbol, s.received_at, unnest(s.fills) AS f
      FROM steps s LEFT JOIN snapcut c ON c.symbol = s.symbol
      WHERE s.seq > coalesce(c.sseq, 0))
""", _CUT)

_EX = "ex AS (" + _EXEC_ROWS + ")"
TRADE_COUNT = with_match("SELECT count(*) AS trade_count FROM ex", _EX)
RECENT_20 = with_match("""
SELECT executed_at, symbol, price, size FROM ex
ORDER BY executed_at DESC NULLS FIRST, execution_id LIMIT 20""", _EX)
RECENT_30 = with_match("""
SELECT execution_id, symbol, price, size, bid_request_id, ask_request_id, executed_at FROM ex
ORDER BY executed_at DESC NULLS LAST, execution_id LIMIT 30""", _EX)

# ---- ingest, validation, routing -------------------------------------------

INGEST_ACCEPTED = f"""WITH {_DIRTY}
SELECT {lex_bucket_sql('nsym', 3)} AS "partition", "offset", md5('events|' || CAST("offset" AS VARCHAR)) AS request_id,
       received_at, nsym AS symbol, side, price, size
FROM ing WHERE reason IS NULL"""

INGEST_REJECTS = f"""WITH {_DIRTY}
SELECT 'ingest' AS stage, reason, CAST(NULL AS INTEGER) AS "partition", "offset", raw
FROM ing WHERE reason IS NOT NULL"""

REJECT_COUNTS = f"""WITH {_DIRTY}
SELECT stage, reason, count(*) AS n FROM (
  SELECT 'ingest' AS stage, reason FROM ing WHERE reason IS NOT NULL
  UNION ALL
  SELECT 'engine' AS stage, 'unknown_side' AS reason FROM ing WHERE reason IS NULL AND side NOT IN (0, 1)
) GROUP BY stage, reason"""

LEX_PARTITION = f"""WITH {FLOW}, {FLOW_P}
SELECT symbol, {lex_position_sql('symbol')} AS position, {lex_bucket_sql('symbol', 3)} AS bucket_3,
       {lex_bucket_sql('symbol', 8)} AS bucket_8
FROM (SELECT DISTINCT symbol FROM flow_p)"""

ENGINE_VALIDATE = f"""WITH {_DIRTY}
SELECT "offset", symbol, side, price, size,
       CASE WHEN symbol IS NULL THEN 'missing_instrument' WHEN symbol = '' THEN 'empty_symbol'
            WHEN price = 0 OR size = 0 THEN 'price_or_size'
            WHEN side NOT IN (0, 1) THEN 'unknown_side' END AS reason,
       (symbol IS NOT NULL AND symbol <> '' AND price <> 0 AND size <> 0) AS keyed
FROM dirty"""

ORDER_SEQUENCE = f"""WITH {FLOW}, {FLOW_P}, {SEQD}
SELECT symbol, "partition", "offset", seq FROM seqd"""

DUMP_REQUESTS = f"""WITH {FLOW}, {FLOW_P}
SELECT "offset",
  '{{"trade":{{"instrument":{{"symbol":"' || symbol || '"}},"side":"'
  || CASE side WHEN 1 THEN 'BUY' WHEN 0 THEN 'SELL' ELSE CAST(side AS VARCHAR) END
  || '","price":"' || CAST(price AS VARCHAR) || '","size":"' || CAST(size AS VARCHAR)
  || '"}},"received_at":"' || strftime(received_at, '%Y-%m-%dT%H:%M:%S.%fZ')
  || '","request_id":"' || request_id || '"}}' AS json
FROM flow_p"""

DECODE_BAD_ROWS = f"""WITH {_DIRTY}
SELECT CASE WHEN event_type = 'error' THEN 'decode' END AS stage, CASE WHEN event_type = 'error' THEN 'undecodable' END AS reason,
       "offset", CASE WHEN event_type <> 'error' THEN symbol END AS symbol, CASE WHEN event_type <> 'error' THEN side END AS side,
       CASE WHEN event_type <> 'error' THEN price END AS price, CASE WHEN event_type <> 'error' THEN size END AS size
FROM dirty"""

_RECORD = """'{"trade":{"instrument":{"symbol":"' || symbol || '"},"side":"' || side_text || '","price":"' || price_text
  || '","size":"' || size_text || '"},"received_at":"' || at_text || '","request_id":"' || request_id || '"}'"""
DECODE_BAD_VALUES = f"""WITH {FLOW_ALL},
named AS (
  SELECT *, event_type = 'error' AS bad, "offset" % 5 AS kind FROM flow_all
),
texts AS (
  SELECT *, CASE WHEN bad AND kind = 0 THEN 'noon' ELSE strftime(received_at, '%Y-%m-%dT%H:%M:%S.%fZ') END AS at_text,
         CASE WHEN bad AND kind = 1 THEN 'HOLD' WHEN side = 1 THEN 'BUY' ELSE 'SELL' END AS side_text,
         CAST(price AS VARCHAR) || CASE WHEN bad AND kind = 2 THEN '.5' ELSE '' END AS price_text,
         CASE WHEN bad AND kind = 3 THEN '-' ELSE '' END || CAST(size AS VARCHAR) AS size_text
  FROM named
),
whole AS (SELECT *, {_RECORD} AS record FROM texts)
SELECT "offset", CASE WHEN bad THEN 'decode' END AS reject_stage, CASE WHEN bad THEN 'undecodable' END AS reject_reason,
       CASE WHEN bad AND kind = 4 THEN left(record, length(record) // 2) WHEN bad THEN record ELSE request_id END AS request_id,
       CASE WHEN NOT bad THEN received_at END AS received_at, CASE WHEN NOT bad THEN symbol END AS symbol,
       CASE WHEN NOT bad THEN side END AS side, CASE WHEN NOT bad THEN price END AS price, CASE WHEN NOT bad THEN size END AS size
FROM whole"""

_HOT_P = f"""
hot AS (SELECT * REPLACE (CASE WHEN symbol < 'J' THEN 'HOT' ELSE symbol END AS symbol) FROM flow_p),
hot_p AS (SELECT * REPLACE ({lex_bucket_sql('symbol', 3)} AS "partition") FROM hot)"""
HOT_EXECUTIONS = (f"WITH RECURSIVE {FLOW}, {FLOW_P}, {_HOT_P}, {SEQD.replace('flow_p', 'hot_p')}, {match_cte('seqd')}\n" + _EXEC_ROWS)

ALL_EXECUTIONS = EXECUTIONS
ALL_RESTING = RESTING

# Everything that a run over the log with a redelivered slice refuses.
DUPLICATE_OFFSETS = f"""WITH {FLOW}, {FLOW_P},
twice AS (SELECT *, 1 AS copy FROM ing UNION ALL
          SELECT *, 2 FROM ing WHERE "offset" * 4 > (SELECT max("offset") FROM ing) AND "offset" * 2 <= (SELECT max("offset") FROM ing)),
judged AS (SELECT *, CASE WHEN reason IS NOT NULL THEN reason WHEN copy = 2 THEN 'duplicate_offset'
                          WHEN side NOT IN (0, 1) THEN 'unknown_side' END AS verdict FROM twice)
SELECT CASE WHEN reason IS NOT NULL THEN 'ingest' ELSE 'engine' END AS stage, verdict AS reason, {lex_bucket_sql('nsym', 3)} AS "partition",
       "offset", md5('events|' || CAST("offset" AS VARCHAR)) AS raw
FROM judged WHERE verdict IS NOT NULL"""

OFFSET_GAPS = f"""WITH {FLOW}, {FLOW_P},
ahead AS (SELECT "offset", lead("offset") OVER (ORDER BY "offset") AS following FROM flow_p)
SELECT 0 AS "partition", "offset" + 1 AS first_missing, following - 1 AS last_missing FROM ahead WHERE following > "offset" + 1"""

INGEST_STREAM = f"""
SELECT "partition", "offset", request_id, received_at, symbol, side, price, size, NULL AS stage, NULL AS reason, NULL AS raw FROM ({INGEST_ACCEPTED})
UNION ALL
SELECT "partition", "offset", NULL, NULL, NULL, NULL, NULL, NULL, stage, reason, raw FROM ({INGEST_REJECTS})"""

# The state of a book before the first order of a later six-hour interval.
INTERVAL_SNAPSHOTS = f"""WITH {FLOW}, {FLOW_P}, {SEQD},
timed AS (SELECT *, epoch_us(received_at) // 21600000000 AS this FROM seqd),
topped AS (SELECT *, max(this) OVER (PARTITION BY symbol ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top,
                  lag("offset") OVER own AS before, lag("partition") OVER own AS part FROM timed
           WINDOW own AS (PARTITION BY symbol ORDER BY seq))
SELECT make_timestamp((top + 1) * 21600000000) AS created_at, symbol, part AS trades_partition, before AS last_offset, seq - 1 AS orderbook_seq
FROM topped WHERE this > top"""



def hash_bucket_sql(key: str, n: int) -> str:
    """32-bit FNV-1a of the key's bytes as a signed number, its remainder without the sign."""
    data = f"hex(encode({key}))"
    codes = f"list_transform(range(0, length({data}) // 2), lambda i: CAST('0x' || substr({data}, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))"
    hashed = f"list_reduce(list_prepend(CAST(2166136261 AS BIGINT), {codes}), lambda h, b: (xor(h, b) * 16777619) & 4294967295)"
    return f"CAST(abs((CASE WHEN {hashed} >= 2147483648 THEN {hashed} - 4294967296 ELSE {hashed} END) % {n}) AS INTEGER)"


HASH_PARTITION = f"""WITH {FLOW}, {FLOW_P}
SELECT CASE WHEN "offset" % 7 <> 0 THEN symbol END AS key, request_id,
       {hash_bucket_sql('CASE WHEN "offset" % 7 <> 0 THEN symbol ELSE request_id END', 8)} AS "partition" FROM flow_p"""

PUBLISHED = f"""
SELECT symbol AS key, {hash_bucket_sql('symbol', 8)} AS "partition",
       '{{"symbol":"' || symbol || '","price":"' || CAST(price AS VARCHAR) || '","size":"' || CAST(size AS VARCHAR) || '","bid_request_id":"'
       || bid_request_id || '","ask_request_id":"' || ask_request_id || '","executed_at":"' || strftime(executed_at, '%Y-%m-%dT%H:%M:%S.%fZ')
       || '","execution_id":"' || execution_id || '"}}' AS value
FROM ({EXECUTIONS})"""

# The same matching in 128-bit numbers; 0 stays 0, so the front end refuses the same rows.
_WIDE_P = """
wide_p AS (SELECT * REPLACE (CAST(price AS HUGEINT) + 9223372036749775808 AS price, CAST(size AS HUGEINT) + 9223372036854775803 AS size) FROM flow_p)"""
WIDE_VALUES = (f"WITH RECURSIVE {FLOW}, {FLOW_P}, {_WIDE_P}, {SEQD.replace('flow_p', 'wide_p')}, "
               + match_cte("seqd").replace("k BIGINT", "k HUGEINT").replace("q BIGINT", "q HUGEINT").replace("price BIGINT", "price HUGEINT")
               + f""", ex AS ({_EXEC_ROWS})
SELECT execution_id, symbol, CAST(price AS VARCHAR) AS price, CAST(size AS VARCHAR) AS size, executed_at,
       CASE WHEN price > 9223372036854775807 OR size > 9223372036854775807 THEN 'out_of_range' END AS reason FROM ex""")

REQUEST_LOG = f"WITH {FLOW}, {FLOW_P}\nSELECT * FROM flow_p"
SYMBOL_SNAPSHOTS = f"SELECT * FROM ({LATEST_SNAPSHOTS}) WHERE symbol = 'AAA'"

# A run of steps in which an order rests with one size (the steps hold whole books; the engine writes changes only).
ORDER_LIFETIMES = with_match("""
SELECT symbol, side, id, price, seq, size, min(bseq) AS from_seq,
       CASE WHEN max(bseq) = any_value(last_seq) THEN NULL ELSE max(bseq) + 1 END AS to_seq
FROM rested JOIN ends USING (symbol) GROUP BY symbol, side, id, price, seq, size""", """
rested AS (
  SELECT symbol, seq AS bseq, 'BUY' AS side, b.id AS id, -b.k AS price, b.s AS seq, b.q AS size FROM (SELECT symbol, seq, unnest(bids) AS b FROM steps)
  UNION ALL
  SELECT symbol, seq, 'SELL', a.id, a.k, a.s, a.q FROM (SELECT symbol, seq, unnest(asks) AS a FROM steps)
),
ends AS (SELECT symbol, max(seq) AS last_seq FROM steps GROUP BY symbol)""")

ORACLE = {
    "published_executions": PUBLISHED,
    "hash_partition": HASH_PARTITION,
    "wide_values": WIDE_VALUES,
    "duplicate_offsets": DUPLICATE_OFFSETS,
    "duplicate_offsets_stream": DUPLICATE_OFFSETS,
    "offset_gaps": OFFSET_GAPS,
    "ingest_stream": INGEST_STREAM,
    "persist_stream": EXECUTIONS,
    "compacted_snapshots": LATEST_SNAPSHOTS,
    "interval_snapshots": INTERVAL_SNAPSHOTS,
    "decode_bad_values": DECODE_BAD_VALUES,
    "order_lifetimes": ORDER_LIFETIMES,
    "trades_two_runs": EXECUTIONS,
    "all_requests_executions": ALL_EXECUTIONS,
    "all_requests_resting": ALL_RESTING,
    "execution_round_trip": EXECUTIONS,
    "snapshot_round_trip": BOOK_SNAPSHOTS,
    "request_log_round_trip": REQUEST_LOG,
    "symbol_snapshots": SYMBOL_SNAPSHOTS,
    "ingest_accepted": INGEST_ACCEPTED,
    "ingest_rejects": INGEST_REJECTS,
    "reject_counts": REJECT_COUNTS,
    "lex_partition": LEX_PARTITION,
    "engine_validate": ENGINE_VALIDATE,
    "order_sequence": ORDER_SEQUENCE,
    "match_executions": EXECUTIONS,
    "resting_orders": RESTING,
    "top_of_book": TOP_OF_BOOK,
    "book_snapshots_every_10": BOOK_SNAPSHOTS,
    "latest_snapshots": LATEST_SNAPSHOTS,
    "restore_and_resume": RESTORE_AND_RESUME,
    "trades_after_replay": EXECUTIONS,
    "trade_count": TRADE_COUNT,
    "recent_20": RECENT_20,
    "recent_30": RECENT_30,
    "dump_requests": DUMP_REQUESTS,
    "decode_bad_rows": DECODE_BAD_ROWS,
    "match_stream": EXECUTIONS,
    "match_epochs": EXECUTIONS,
    "resting_orders_epochs": RESTING,
    "hot_symbol_executions": HOT_EXECUTIONS,
    "hot_symbol_epochs": HOT_EXECUTIONS,
}
