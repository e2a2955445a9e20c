"""Driver queries: each takes (spark, sf_dir) and returns a DataFrame over the given tables.

Every query takes all rows of ``events`` as submit requests (error events are broken ones) through the front end;
what a front end refuses goes along as refused rows or is left out by its checks, never by a filter on the event type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.render import dump_requests as _dump
from ..functions.render import execution_json, snapshot_json, trade_event_json
from ..functions.symbols import hash_bucket, lex_bucket, lex_position
from ..functions.unsigned import widened
from ..operators import book, compaction, lifetimes, snapshots, trades
from ..operators.epochs import match_in_epochs
from ..operators.routing import keyed_messages, write_message_log, write_request_log
from ..operators.sequence import offset_gaps as _gaps
from ..operators.sequence import with_sequence
from ..operators.validate import engine_checked, ingest, ingest_tagged
from ..schemas import (EXECUTION, EXECUTION_COLUMNS, KIND_SNAPSHOT, KIND_STEP, REQUEST, REQUEST_COLUMNS, SNAPSHOT,
                       SNAPSHOT_HEADER_COLUMNS, TAGGED)
from ..sources import dirty_requests, hot_flow, order_flow, read_table
from ..sources.kafka import decode_request_records
from ..sources.requests import decode_json, decode_submit_json

SNAPSHOT_EVERY = 10
#: Least offsets of a range of the time-split run; receive time between two interval snapshots (six hours).
EPOCH_WIDTH = 1 << 13
SNAPSHOT_INTERVAL_US = 6 * 3600 * 1_000_000
#: Partitions of a keyed message log; what ``wide_values`` adds to prices and sizes (2^63 lies amid the results).
MESSAGE_PARTITIONS = 8
WIDE_PRICE = 2**63 - 105_000_000
WIDE_SIZE = 2**63 - 5


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def _flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events through the front end; refused ones are marked and ride along."""
    return ingest_tagged(dirty_requests(_events(spark, sf_dir)))


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the front end accepts of all events (unknown sides too: the books refuse those)."""
    return ingest(dirty_requests(_events(spark, sf_dir)))[0]


def _in_files(df: DataFrame, slices: int = 3, order: str = "offset"):
    """A growing log: yields its folder after each of ``slices`` consecutive offset ranges was added to it as files."""
    spark = df.sparkSession
    path = trades.table_folder(spark, "log")
    lo, hi = df.agg(F.min(order), F.max(order)).first()
    lo, hi = lo or 0, hi or 0
    step = (hi - lo) // slices + 1
    for k in range(slices):
        part = df.filter(F.col(order).between(lo + k * step, lo + (k + 1) * step - 1))
        part.write.mode("append").parquet(path)
        yield path


def match_epochs(spark, sf_dir):
    """Executions of the time-split run (offset ranges, books carried through the checkpoint folder)."""
    out = trades.table_folder(spark, "epochs")
    return book.executions(match_in_epochs(_flow(spark, sf_dir), out, EPOCH_WIDTH))


def resting_orders_epochs(spark, sf_dir):
    """Final books of the time-split run; must equal ``resting_orders``."""
    out = trades.table_folder(spark, "epochs")
    return book.resting_orders(match_in_epochs(_flow(spark, sf_dir), out, EPOCH_WIDTH))


def hot_symbol_executions(spark, sf_dir):
    """Skew: about a third of all orders on one symbol, whose book one task runs."""
    return book.executions(book.match_batch(hot_flow(_flow(spark, sf_dir)), emit_final=False))


def hot_symbol_epochs(spark, sf_dir):
    """The skewed flow, time-split: a task holds one offset range of the hot symbol plus its carried book."""
    out = trades.table_folder(spark, "hot-epochs")
    return book.executions(match_in_epochs(hot_flow(_flow(spark, sf_dir)), out, EPOCH_WIDTH))


# ---- ingest and validation -------------------------------------------------

def ingest_accepted(spark, sf_dir):
    return ingest(dirty_requests(_events(spark, sf_dir)))[0]


def ingest_rejects(spark, sf_dir):
    return ingest(dirty_requests(_events(spark, sf_dir)))[1]


def reject_counts(spark, sf_dir):
    """Rejects of the whole path: front end, then the books (unknown side), counted per stage and reason.

    What the books refuse is a column test on the rows they get, so no book is run to count it.
    """
    checked = engine_checked(_flow(spark, sf_dir))
    unknown = F.col("reject_reason").isNull() & ~F.col("side").isin(0, 1)
    stage = F.when(unknown, F.lit("engine")).otherwise(F.col("reject_stage"))
    reason = F.when(unknown, F.lit("unknown_side")).otherwise(F.col("reject_reason"))
    return (checked.select(stage.alias("stage"), reason.alias("reason")).filter("reason is not null")
            .groupBy("stage", "reason").agg(F.count(F.lit(1)).alias("n")))


def offset_gaps(spark, sf_dir):
    """Ranges of offsets that are missing from the log of accepted requests, taken as one partition."""
    one = _accepted(spark, sf_dir).select(F.lit(0).alias("partition"), "offset")
    return _gaps(one)


def duplicate_offsets(spark, sf_dir):
    """A log in which a slice was delivered twice: every row that the run refuses, redeliveries among them."""
    flow = _flow(spark, sf_dir)
    top = flow.select(F.max("offset")).scalar()
    again = flow.filter((F.col("offset") * 4 > top) & (F.col("offset") * 2 <= top))
    return book.engine_rejects(book.match_batch(flow.unionByName(again), emit_final=False))


def duplicate_offsets_stream(spark, sf_dir):
    """The same log as a stream, the slice delivered again in files of its own after the whole log."""
    from ..streaming.jobs import read_stream_output, run_match_stream

    flow = _flow(spark, sf_dir)
    top = flow.select(F.max("offset")).first()[0] or 0
    out, ckpt = trades.table_folder(spark, "duplicates"), trades.table_folder(spark, "duplicates-ckpt")
    path = trades.table_folder(spark, "log")
    for part in (flow, flow.filter((F.col("offset") * 4 > top) & (F.col("offset") * 2 <= top))):
        part.write.mode("append").parquet(path)
        run_match_stream(spark.readStream.schema(flow.schema).parquet(path), out, ckpt)
    return read_stream_output(spark, out, "rejects").select("stage", "reason", "partition", "offset", "raw")


def lex_partition(spark, sf_dir):
    symbols = _accepted(spark, sf_dir).select("symbol").distinct()
    return symbols.select("symbol", lex_position("symbol").alias("position"),
                          lex_bucket("symbol", 3).alias("bucket_3"), lex_bucket("symbol", 8).alias("bucket_8"))


def engine_validate(spark, sf_dir):
    """Engine checks on raw (not front-end normalised) events."""
    raw = dirty_requests(_events(spark, sf_dir)).select(
        F.lit(None).cast("int").alias("partition"), "offset",
        F.concat(F.lit("r"), F.col("offset").cast("string")).alias("request_id"), "received_at", "symbol",
        "side", F.col("price").cast("long").alias("price"), F.col("size").cast("long").alias("size"))
    c = engine_checked(raw)
    reason = F.coalesce(F.col("engine_reason"),
                        F.when(~F.col("side").isin(0, 1), F.lit("unknown_side")))
    return c.select("offset", "symbol", "side", "price", "size", reason.alias("reason"),
                    F.col("engine_reason").isNull().alias("keyed"))


def order_sequence(spark, sf_dir):
    return with_sequence(_accepted(spark, sf_dir)).select("symbol", "partition", "offset", "seq")


# ---- matching and book products -------------------------------------------

def match_executions(spark, sf_dir):
    return book.executions(book.match_batch(_flow(spark, sf_dir), emit_final=False))


def executions_per_symbol(spark, sf_dir):
    """Flagship summary: fills, volume and notional (whole units) per symbol."""
    ex = match_executions(spark, sf_dir)
    return ex.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("fills"),
        F.sum("size").alias("volume"),
        (F.sum(F.col("size") * F.col("price")) / 1_000_000).cast("long").alias("notional"),
    )


def resting_orders(spark, sf_dir):
    return book.resting_orders(book.match_batch(_flow(spark, sf_dir)))


def top_of_book(spark, sf_dir):
    return book.top_of_book(resting_orders(spark, sf_dir))


def _books(spark, sf_dir, requests=None, symbols=None) -> tuple[DataFrame, DataFrame]:
    """(snapshot headers, order log) of a run, written by the tasks that run the books and read back.

    Rows are not dealt out by kind: there are two kinds, and one task would sort the whole order log.
    """
    req = requests if requests is not None else _flow(spark, sf_dir)
    tagged = book.match_batch(req, snapshot_every=SNAPSHOT_EVERY, emit_final=False, symbols=symbols)
    path = trades.table_folder(spark, "books")
    tagged.filter(F.col("kind").isin(KIND_SNAPSHOT, KIND_STEP)).write.parquet(path)
    log = spark.read.schema(TAGGED).parquet(path)
    return book.snapshots(log), lifetimes.order_log(log)


def book_snapshots_every_10(spark, sf_dir):
    return lifetimes.books_at(*_books(spark, sf_dir))


def latest_snapshots(spark, sf_dir):
    headers, steps = _books(spark, sf_dir)
    return lifetimes.books_of_latest(snapshots.latest_snapshots(headers), steps)


def order_lifetimes(spark, sf_dir):
    """Every stretch of every resting order's life: from which to which sequence number it rested with which size."""
    tagged = book.match_batch(_flow(spark, sf_dir), emit_final=False, steps=True)
    return lifetimes.lifetimes(lifetimes.order_log(tagged))


def _cut(flow: DataFrame):
    """Crash point: half of the highest offset (a scalar subquery, evaluated by Spark)."""
    return flow.select((F.max("offset") / 2).cast("long")).scalar()


def _resumed(spark, sf_dir) -> DataFrame:
    """Run up to the crash point with snapshots, restore the latest books, replay the whole log: what the snapshots
    cover is left out before the shuffle."""
    flow = _flow(spark, sf_dir)
    headers, steps = _books(spark, sf_dir, flow.filter(F.col("offset") <= _cut(flow)))
    latest = snapshots.latest_snapshots(headers)
    restored = snapshots.restore_rows(lifetimes.books_of_latest(latest, steps))
    return book.match_batch(snapshots.after_snapshot(flow, latest), restored=restored, emit_final=False)


def restore_and_resume(spark, sf_dir):
    return book.executions(_resumed(spark, sf_dir))


# ---- trades table ----------------------------------------------------------

def _build_trades_table(spark, sf_dir) -> str:
    """Executions inserted as batch 0, then the replay after the restore as batch 1; returns the folder."""
    path = trades.table_folder(spark, "trades")
    trades.insert_trades(spark, book.executions_with_position(book.match_batch(_flow(spark, sf_dir),
                                                                                emit_final=False)), path, 0)
    trades.insert_trades(spark, book.executions_with_position(_resumed(spark, sf_dir)), path, 1)
    return path


def _trades_table(spark, sf_dir) -> DataFrame:
    """The trades table for this input; every query pays for its own."""
    return trades.read_trades(spark, _build_trades_table(spark, sf_dir))


def trades_after_replay(spark, sf_dir):
    """The sink itself: insert the run, then its replay; the table must hold each execution once."""
    return trades.read_trades(spark, _build_trades_table(spark, sf_dir))


def trade_count(spark, sf_dir):
    return trades.trade_count(_trades_table(spark, sf_dir))


def recent_20(spark, sf_dir):
    return trades.recent_trades(_trades_table(spark, sf_dir), 20, nulls_first=True,
                                columns=["executed_at", "symbol", "price", "size"])


def recent_30(spark, sf_dir):
    return trades.recent_trades(_trades_table(spark, sf_dir), 30, nulls_first=False)


# ---- decode / dump ---------------------------------------------------------

def dump_requests(spark, sf_dir):
    return _dump(_accepted(spark, sf_dir)).select("offset", "json")


def decode_bad_rows(spark, sf_dir):
    """Every event rendered as a JSON request; error events arrive cut in half and must be quarantined, the others
    must come back as they were."""
    ev = dirty_requests(_events(spark, sf_dir), keep_type=True).withColumn("request_id", F.lit(""))
    text = trade_event_json(ev)
    text = F.when(F.col("event_type") == "error", F.substring(text, 1, F.floor(F.length(text) / 2).cast("int"))) \
        .otherwise(text)
    lines = ev.select("source", "offset", "received_at", text.alias("value"))
    good, bad = decode_submit_json(lines)
    good = good.select("offset", "symbol", "side", F.col("price").cast("long").alias("price"), F.col("size").cast("long").alias("size"))
    return bad.select("stage", "reason", "offset").unionByName(good, allowMissingColumns=True)


def decode_bad_values(spark, sf_dir):
    """Every event as a keyed log record; error events carry a bad time, side, price or size, or end too early. Good
    records come back as requests, the others refused with their text."""
    ev = order_flow(_events(spark, sf_dir), keep_type=True)
    text, kind, bad = trade_event_json(ev), F.col("offset") % 5, F.col("event_type") == "error"
    broken = (F.when(kind == 0, F.regexp_replace(text, '"received_at":"[^"]*"', '"received_at":"noon"'))
              .when(kind == 1, F.regexp_replace(text, '"side":"[A-Z]+"', '"side":"HOLD"'))
              .when(kind == 2, F.regexp_replace(text, '"price":"([0-9]+)"', '"price":"$1.5"'))
              .when(kind == 3, F.regexp_replace(text, '"size":"([0-9]+)"', '"size":"-$1"'))
              .otherwise(F.substring(text, 1, F.floor(F.length(text) / 2).cast("int"))))
    records = ev.select("partition", "offset", F.when(bad, broken).otherwise(text).alias("value"))
    found = decode_request_records(records)
    ok = F.col("reject_reason").isNull()
    return found.select("offset", "reject_stage", "reject_reason", "request_id",
                        *[F.when(ok, F.col(c)).alias(c) for c in ("received_at", "symbol", "side", "price", "size")])


# ---- streaming -------------------------------------------------------------

def match_stream(spark, sf_dir):
    """The request log as a file stream, matched by the keyed state operator in several micro-batches (availableNow).

    Output: the executions the stream's sink wrote; must equal ``match_executions``.
    """
    from ..streaming.jobs import read_stream_output, run_match_stream

    flow = _flow(spark, sf_dir)
    out = trades.table_folder(spark, "match-stream")
    *_, path = _in_files(flow)
    log = spark.readStream.schema(flow.schema).option("maxFilesPerTrigger", _files_per_trigger(spark, path)).parquet(path)
    run_match_stream(log, out, snapshot_every=SNAPSHOT_EVERY)
    return read_stream_output(spark, out).select(*EXECUTION_COLUMNS)


def _files_per_trigger(spark, path: str, batches: int = 3) -> int:
    return max(1, -(-len(spark.read.parquet(path).inputFiles()) // batches))


def interval_snapshots(spark, sf_dir):
    """Snapshot headers of every interval of receive time in which a book had orders, from the stream (the last
    interval of a book is open: no later order has closed it)."""
    from ..streaming.jobs import read_stream_output, run_match_stream

    flow = _flow(spark, sf_dir)
    out, ckpt = trades.table_folder(spark, "intervals"), trades.table_folder(spark, "intervals-ckpt")
    for path in _in_files(flow, 2):
        run_match_stream(spark.readStream.schema(flow.schema).parquet(path), out, ckpt, snapshot_interval_us=SNAPSHOT_INTERVAL_US)
    return read_stream_output(spark, out, "snapshots").select(*SNAPSHOT_HEADER_COLUMNS)


def ingest_stream(spark, sf_dir):
    """The front end as a stream over several files, restarted as the log grows: accepted and refused rows together."""
    from ..streaming.ingest import accepted_requests, refused_requests, run_ingest_stream

    raw = dirty_requests(_events(spark, sf_dir))
    out, ckpt = trades.table_folder(spark, "ingest"), trades.table_folder(spark, "ingest-ckpt")
    for path in _in_files(raw, 2):
        run_ingest_stream(spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1).parquet(path), out, ckpt)
    return accepted_requests(spark, out).unionByName(refused_requests(spark, out), allowMissingColumns=True)


def persist_stream(spark, sf_dir):
    """The persister over the growing execution log: the run's executions, then those of the replay after a restore."""
    from ..streaming.persist import execution_stream, run_persist_stream

    log, ckpt, path = (trades.table_folder(spark, x) for x in ("execution-log", "persist-ckpt", "trades"))
    whole = book.match_batch(_flow(spark, sf_dir), emit_final=False)
    for part in (whole, _resumed(spark, sf_dir)):
        book.executions_with_position(part).write.mode("append").parquet(log)
        run_persist_stream(execution_stream(spark, log, 8), path, checkpoint=ckpt)
    return trades.read_trades(spark, path)


def compacted_snapshots(spark, sf_dir):
    """The compacted snapshot log after three runs of the stream, each followed by a compaction; equals
    ``latest_snapshots``."""
    from ..streaming.jobs import read_stream_output, run_match_stream

    flow = _flow(spark, sf_dir)
    out, ckpt, store = (trades.table_folder(spark, x) for x in ("compact-log", "compact-ckpt", "compacted"))
    for path in _in_files(flow):
        run_match_stream(spark.readStream.schema(flow.schema).parquet(path), out, ckpt, snapshot_every=SNAPSHOT_EVERY)
        compaction.compact(spark, read_stream_output(spark, out, "snapshots"), read_stream_output(spark, out, "orders"), store)
    return compaction.compacted_books(spark, store)


def trades_two_runs(spark, sf_dir):
    """A run that ends at the crash point, then a restored run with a fresh checkpoint into the same folders;
    the trades table must hold each execution once."""
    from ..streaming.jobs import read_stream_output, run_match_stream

    flow = _flow(spark, sf_dir)
    cut = flow.select((F.max("offset") / 2).cast("long")).first()[0] or 0
    *_, path = _in_files(flow, 1)
    stream = spark.readStream.schema(flow.schema).parquet(path)
    out = trades.table_folder(spark, "two-runs")
    run_match_stream(stream.filter(F.col("offset") <= cut), out, out + "-first", snapshot_every=SNAPSHOT_EVERY)
    latest = snapshots.latest_snapshots(read_stream_output(spark, out, "snapshots"))
    books = lifetimes.books_of_latest(latest, read_stream_output(spark, out, "orders"))
    run_match_stream(stream, out, out + "-second", restored=snapshots.restore_rows(books))
    return trades.read_trades(spark, f"{out}/trades")


# ---- every event, bad ones included ----------------------------------------

def _all_requests(spark, sf_dir) -> DataFrame:
    """All events through the front end and the books: refused rows and unknown sides ride along."""
    return book.match_batch(ingest_tagged(dirty_requests(_events(spark, sf_dir))))


def all_requests_executions(spark, sf_dir):
    """Executions with refused rows mixed in, final books computed as well."""
    return book.executions(_all_requests(spark, sf_dir))


def all_requests_resting(spark, sf_dir):
    """Final books; ``seq`` shows the numbers that orders of unknown side took."""
    return book.resting_orders(_all_requests(spark, sf_dir))


# ---- messages and logs -----------------------------------------------------

def execution_round_trip(spark, sf_dir):
    """Executions encoded as messages and decoded again."""
    ex = book.executions_with_position(book.match_batch(_flow(spark, sf_dir), emit_final=False))
    lines = ex.select("partition", "offset", execution_json(ex).alias("value"))
    return decode_json(lines, EXECUTION)[0].select(*EXECUTION_COLUMNS)


def snapshot_round_trip(spark, sf_dir):
    """Book snapshots published as keyed messages, read back and decoded."""
    lane = hash_bucket(F.col("symbol"), MESSAGE_PARTITIONS)
    log = lifetimes.whole_books(*_books(spark, sf_dir), lane, MESSAGE_PARTITIONS, texts=True)
    path = trades.table_folder(spark, "snapshot-messages")
    write_message_log(keyed_messages(log, snapshot_json(log), MESSAGE_PARTITIONS, "symbol"), path, dealt=True)
    lines = spark.read.parquet(path).select("partition", F.lit(0).cast("long").alias("offset"), "value")
    return snapshots.flatten_snapshots(decode_json(lines, SNAPSHOT)[0])


def published_executions(spark, sf_dir):
    """Executions as the stream's sink publishes them: keyed messages in partitions dealt by hash of the key."""
    from ..streaming.jobs import read_stream_output, run_match_stream

    flow = _flow(spark, sf_dir)
    out = trades.table_folder(spark, "published")
    *_, path = _in_files(flow, 1)
    run_match_stream(spark.readStream.schema(flow.schema).parquet(path), out, message_partitions=MESSAGE_PARTITIONS)
    return read_stream_output(spark, out, "messages").select("key", "value", "partition")


def hash_partition(spark, sf_dir):
    """Message partition of every key, and of rows without one (the request id stands in)."""
    rows = _accepted(spark, sf_dir).withColumn("symbol", F.when(F.col("offset") % 7 == 0, F.lit("")).otherwise(F.col("symbol")))
    sent = keyed_messages(rows, F.col("request_id"), MESSAGE_PARTITIONS, "request_id")
    return sent.select("key", F.col("value").alias("request_id"), "partition")


def wide_values(spark, sf_dir):
    """Executions of a flow whose prices and sizes lie on both sides of 2^63, and what the table refuses of them."""
    raw = dirty_requests(_events(spark, sf_dir))
    lifted = {c: F.when(F.col(c) > 0, F.col(c).cast("decimal(20,0)") + F.lit(str(base)).cast("decimal(20,0)")).otherwise(0).cast("decimal(20,0)")
              for c, base in (("price", WIDE_PRICE), ("size", WIDE_SIZE))}
    tagged = book.match_batch(ingest_tagged(raw.withColumns(lifted)), emit_final=False)
    found = widened(book.executions(tagged), "price", "size")
    bad = trades.table_rejects(found).select(F.col("raw").alias("execution_id"), "reason")
    rows = found.join(bad, "execution_id", "left")
    return rows.select("execution_id", "symbol", F.col("price").cast("string").alias("price"), F.col("size").cast("string").alias("size"),
                       "executed_at", "reason")


def request_log_round_trip(spark, sf_dir):
    """The request log written twice (a retried batch), then read back."""
    path = trades.table_folder(spark, "request-log")
    for _ in range(2):
        write_request_log(_accepted(spark, sf_dir), path)
    return spark.read.schema(REQUEST).parquet(path).select(*REQUEST_COLUMNS)


#: The symbol that ``symbol_snapshots`` asks for.
ONE_SYMBOL = "AAA"


def symbol_snapshots(spark, sf_dir):
    """Latest snapshot of one symbol's book; the filter goes in front of the matcher."""
    headers, steps = _books(spark, sf_dir, symbols=[ONE_SYMBOL])
    return lifetimes.books_of_latest(snapshots.latest_snapshots(headers), steps)


QUERIES = {
    "published_executions": published_executions,
    "hash_partition": hash_partition,
    "wide_values": wide_values,
    "duplicate_offsets": duplicate_offsets,
    "duplicate_offsets_stream": duplicate_offsets_stream,
    "offset_gaps": offset_gaps,
    "ingest_stream": ingest_stream,
    "persist_stream": persist_stream,
    "compacted_snapshots": compacted_snapshots,
    "interval_snapshots": interval_snapshots,
    "decode_bad_values": decode_bad_values,
    "trades_two_runs": trades_two_runs,
    "all_requests_executions": all_requests_executions,
    "all_requests_resting": all_requests_resting,
    "execution_round_trip": execution_round_trip,
    "snapshot_round_trip": snapshot_round_trip,
    "request_log_round_trip": request_log_round_trip,
    "symbol_snapshots": symbol_snapshots,
    "ingest_accepted": ingest_accepted,
    "ingest_rejects": ingest_rejects,
    "reject_counts": reject_counts,
    "lex_partition": lex_partition,
    "engine_validate": engine_validate,
    "order_sequence": order_sequence,
    "match_executions": match_executions,
    "resting_orders": resting_orders,
    "top_of_book": top_of_book,
    "book_snapshots_every_10": book_snapshots_every_10,
    "latest_snapshots": latest_snapshots,
    "order_lifetimes": order_lifetimes,
    "restore_and_resume": restore_and_resume,
    "trades_after_replay": trades_after_replay,
    "trade_count": trade_count,
    "recent_20": recent_20,
    "recent_30": recent_30,
    "dump_requests": dump_requests,
    "decode_bad_rows": decode_bad_rows,
    "match_stream": match_stream,
    "match_epochs": match_epochs,
    "resting_orders_epochs": resting_orders_epochs,
    "hot_symbol_executions": hot_symbol_executions,
    "hot_symbol_epochs": hot_symbol_epochs,
}
