"""Queries of the sequential books: venue messages as JSON, mapped, chained and rebuilt; evidence against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators import books, cutover, engine, venues
from tickloom.operators import normalize as N
from tickloom.plans import views as V
from tickloom.plans.q_normalize import BROKEN
from tickloom.plans.registry import query
from tickloom.sources import tables

C, L = F.col, F.lit
YEAR_NS = 31_536_000_000_000_000
#: Moves the times of the messages behind the checksum cutover.
LATER_MS = 1_100_000_000_000
KEPT = ("instrument_uid", "epoch_id", "received_time_ns", "event_id")


def _sides(spark, d) -> DataFrame:
    """Book events with their levels as structs per instrument and year, numbered ``n`` within."""
    level = F.struct("level_ordinal", "side", "price", "amount", "action")
    rows = V.book_events(spark, d, F.array_sort(F.collect_list(level)).alias("__levels")).drop("levels").withColumnRenamed("__levels", "levels")
    rows = rows.withColumn("epoch_id", F.expr(f"cast(received_time_ns div {YEAR_NS} AS string)"))
    n = F.row_number().over(Window.partitionBy("instrument_uid", "epoch_id").orderBy("received_time_ns", "event_id"))
    return rows.withColumns({"n": n.cast("long"), "ms": F.expr("received_time_ns div 1000000")})


def _texts(levels: str, side: str, tag: bool = False):
    """Levels of one side as the venues write them: [price, amount] or [action, price, amount] texts."""
    short = lambda x, c: x[c].cast("decimal(18,2)").cast("string")
    parts = lambda x: ([x["action"]] if tag else []) + [short(x, "price"), short(x, "amount")]
    return F.transform(F.filter(levels, lambda x: x["side"] == side), lambda x: F.array(*parts(x)))


def _mapped(rows: DataFrame, message: dict, mapping: N.Mapping_, *more: str) -> DataFrame:
    """The message of each row as JSON, through its mapping."""
    made = rows.select(*KEPT, *more, F.to_json(F.struct(*(c.alias(k) for k, c in message.items()))).alias("payload"))
    return N.split(N.apply(made, mapping, keep=[*KEPT, *more]))[0].drop("message_ordinal")


def _held(rows: DataFrame) -> DataFrame:
    """What is read several times is computed once, in the folder that all share."""
    folder = tables.shared_folder(rows.sparkSession)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _kept(spark, d) -> DataFrame:
    """All but every 23rd event; the first of an epoch and every 40th is a snapshot."""
    return _sides(spark, d).where("event_id % 23 <> 0").withColumn("snap", C("n") % 40 == 1)


def _sums(rows: DataFrame, *names: str) -> DataFrame:
    return rows.where("kind = 'epoch'").groupBy("instrument_uid", "epoch_id").agg(*(F.sum(c).alias(c) for c in names))


# ---- one polled snapshot an epoch ---------------------------------------------------------------------------


def _single(spark, d) -> DataFrame:
    return _sides(spark, d).withColumn("update_kind", F.when(C("n") == 1, "snapshot").otherwise("delta"))


_ENGINE_BOOK = f"""SELECT instrument_uid, epoch_id, count(*) FILTER (side = 'buy') AS bids, count(*) FILTER (side = 'sell') AS asks FROM (SELECT instrument_uid,
    (received_time_ns // {YEAR_NS})::VARCHAR AS epoch_id, side, price, arg_max(action, (received_time_ns, event_id, level_ordinal)) AS act FROM book_levels GROUP BY ALL HAVING act <> 'delete') GROUP BY ALL"""


@query(_ENGINE_BOOK, ["book_levels"])
def r1_reconstructed_book(spark, d):
    """The engine's last book of every epoch; the oracle is the declarative form."""
    rows = engine.reconstruct(_single(spark, d), "bridge", check_crossed=False, changes=False)
    return rows.where("kind = 'epoch' AND bids + asks > 0").select("instrument_uid", "epoch_id", "bids", "asks")


@query(_ENGINE_BOOK, ["book_levels"])
def u3_snapshot_source(spark, d):
    """As r1_reconstructed_book, with the snapshots from a frame of their own."""
    events = _single(spark, d)
    merged = books.with_snapshots(events.where("update_kind = 'delta'"), events.where("update_kind = 'snapshot'"))
    rows = engine.reconstruct(merged, "bridge", check_crossed=False, changes=False)
    return rows.where("kind = 'epoch' AND bids + asks > 0").select("instrument_uid", "epoch_id", "bids", "asks")


@query()
def r1_crossing_books(spark, d):
    rows = engine.reconstruct(_single(spark, d), changes=False).where("kind = 'epoch'")
    return rows.groupBy("instrument_uid", "close_reason").agg(F.count("*").alias("n"), F.sum("applied").alias("applied"), F.sum("refused").alias("refused"))


@query(
    f"""SELECT instrument_uid, epoch_id, count(*) AS accepted, count(*) - 1 AS applied, 0 AS gaps, arg_min(event_id, (received_time_ns, event_id)) AS first_accepted,
    arg_max(event_id, (received_time_ns, event_id)) AS last_accepted, CASE WHEN epoch_id = max(epoch_id) OVER (PARTITION BY instrument_uid) THEN 'explicit_close'
    ELSE 'raw_connection_epoch_changed' END AS close_reason, CASE WHEN epoch_id = min(epoch_id) OVER (PARTITION BY instrument_uid) THEN 'initial' ELSE 'raw_connection_epoch_changed' END AS opened_by,
    row_number() OVER (PARTITION BY instrument_uid ORDER BY epoch_id) AS number FROM (SELECT *, (received_time_ns // {YEAR_NS})::VARCHAR AS epoch_id FROM book_events) GROUP BY instrument_uid, epoch_id""",
    ["book_events"],
)
def r2_epoch_evidence(spark, d):
    rows = engine.linked_epochs(engine.reconstruct(_single(spark, d), "bridge", check_crossed=False, changes=False))
    names = ("instrument_uid", "epoch_id", "accepted", "applied", "first_accepted", "last_accepted", "close_reason", "opened_by", "number")
    return rows.select(*names, C("gaps").cast("int").alias("gaps"))


# ---- snapshots beside the stream ------------------------------------------------------------------------------

#: Kept events, with the snapshots' marks and, per epoch, the islands between holes in their numbers.
_ISLANDS = f"""SELECT *, sum(hole) OVER (PARTITION BY instrument_uid, epoch_id ORDER BY n) AS island FROM (SELECT *, n % 40 = 1 AS snap,
    coalesce((n <> lag(n) OVER (PARTITION BY instrument_uid, epoch_id ORDER BY n) + 1)::INTEGER, 0) AS hole FROM (SELECT *, row_number() OVER
    (PARTITION BY instrument_uid, epoch_id ORDER BY received_time_ns, event_id) AS n FROM (SELECT *, (received_time_ns // {YEAR_NS})::VARCHAR AS epoch_id FROM book_events)) WHERE event_id % 23 <> 0)"""
_SEEDED = f"""SELECT *, min(n) FILTER (snap) OVER (PARTITION BY instrument_uid, epoch_id, island) AS seed, max(n) FILTER (snap) OVER (PARTITION BY instrument_uid, epoch_id) AS last_seed,
    row_number() OVER (PARTITION BY instrument_uid, epoch_id, island ORDER BY n DESC) = 1 AS tail, island = max(island) OVER (PARTITION BY instrument_uid, epoch_id) AS latest FROM ({_ISLANDS})"""


def _beside(spark, d, update, update_map, snapshot, snapshot_map) -> DataFrame:
    """Mapped updates and, right behind the events marked as snapshots, mapped snapshots of the same moment."""
    rows = _held(_kept(spark, d))  # both kinds of message are made from it
    updates = _mapped(rows, update, update_map).withColumn("part", L(0))
    polled = _mapped(rows.where("snap"), snapshot, snapshot_map).withColumn("part", L(1))
    return books.with_snapshots(updates.drop("update_kind"), polled.drop("update_kind"))


BESIDE = ("received_time_ns", "event_id", "part")


@query(
    f"""SELECT instrument_uid, epoch_id, count(*) FILTER (n >= seed) AS applied, count(*) FILTER ((seed IS NULL OR n < seed) AND n < last_seed) AS stale,
    count_if(seed IS NOT NULL AND tail AND NOT latest) AS gaps, count(*) FILTER (snap AND n > seed) AS refused FROM ({_SEEDED}) GROUP BY ALL""",
    ["book_events"],
)
def r4_chained_books(spark, d):
    """Futures depth messages and polled snapshots: the bridge spans the snapshot, then each names the previous final id."""
    update = {
        "e": L("depthUpdate"), "E": C("ms"), "T": C("ms"), "s": C("instrument_uid"), "U": C("first_sequence"), "u": C("last_sequence"), "pu": C("first_sequence") - 1,
        "b": _texts("levels", "buy"), "a": _texts("levels", "sell"),
    }
    snapshot = {"lastUpdateId": C("last_sequence"), "bids": _texts("levels", "buy"), "asks": _texts("levels", "sell")}
    events = _beside(spark, d, update, venues.USDM["depth"], snapshot, venues.SPOT_SNAPSHOT)
    return _sums(engine.reconstruct(events, "chain", order=BESIDE, changes=False), "applied", "stale", "gaps", "refused")


@query(
    f"""SELECT instrument_uid, epoch_id, count(*) FILTER (n > seed) AS applied, count_if(hole = 1) AS gaps, count(*) FILTER (snap AND n > seed) AS refused,
    count(DISTINCT island) FILTER (seed IS NOT NULL) AS outputs FROM ({_SEEDED}) GROUP BY ALL""",
    ["book_events"],
)
def r6_contiguous_books(spark, d):
    """The full book: ids rise by one, and a polled snapshot fits where id and cross sequence are those of a waiting update."""
    body = F.struct(C("instrument_uid").alias("s"), _texts("levels", "buy").alias("b"), _texts("levels", "sell").alias("a"), (C("n") + 1).alias("u"), (C("n") * 10).alias("seq"), C("ms").alias("ts"))
    update = {"topic": F.concat(L("orderbook.full."), "instrument_uid"), "type": L("delta"), "ts": C("ms"), "cts": C("ms"), "data": body}
    events = _beside(spark, d, update, venues.BYBIT["full_book"], {"retCode": L(0), "result": body}, venues.BYBIT_SNAPSHOT)
    found = _sums(engine.reconstruct(events, "contiguous", order=BESIDE, changes=False), "applied", "gaps", "refused", "outputs")
    return found.withColumn("outputs", C("outputs") - C("applied"))


# ---- snapshots in the stream ------------------------------------------------------------------------------------


#: Events that name a price twice on a side; venues with distinct or strict levels refuse such messages.
_TWICE = "event_id IN (SELECT event_id FROM book_levels GROUP BY event_id, side, price HAVING count(*) > 1)"


def _stream_sql(breaks: str) -> str:
    """Updates from a snapshot to the first break apply; after it nothing does until the next snapshot."""
    rows = f"""SELECT *, count_if(snap) OVER w AS part, lag(last_sequence) OVER w AS p FROM (SELECT *, n % 40 = 1 AS snap FROM (SELECT *, row_number() OVER
    (PARTITION BY instrument_uid, epoch_id ORDER BY received_time_ns, event_id) AS n FROM (SELECT *, (received_time_ns // {YEAR_NS})::VARCHAR AS epoch_id FROM book_events)) WHERE event_id % 23 <> 0)
    WINDOW w AS (PARTITION BY instrument_uid, epoch_id ORDER BY received_time_ns, event_id)"""
    return f"""SELECT instrument_uid, epoch_id, count_if(snap AND ok) AS seeds, count_if(NOT snap AND part > 0 AND broken = 0) AS applied, count_if(gap AND broken = 1 AND before = 0) AS gaps,
    count_if(NOT (snap AND ok) AND (part = 0 OR broken > 0) AND NOT (gap AND broken = 1 AND before = 0 AND part > 0)) AS refused FROM (SELECT *, coalesce(max(broken) OVER (PARTITION BY instrument_uid, epoch_id, part
    ORDER BY received_time_ns, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (SELECT *, max((part > 0 AND (gap OR NOT ok))::INTEGER) OVER (PARTITION BY instrument_uid, epoch_id, part
    ORDER BY received_time_ns, event_id) AS broken FROM (SELECT *, {breaks} FROM ({rows})))) GROUP BY ALL"""


def _result(rows: DataFrame) -> DataFrame:
    found = rows.where("kind = 'epoch'").groupBy("instrument_uid", "epoch_id")
    seeds = F.sum(C("accepted") - C("applied") - C("stale")).alias("seeds")
    return found.agg(seeds, *(F.sum(c).alias(c) for c in ("applied", "gaps", "refused")))


@query(_stream_sql("NOT snap AND event_id % 31 = 0 AS gap, true AS ok"), ["book_events"])
def r5_reset_books(spark, d):
    """The bounded book: deltas apply as they come, whatever was lost, but id 1 asks for a snapshot."""
    u = F.when((C("event_id") % 31 == 0) & ~C("snap"), 1).otherwise(C("last_sequence") + 1)
    data = F.struct(C("instrument_uid").alias("s"), _texts("levels", "buy").alias("b"), _texts("levels", "sell").alias("a"), u.alias("u"), C("n").alias("seq"))
    kind = F.when(C("snap"), "snapshot").otherwise("delta")
    message = {"topic": L("orderbook.50.X"), "type": kind, "ts": C("ms"), "cts": C("ms"), "data": data}
    return _result(engine.reconstruct(_mapped(_kept(spark, d), message, venues.BYBIT["book"]), "reset", changes=False))


@query(_stream_sql(f"NOT snap AND p <> first_sequence - 1 AS gap, event_id % 29 <> 0 AND NOT {_TWICE} AS ok"), ["book_events"])
def r7_previous_id_books(spark, d):
    """Previous ids chain from a snapshot's -1; every 29th message has a checksum where zero is due; a price named twice is refused."""
    previous = F.when(C("snap"), -1).otherwise(C("first_sequence") - 1)
    wrong = F.when(C("event_id") % 29 == 0, 7).otherwise(0)
    body = F.struct(_texts("levels", "buy").alias("bids"), _texts("levels", "sell").alias("asks"), (C("ms") + LATER_MS).cast("string").alias("ts"), wrong.alias("checksum"), previous.alias("prevSeqId"), C("last_sequence").alias("seqId"))
    message = {"arg": F.struct(L("books").alias("channel"), C("instrument_uid").alias("instId")), "action": F.when(C("snap"), "snapshot").otherwise("update"), "data": F.array(body)}
    return _result(engine.reconstruct(_mapped(_kept(spark, d), message, venues.OKX["book"]), "previous", changes=False))


def _tagged(spark, d) -> DataFrame:
    """Levels with the action that fits what was held since the last snapshot; what needs none goes."""
    events = _sides(spark, d).withColumn("snap", C("n") % 40 == 1)
    per_epoch = Window.partitionBy("instrument_uid", "epoch_id").orderBy("n")
    lines = events.withColumn("part", F.count_if("snap").over(per_epoch)).select("*", F.inline("levels"))
    per_price = Window.partitionBy("instrument_uid", "epoch_id", "part", "side", "price").orderBy("n", "level_ordinal")
    held = F.coalesce(F.lag(C("amount") != 0).over(per_price), F.lit(False))
    action = F.when((C("amount") == 0) & held, "delete").when(C("amount") > 0, F.when(held, "change").otherwise("new"))
    level = F.struct("level_ordinal", "side", "price", "amount", action.alias("action"))
    levels = lines.select("event_id", F.when(action.isNotNull(), level).alias("l")).groupBy("event_id").agg(F.array_sort(F.collect_list("l")).alias("levels"))
    return events.drop("levels").join(levels, "event_id").where("event_id % 23 <> 0")


@query(_stream_sql("NOT snap AND p <> first_sequence - 1 AS gap, true AS ok"), ["book_events"])
def r8_change_id_books(spark, d):
    """Change ids chain by the previous one, and new, change and delete must fit the book."""
    data = F.struct(
        F.when(C("snap"), "snapshot").otherwise("change").alias("type"), C("ms").alias("timestamp"), C("instrument_uid").alias("instrument_name"), C("last_sequence").alias("change_id"),
        F.when(~C("snap"), C("first_sequence") - 1).alias("prev_change_id"), _texts("levels", "buy", True).alias("bids"), _texts("levels", "sell", True).alias("asks"),
    )
    message = {"params": F.struct(L("book.X.raw").alias("channel"), data.alias("data"))}
    return _result(engine.reconstruct(_mapped(_tagged(spark, d), message, venues.DERIBIT["book"]), "change", changes=False))


# ---- two runs of a mapper ------------------------------------------------------------------------------------------


def _run(raw: DataFrame, version: str, epochs: DataFrame) -> cutover.Run:
    kept = ["source_id", "received_time_ns", "record_id"]
    rows, bad = N.split(_held(N.apply(raw.withColumnRenamed("native_trade_id", "record_id"), venues.SPOT["trade"], keep=kept)))
    return cutover.Run(rows.withColumn("mapper_version", L(version)), bad, epochs)


_FIRST = "list_position([a[i] IS DISTINCT FROM b[i] FOR i IN range(1, greatest(coalesce(len(a), 0), coalesce(len(b), 0)) + 1)], true) - 1"
_ORDERED = "ORDER BY received_time_ns, native_trade_id"
_REFUSED = f"SELECT *, {BROKEN} AS bad_a, native_trade_id % 307 = 0 AS cut, native_trade_id % 211 = 0 AS moved FROM trades"


@query(
    f"""WITH r AS ({_REFUSED}), lists AS (SELECT source_id, 'accepted_field_identity' AS code, list(native_trade_id {_ORDERED}) FILTER (NOT bad_a) AS a, list(native_trade_id {_ORDERED}) FILTER (NOT bad_a AND NOT cut) AS b FROM r GROUP BY 1
    UNION ALL SELECT source_id, 'ordered_semantic_row_hash', list(native_trade_id * 10 {_ORDERED}) FILTER (NOT bad_a), list(native_trade_id * 10 + moved::INTEGER {_ORDERED}) FILTER (NOT bad_a AND NOT cut) FROM r GROUP BY 1
    UNION ALL SELECT source_id, 'rejection_projection', list(native_trade_id * 10 {_ORDERED}) FILTER (bad_a), list(native_trade_id * 10 + cut::INTEGER {_ORDERED}) FILTER (bad_a OR cut) FROM r GROUP BY 1
    UNION ALL SELECT source_id, 'rejection_counts', [count_if(bad_a), 0], [count_if(bad_a AND NOT cut), count_if(cut)] FROM r GROUP BY 1
    UNION ALL SELECT instrument_uid, unnest(['downstream_book_result', 'downstream_book_hash']), list(0 ORDER BY epoch_id), list(lost ORDER BY epoch_id) FROM
    (SELECT instrument_uid, received_time_ns // {YEAR_NS} AS epoch_id, max((event_id % 499 = 0)::INTEGER) AS lost FROM book_events GROUP BY ALL) GROUP BY 1)
    SELECT source_id AS scope, code, ({_FIRST})::BIGINT AS index FROM lists WHERE {_FIRST} >= 0""",
    ["trades", "book_events"],
)
def t7_dual_run(spark, d):
    """A candidate that reads some messages otherwise, refuses others, and rebuilds books from fewer events."""
    raw = V.raw_json(spark, d)
    moved = F.regexp_replace("payload", '"q":"[^"]*"', '"q":"1234567.5"')
    payload = F.when(C("native_trade_id") % 307 == 0, F.substring("payload", 1, 9)).when(C("native_trade_id") % 211 == 0, moved).otherwise(C("payload"))
    events = _single(spark, d).withColumns({"v1": L(True), "v2": C("event_id") % 499 != 0})
    rebuilt = _held(engine.reconstruct(events, "bridge", check_crossed=False, changes=False, runs=["v1", "v2"]))
    epochs = lambda run: engine.linked_epochs(rebuilt.where(C("run") == run).drop("run"))
    old, new = _run(raw, "v1", epochs("v1")), _run(raw.withColumn("payload", payload), "v2", epochs("v2"))
    return cutover.compare_runs(old, new, ["source_id"], ["received_time_ns", "record_id"], ["record_id"])
