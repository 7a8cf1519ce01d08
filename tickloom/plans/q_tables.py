"""Queries of sources, sinks and streams. What they write goes to the session's shared folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators import books, quality, venues
from tickloom.operators import normalize as N
from tickloom.plans import views as V
from tickloom.plans.q_normalize import BROKEN
from tickloom.plans.q_quality import DEADLINE_SQL
from tickloom.plans.registry import query
from tickloom.sources import tables
from tickloom.streaming import jobs, keyed

C, L = F.col, F.lit
WIDE = ("price", "amount", "bid_price", "ask_price", "mark_price", "index_price", "open_interest")
BY = list(tables.PARTITION)


def _raw(spark, d):
    payload = C("payload").cast("binary")
    sha = F.when(C("native_trade_id") % 31 == 0, "x").otherwise(F.sha2(payload, 256))
    rows = V.raw_json(spark, d).withColumn("arrival_ordinal", C("native_trade_id") + 1).withColumns({"payload": payload, "payload_sha256": sha, "epoch_kind": L("connection")})
    return rows.select(*(f.name for f in tables.RAW_SCHEMA.fields))


@query("SELECT source_id, native_trade_id + 1 AS arrival_ordinal FROM raw_json WHERE native_trade_id % 31 <> 0", ["raw_json"])
def s1_read_raw(spark, d):
    folder = tables.shared_folder(spark)
    _raw(spark, d).write.parquet(folder)
    return tables.read_raw(spark, folder).select("source_id", "arrival_ordinal")


@query("SELECT source_id, count(*) AS n FROM raw_json WHERE native_trade_id % 31 <> 0 GROUP BY 1", ["raw_json"])
def s2_stream_raw(spark, d):
    folder = tables.shared_folder(spark)
    _raw(spark, d).repartition(4).write.parquet(f"{folder}/in")
    stream = jobs.stream_files(spark, f"{folder}/in", tables.RAW_SCHEMA, 1).where(tables.raw_faults().isNull())
    return jobs.drain(stream.select("source_id"), folder).groupBy("source_id").agg(F.count("*").alias("n"))


def _one_venue(spark, d):
    return V.arrivals(spark, d).withColumn("source_id", L("venue"))


def _written(spark, d):
    folder = tables.shared_folder(spark)
    tables.write_partitions(_one_venue(spark, d), "trade", folder)
    return folder


@query("SELECT native_trade_id, 'venue' AS source_id, received_time_ns, CAST(price AS VARCHAR) AS price, epoch_id AS date, (received_time_ns // 3600000000000 % 24)::INTEGER AS hour FROM trades", ["trades"])
def s3_read_family(spark, d):
    rows = tables.read_family(spark, _written(spark, d))
    return rows.select("native_trade_id", "source_id", "received_time_ns", C("price").cast("string").alias("price"), C("date").cast("string").alias("date"), C("hour").cast("int").alias("hour"))


@query("SELECT native_trade_id FROM trades WHERE received_time_ns // 3600000000000 % 24 < 12", ["trades"])
def s4_read_committed(spark, d):
    """Written files, and a written table of manifests; the scan reads committed partitions only."""
    folder, listed = _written(spark, d), tables.shared_folder(spark)
    known = tables.read_family(spark, folder).select(*BY).distinct()
    known.withColumn("state", F.when(C("hour") < 12, "committed").otherwise("open")).write.parquet(listed)
    return tables.read_committed(spark, folder, spark.read.parquet(listed)).select("native_trade_id")


@query()
def s5_write_partitions(spark, d):
    rows = tables.read_family(spark, _written(spark, d)).withColumn("file", F.input_file_name())
    return rows.groupBy("source_id", "date", "hour").agg(F.count("*").alias("rows"), F.count_distinct("file").alias("files"))


def _events(spark, d):
    level = F.struct("side", "price", "amount")
    pick = lambda s: F.transform(F.array_sort(F.collect_list(F.when(C("side") == s, F.struct("level_ordinal", level.alias("l"))))), lambda x: x["l"])
    return V.book_levels(spark, d).groupBy("instrument_uid", "event_id").agg(pick("buy").alias("bids"), pick("sell").alias("asks"))


_LEVELS = """SELECT event_id, (row_number() OVER (PARTITION BY event_id ORDER BY side, level_ordinal) - 1)::INTEGER AS ordinal, side, CAST(price AS VARCHAR) AS price FROM book_levels"""


@query(_LEVELS, ["book_levels"])
def s6_book_to_levels(spark, d):
    return books.levels_of_events(_events(spark, d)).select("event_id", "ordinal", "side", C("price").cast("string").alias("price"))


@query("SELECT event_id, count(*)::INTEGER AS levels, event_id % 7 <> 0 OR count(*) = 1 AS consistent FROM book_levels GROUP BY 1", ["book_levels"])
def s7_levels_to_book(spark, d):
    rows = books.levels_of_events(_events(spark, d))
    twisted = F.when((C("event_id") % 7 == 0) & (C("ordinal") > 0), "other").otherwise(C("instrument_uid"))
    rows = rows.withColumn("instrument_uid", twisted)
    return books.events_of_levels(rows, ["event_id"], ["instrument_uid"]).select("event_id", F.size("levels").alias("levels"), "consistent")


@query(
    """SELECT source_id, epoch_id AS date, (received_time_ns // 3600000000000 % 24)::INTEGER AS hour, count(*) AS rows, min(received_time_ns) AS first_ns, max(received_time_ns) AS last_ns,
    count(DISTINCT epoch_id) AS epochs FROM arrivals GROUP BY ALL""",
    ["arrivals"],
)
def s8_manifests(spark, d):
    return tables.manifests(V.arrivals(spark, d), "trade").select("source_id", "date", "hour", "rows", "first_ns", "last_ns", "epochs")


@query(
    """SELECT source_id, epoch_id AS date, (received_time_ns // 3600000000000 % 24)::INTEGER AS hour, CASE WHEN count(*) = 1 THEN 'absent' ELSE 'rows' END AS fault FROM trades
    WHERE (source_id, epoch_id, received_time_ns // 3600000000000 % 24) IN (SELECT (source_id, epoch_id, received_time_ns // 3600000000000 % 24) FROM trades WHERE native_trade_id % 997 = 0) GROUP BY ALL""",
    ["trades"],
)
def s9_verify_manifests(spark, d):
    rows = V.arrivals(spark, d)
    expected = tables.manifests(rows, "trade")
    return tables.verify_manifests(rows.where("native_trade_id % 997 <> 0"), "trade", expected).select("source_id", "date", "hour", "fault")


@query("SELECT unnest(['refused', 'loaded', 'already_loaded']) AS outcome, count(*) AS rows FROM trades GROUP BY 1", ["trades"])
def s10_load_generation(spark, d):
    rows, root = V.trades(spark, d), tables.shared_folder(spark)
    ids = rows.select("native_trade_id")
    seen = [tables.load_generation(r, ids, root, "g1") for r in (rows.where("native_trade_id % 2 = 0"), rows, rows)]
    loaded = spark.read.parquet(tables.generation_path(root, "g1"))
    return loaded.agg(F.count("*").alias("rows")).select(F.explode(F.array(*map(L, seen))).alias("outcome"), "rows")


@query("SELECT * FROM (VALUES ('absent'), ('different'), ('exact')) v(state), (SELECT count(*) AS rows FROM trades)", ["trades"])
def s11_reconcile(spark, d):
    rows, root = V.trades(spark, d), tables.shared_folder(spark)
    ids = rows.select("native_trade_id")
    seen = [tables.reconcile_generation(spark, ids, root, "g1", "native_trade_id")]
    for part in (rows.where("native_trade_id % 2 = 0"), rows):
        part.write.mode("overwrite").parquet(tables.generation_path(root, "g1"))
        seen.append(tables.reconcile_generation(spark, ids, root, "g1", "native_trade_id"))
    loaded = spark.read.parquet(tables.generation_path(root, "g1"))
    return loaded.agg(F.count("*").alias("rows")).select(F.explode(F.array(*map(L, seen))).alias("state"), "rows")


@query(
    """SELECT 'venue' AS source_id, epoch_id AS date, (received_time_ns // 3600000000000 % 24)::INTEGER AS hour, NOT bool_or(epoch_id = '2024-01-05' AND native_trade_id % 2 = 0) AS same FROM trades GROUP BY ALL""",
    ["trades"],
)
def s12_rebuild_partition(spark, d):
    rows = _one_venue(spark, d)
    folder = _written(spark, d)
    new = rows.where("epoch_id = '2024-01-05'").withColumn("price", (C("price") + F.when(C("native_trade_id") % 2 == 0, 1).otherwise(0)).cast("decimal(38,18)"))
    out = tables.rebuild_partition(new, "trade", folder)
    return out.select("source_id", C("date").cast("string").alias("date"), C("hour").cast("int").alias("hour"), "same")


@query("SELECT native_trade_id, 'trade' AS family, substr(epoch_id, 1, 7) AS month, CAST(price AS VARCHAR) AS price, NULL::VARCHAR AS mark_price FROM trades", ["trades"])
def s13_flatten(spark, d):
    rows = V.trades(spark, d)
    wide = tables.flatten(rows, "trade", ["price", "amount"], WIDE)
    ids = rows.select(tables.row_id(C("native_trade_id"), L(0)).alias("row_id"), "native_trade_id")
    return wide.join(ids, "row_id").select("native_trade_id", "family", "month", C("price").cast("string").alias("price"), C("mark_price").cast("string").alias("mark_price"))


@query("SELECT utc_date, count(*) AS n FROM opportunities WHERE outcome IS NOT NULL AND utc_date = '1996-03-04' GROUP BY 1", ["opportunities"])
def s14_archive(spark, d):
    return tables.archive(V.opportunities(spark, d), "1996-03-04")[1].select("utc_date", "n")


def _one_batch(spark, rows, *order):
    """The rows as a stream of one batch, so that none is late, in as many files as a shuffle has tasks."""
    folder = tables.shared_folder(spark)
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartitionByRange(files, *order).write.parquet(f"{folder}/in")
    return folder, jobs.stream_files(spark, f"{folder}/in", rows.schema, files)


#: Rows of one micro-batch of a stream whose state takes the rows of a key in memory.
BATCH_ROWS = 1_000_000


def _in_turn(spark, rows, key, time):
    """The rows as a stream of batches of about BATCH_ROWS, in order of time.

    Each slice of time is written after the one before, so its files are younger, and a key's rows of a slice lie in one file:
    wherever a batch ends, a key's later rows come later. A slice has fewer files than a shuffle has tasks where keys are few,
    so files are counted: a batch of as many files as a shuffle has tasks would be several slices.
    """
    folder = tables.shared_folder(spark)
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.parquet(f"{folder}/all")
    held = spark.read.schema(rows.schema).parquet(f"{folder}/all")
    slices = max(1, -(-held.count() // BATCH_ROWS))
    shares = [n / slices for n in range(1, slices)]
    edges = sorted({int(e) for e in held.approxQuantile(time, shares, 0.1 / slices)}) if shares else []
    number = reduce(lambda n, e: n + F.when(C(time) >= e, 1).otherwise(0), edges, L(0))
    held.withColumn("__slice", number).write.partitionBy("__slice").parquet(f"{folder}/cut")  # each slice is read alone
    for n in range(len(edges) + 1):
        some = spark.read.parquet(f"{folder}/cut").where(C("__slice") == n).select(*rows.columns)
        some.repartition(files, key).write.mode("append").parquet(f"{folder}/in")
    written = len(spark.read.schema(rows.schema).parquet(f"{folder}/in").inputFiles())
    return folder, jobs.stream_files(spark, f"{folder}/in", rows.schema, max(1, round(written / (len(edges) + 1))))


def _trade_stream(spark, d):
    return _one_batch(spark, V.trades(spark, d), "received_time_ns")


@query(
    "SELECT received_time_ns // 3600000000000 AS hour, count(*) AS n FROM trades WHERE (received_time_ns // 3600000000000 + 1) * 3600000000000 <= (SELECT max(received_time_ns) FROM trades) GROUP BY 1",
    ["trades"],
)
def s15_stream_to_partitions(spark, d):
    folder, stream = _trade_stream(spark, d)
    jobs.hour_files(stream, f"{folder}/staging", f"{folder}/published", "received_time_ns", f"{folder}/state")
    rows = spark.read.parquet(f"{folder}/published")
    return rows.groupBy(C("hour").cast("long").alias("hour")).agg(F.count("*").alias("n"))


@query("SELECT channel_id, received_time_ns // 3600000000000 AS hour, count(*) AS n FROM trades WHERE (received_time_ns // 3600000000000 + 1) * 3600000000000 <= (SELECT max(received_time_ns) FROM trades) GROUP BY ALL", ["trades"])
def r13_stream_closed_hours(spark, d):
    folder, stream = _trade_stream(spark, d)
    return jobs.drain(jobs.closed_hours(stream, "received_time_ns", "channel_id"), folder)


@query(
    f"""SELECT request_id, outcome FROM ({DEADLINE_SQL}) JOIN trades ON native_trade_id = request_id WHERE outcome = 'acknowledged'
    OR (SELECT max(received_time_ns) // 1000000 - 1 FROM trades WHERE channel_id IN ('click', 'view')) >= (received_time_ns + 21600000000000) // 1000000 + 1""",
    ["trades"],
)
def r17_stream_deadlines(spark, d):
    """Both outcomes of each request whose answer came or whose deadline the watermark has passed."""
    folder, stream = _trade_stream(spark, d)
    request = F.when(C("channel_id") == "click", C("native_trade_id"))
    rows = stream.where("channel_id IN ('click', 'view')").select("instrument_uid", C("received_time_ns").alias("at_ns"), request.alias("request_id"))
    return keyed.drained(keyed.deadlines(rows, ["instrument_uid"], 21_600_000_000_000), folder)


@query(
    """SELECT native_trade_id, now_mark, refused FROM (SELECT native_trade_id, refused, CASE WHEN refused IS NULL THEN list_last(list_filter(list(x) OVER v, lambda y: y.h)).v END AS now_mark
    FROM (SELECT *, count_if(fresh AND refused IS NULL) OVER w AS part FROM (SELECT *, CASE WHEN seeds = 0 THEN 'unseeded' WHEN exchange_time_ns < max(CASE WHEN seeds > 0 THEN exchange_time_ns END)
    OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 'time_regressed' END AS refused FROM (SELECT *, channel_id = 'signup' AS fresh, count_if(channel_id = 'signup') OVER w AS seeds,
    {'h': refused_h, 'v': CASE WHEN channel_id = 'click' THEN '' WHEN channel_id <> 'view' THEN native_trade_id::VARCHAR END} AS x FROM (SELECT *, channel_id IN ('signup', 'view', 'click') AS refused_h FROM trades)
    WINDOW w AS (PARTITION BY instrument_uid, epoch_id ORDER BY received_time_ns, native_trade_id)) WINDOW w AS (PARTITION BY instrument_uid, epoch_id ORDER BY received_time_ns, native_trade_id))
    WINDOW w AS (PARTITION BY instrument_uid, epoch_id ORDER BY received_time_ns, native_trade_id)) WINDOW v AS (PARTITION BY instrument_uid, epoch_id, part, refused IS NULL ORDER BY received_time_ns, native_trade_id))""",
    ["trades"],
)
def r10_stream_ticker(spark, d):
    """Fields in force, cleared by each new connection; unseeded and regressing messages are refused."""
    folder, stream = _trade_stream(spark, d)
    k = C("channel_id")
    rows = stream.withColumns(
        {
            "kind": F.when(k == "signup", "snapshot").otherwise("delta"),
            "has_mark": k.isin("signup", "view", "click"),
            "mark": F.when(k == "click", "").when(k != "view", C("native_trade_id").cast("string")),
        }
    )
    found = keyed.ticker(rows, ["instrument_uid"], ["received_time_ns", "native_trade_id"], "exchange_time_ns", ["mark"], ["native_trade_id"])
    return keyed.drained(found, folder).select("native_trade_id", "now_mark", "refused")


LEDGER_SQL = """SELECT gap_id, resolved_ns, state FROM (SELECT *, lead(CASE WHEN kind <> 'gap' THEN at_ns END IGNORE NULLS) OVER w AS resolved_ns, coalesce(lead(CASE WHEN kind <> 'gap' THEN kind END IGNORE NULLS) OVER w, 'open') AS state,
    lag(kind, 1, 'recovered') OVER w AS before FROM (SELECT source_id, channel_id, instrument_uid, native_trade_id, received_time_ns AS at_ns, CASE WHEN native_trade_id % 7 < 4 THEN 'gap' WHEN native_trade_id % 7 < 6 THEN 'recovered' ELSE 'permanent' END AS kind,
    CASE WHEN native_trade_id % 7 < 4 THEN lpad(native_trade_id::VARCHAR, 12, '0') END AS gap_id FROM trades) WINDOW w AS (PARTITION BY source_id, channel_id, instrument_uid ORDER BY at_ns, kind <> 'gap', gap_id)) WHERE kind = 'gap' AND before <> 'gap'"""


def _ledger_events(rows):
    n = C("native_trade_id") % 7
    kind = F.when(n < 4, "gap").when(n < 6, "recovered").otherwise("permanent")
    gap = lambda c: F.when(n < 4, c)
    at = C("received_time_ns")
    return rows.select("source_id", "channel_id", "instrument_uid", at.alias("at_ns"), kind.alias("kind"), gap(F.lpad(C("native_trade_id").cast("string"), 12, "0")).alias("gap_id"), gap(at - 1).alias("start_ns"), gap(at).alias("end_ns"))


TUPLE = ["source_id", "channel_id", "instrument_uid"]


@query(LEDGER_SQL, ["trades"])
def r12_gap_lifecycle(spark, d):
    """One open gap a tuple, ended once, as recovered or permanent."""
    return quality.gap_lifecycle(_ledger_events(V.trades(spark, d)), TUPLE).select("gap_id", "resolved_ns", "state")


@query(f"SELECT gap_id, NULL::BIGINT AS resolved_ns, 'open' AS state FROM ({LEDGER_SQL}) UNION ALL SELECT gap_id, resolved_ns, state FROM ({LEDGER_SQL}) WHERE resolved_ns IS NOT NULL", ["trades"])
def r12_stream_ledger(spark, d):
    """Each change of a gap's state: opened, and ended if it was."""
    folder, stream = _trade_stream(spark, d)
    return keyed.drained(keyed.gap_ledger(_ledger_events(stream), TUPLE), folder).select("gap_id", "resolved_ns", "state")


SILENT_SQL = """SELECT channel_id, instrument_uid, from_ns FROM (SELECT DISTINCT channel_id, instrument_uid, received_time_ns AS from_ns, coalesce(lead(received_time_ns) OVER (PARTITION BY channel_id, instrument_uid ORDER BY received_time_ns),
    (SELECT max(received_time_ns) FROM trades)) AS upto FROM trades) WHERE upto - from_ns > 864000000000000"""


@query(SILENT_SQL, ["trades"])
def r16_silent_since(spark, d):
    return quality.silent_since(V.trades(spark, d), ["channel_id", "instrument_uid"], "received_time_ns", 864_000_000_000_000)


@query(SILENT_SQL, ["trades"])
def r16_stream_silences(spark, d):
    """As r16_silent_since: told by a timer, or by the row that ends the silence."""
    folder, stream = _trade_stream(spark, d)
    return keyed.drained(keyed.silences(stream, ["channel_id", "instrument_uid"], "received_time_ns", 864_000_000_000_000), folder)


@query(
    """SELECT instrument_uid, count(*) AS books, max(last_sequence) AS last_sequence FROM book_events GROUP BY 1""",
    ["book_events"],
)
def r1_stream_engine(spark, d):
    """The sequential engine as a stream over mapped events: one book after each, for one connection an instrument."""
    first = Window.partitionBy("instrument_uid").orderBy("received_time_ns", "event_id")
    level = F.struct("side", "price", "amount")
    events = V.book_events(spark, d, F.array_sort(F.collect_list(F.struct("level_ordinal", level.alias("l")))).alias("x"))
    events = events.withColumn("levels", C("x.l")).drop("x")
    events = events.withColumns({"epoch_id": L("c1"), "update_kind": F.when(F.row_number().over(first) == 1, "snapshot").otherwise("delta")})
    folder, stream = _in_turn(spark, events, "instrument_uid", "received_time_ns")
    # batches may share a slice of time, so no row is late
    out = keyed.drained(keyed.sequential_books(stream, "bridge", False, idle_ns=10**18, late="36500 days"), folder).where("kind = 'book'")
    return out.groupBy("instrument_uid").agg(F.count("*").alias("books"), F.max("last_sequence").alias("last_sequence"))


@query("SELECT native_trade_id, CASE WHEN received_time_ns < 1705276800000000000 THEN 'v1' ELSE 'v2' END AS mapper_version FROM trades", ["trades"])
def r19_stream_cutover(spark, d):
    folder, stream = _trade_stream(spark, d)
    return jobs.drain(jobs.cutover(stream, V.bindings(spark, d)).select("native_trade_id", "mapper_version"), folder)


def _mappers():
    """Two versions of the trade mapping, for the channels that have one; they read alike."""
    registry = N.Registry()
    keep = ["record_id", "source_id", "channel_id", "epoch_id", "received_time_ns"]
    for source in ("S0", "S1", "S2"):
        for channel in ("click", "view"):
            for version in ("v1", "v2"):
                registry.register(source, channel, version, lambda raw, v=version: _with_version(N.split(N.apply(raw, venues.SPOT["trade"], keep=keep)), v))
    return registry


def _with_version(parts, version):
    rows, bad = parts
    names = {"symbol": "instrument_uid"}
    return rows.withColumnsRenamed(names).withColumn("mapper_version", L(version)), bad.select("record_id", "code")


def _raw_records(spark, d):
    return V.raw_json(spark, d).withColumnRenamed("native_trade_id", "record_id")


@query(
    f"""WITH r AS (SELECT *, channel_id NOT IN ('click', 'view') AS unbound, {BROKEN} AS bad FROM trades) SELECT source_id, epoch_id AS date, (received_time_ns // 3600000000000 % 24)::INTEGER AS hour,
    count(*) AS rows, count(DISTINCT CASE WHEN received_time_ns < 1705276800000000000 THEN 'v1' ELSE 'v2' END) AS versions, 'committed' AS state, (SELECT count_if(unbound OR bad) FROM r) AS quarantined FROM r WHERE NOT unbound AND NOT bad GROUP BY ALL""",
    ["trades"],
)
def s16_export(spark, d):
    """Raw messages to verified partitions: bindings, mapping, accounting, files, manifests."""
    made = tables.export(_raw_records(spark, d), V.bindings(spark, d), _mappers(), "trade", tables.shared_folder(spark))
    versions = made["rows"].groupBy("source_id", C("date").cast("string").alias("date"), "hour").agg(F.count_distinct("mapper_version").alias("versions"))
    refused = made["quarantine"].agg(F.count("*").alias("quarantined"))
    rows = made["manifests"].select("source_id", "date", C("hour").cast("int").alias("hour"), "rows", "state").join(versions, ["source_id", "date", "hour"])
    return rows.join(F.broadcast(refused), F.lit(True))


@query(
    """SELECT source_id, count(*) AS partitions, sum(n)::BIGINT AS rows, sum(n)::BIGINT AS loaded FROM (SELECT 'venue' AS source_id, epoch_id, received_time_ns // 3600000000000 % 24 AS hour, count(*) AS n FROM trades GROUP BY ALL) GROUP BY 1""",
    ["trades"],
)
def s5_ingest(spark, d):
    """Partitions, their manifests and the load of a generation, one after the other: the path of an ingest."""
    rows, folder, root = _one_venue(spark, d), tables.shared_folder(spark), tables.shared_folder(spark)
    tables.write_partitions(rows, "trade", folder)
    written = tables.read_family(spark, folder)
    listed = tables.manifests(written.drop("family", "date", "hour"), "trade")
    tables.load_generation(written, written.select("native_trade_id"), root, "g1")
    loaded = spark.read.parquet(tables.generation_path(root, "g1")).agg(F.count("*").alias("loaded"))
    return listed.groupBy("source_id").agg(F.count("*").alias("partitions"), F.sum("rows").alias("rows")).join(F.broadcast(loaded), F.lit(True))


@query()
def q2_spill_run(spark, d):
    """Terminal rows of the first date are archived once; what is archived leaves the current ledger."""
    ledger, root = V.opportunities(spark, d), tables.shared_folder(spark)
    first = ledger.where("outcome IS NOT NULL").agg(F.min("utc_date")).first()[0] or ""
    rows, commit = tables.archive(ledger, first)
    for _ in range(2):  # a second run after an unknown outcome changes nothing
        tables.load_generation(rows, rows, root, first, "opportunity_id")
    archived = spark.read.parquet(tables.generation_path(root, first))
    left = ledger.join(archived, "opportunity_id", "left_anti").groupBy("scope").agg(F.count("*").alias("n"))
    return left.crossJoin(F.broadcast(commit.select(C("n").alias("archived"))))


@query()
def q7_quality_rows(spark, d):
    rows = V.gaps(spark, d).select(L("venue").alias("source_id"), "channel_id", "instrument_uid", C("start_ns").alias("received_time_ns"), "gap_id", L("gap").alias("kind"))
    folder = tables.shared_folder(spark)
    tables.write_partitions(rows.withColumn("epoch_id", L("-")), "quality", folder, ["instrument_uid", "received_time_ns", "gap_id"])
    return tables.read_family(spark, folder).groupBy("source_id", "date").agg(F.count("*").alias("n"))


@query(
    """SELECT instrument_uid, count(*) FILTER (side = 'buy') AS bids, count(*) FILTER (side = 'sell') AS asks FROM
    (SELECT instrument_uid, side, price, arg_max(action, (received_time_ns, event_id, level_ordinal)) AS act FROM book_levels GROUP BY ALL HAVING act <> 'delete') GROUP BY 1""",
    ["book_levels"],
)
def r1_stream_books(spark, d):
    folder, stream = _one_batch(spark, V.book_levels(spark, d), "received_time_ns", "event_id")
    return jobs.books(stream, folder).groupBy("instrument_uid").agg(F.max_by(F.struct("bids", "asks"), F.struct("received_time_ns", "event_id")).alias("b")).select("instrument_uid", "b.*")
