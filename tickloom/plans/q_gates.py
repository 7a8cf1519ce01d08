"""Queries of telemetry, rebuild evidence, load gates, declarations and archives."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import books, gates, sets, venues
from tickloom.operators import normalize as N
from tickloom.operators.digests import digest_sql
from tickloom.plans import messages as G
from tickloom.plans import views as V
from tickloom.plans.q_filters import _TRADE_COLUMNS, _hash_sql
from tickloom.plans.registry import query
from tickloom.sources import tables

C, L = F.col, F.lit
MIDDLE = 1_705_276_800_000_000_000


@query(
    """SELECT channel_id || CASE WHEN channel_id IN ('click', 'view') THEN '' ELSE s END AS name, CAST(CASE WHEN channel_id IN ('click', 'view') THEN sum(amount) WHEN s = '_count' THEN sum(native_trade_id % 5)::DECIMAL(38,18)
    ELSE sum(price) END AS VARCHAR) AS value FROM trades, (VALUES ('_count'), ('_sum')) t(s) WHERE channel_id NOT IN ('click', 'view') OR s = '_sum' GROUP BY channel_id, s""",
    ["trades"],
)
def g8_rollup(spark, d):
    """Counters and gauges by their sum, histograms by count and sum, over the label sets of each name."""
    kind = F.when(C("channel_id") == "click", "counter").when(C("channel_id") == "view", "gauge").otherwise("histogram")
    samples = V.trades(spark, d).select(C("channel_id").alias("name"), kind.alias("type"), C("amount").alias("value"), (C("native_trade_id") % 5).alias("observations"), C("price").alias("total"))
    return gates.telemetry(samples).select("name", C("value").cast("string").alias("value"))


_DATASET = {"load_generation_id": "g1", "family": "trade", "catalog_snapshot_id": "c1", "schema_name": "trade", "schema_version": "1"}
_KEYS = ", ".join([*(f"'{v}' AS {k}" for k, v in _DATASET.items()), "source_id", "channel_id", "instrument_uid"])


def _dataset(rows):
    return rows.withColumns({k: L(v) for k, v in _DATASET.items()})


_WHERE = "source_id || '/' || channel_id || '/' || instrument_uid"


@query(
    f"""SELECT {_KEYS}, n, first_ns, last_ns, n_price, sum_price, n_amount, sum_amount, n_bid_price, digest FROM (SELECT source_id, channel_id, instrument_uid, {_WHERE} AS grp, count(*) AS n, min(received_time_ns) AS first_ns,
    max(received_time_ns) AS last_ns, count(price) AS n_price, CAST(sum(price) AS VARCHAR) AS sum_price, count(amount) AS n_amount, CAST(sum(amount) AS VARCHAR) AS sum_amount, 0 AS n_bid_price FROM trades GROUP BY ALL)
    JOIN (SELECT grp, digest FROM ({digest_sql(f"SELECT {_WHERE} AS grp, {_hash_sql([c for c in _TRADE_COLUMNS if c not in ('source_id', 'channel_id', 'instrument_uid')])} AS h FROM trades", "grp")})) USING (grp)""",
    ["trades"],
)
def g10_rebuild_evidence(spark, d):
    """Eight keys, all decimals of any family, and a digest of the rows."""
    rows = gates.rebuild_evidence(_dataset(V.trades(spark, d)))
    names = ("n", "first_ns", "last_ns", "n_price", "sum_price", "n_amount", "sum_amount", "digest")
    return rows.select(*gates.REBUILD_KEYS, *names, C("n_bid_price").cast("int").alias("n_bid_price"))


@query(
    """SELECT source_id, channel_id, instrument_uid, CASE WHEN bool_or(native_trade_id % 97 = 0) THEN CASE WHEN bool_and(native_trade_id % 97 = 0) THEN 'absent' ELSE 'n' END ELSE 'n_price' END AS fault FROM trades GROUP BY ALL
    HAVING bool_or(native_trade_id % 97 = 0) OR bool_or(native_trade_id % 101 = 0 AND price IS NOT NULL)""",
    ["trades"],
)
def g10_rebuild_faults(spark, d):
    """A rebuild that lost some rows and some prices."""
    rows = _dataset(V.trades(spark, d))
    price = F.when(C("native_trade_id") % 101 != 0, C("price"))
    found = gates.rebuild_faults(rows, rows.where("native_trade_id % 97 <> 0").withColumn("price", price))
    return found.select("source_id", "channel_id", "instrument_uid", "fault")


@query(
    """SELECT channel_id, received_time_ns // 3600000000000 AS hour, count(*) AS messages, sum(strlen(payload))::BIGINT AS bytes, (sum(strlen(payload)) * 1000 // 3600)::BIGINT AS millibytes_per_s FROM raw_json GROUP BY ALL""",
    ["raw_json"],
)
def g20_byte_rates(spark, d):
    rows = V.raw_json(spark, d).groupBy("channel_id", F.expr("received_time_ns div 3600000000000").alias("hour"))
    size = F.sum(F.octet_length("payload"))
    return rows.agg(F.count("*").alias("messages"), size.alias("bytes"), F.call_function("div", size * 1000, L(3600)).alias("millibytes_per_s"))


@query(
    """SELECT source_id, n AS records, bytes, seconds, n * 1000000 // seconds AS records_per_ms, expected - n AS loss FROM (SELECT source_id, count(*) AS n, sum(strlen(payload))::BIGINT AS bytes,
    (max(received_time_ns) - min(received_time_ns)) // 1000000000 AS seconds FROM raw_json WHERE native_trade_id % 17 <> 0 GROUP BY 1) JOIN (SELECT source_id, sum(e)::BIGINT AS expected FROM
    (SELECT source_id, max(arrival_ordinal) AS e FROM arrivals_gapped GROUP BY source_id, epoch_id) GROUP BY 1) USING (source_id)""",
    ["raw_json", "arrivals_gapped"],
)
def g13_run_throughput(spark, d):
    """Rates of a run with lost records; how many were expected is told by the last ordinal of each epoch."""
    raw = V.raw_json(spark, d).where("native_trade_id % 17 <> 0")
    last = V.arrivals_gapped(spark, d).groupBy("source_id", "epoch_id").agg(F.max("arrival_ordinal").alias("e"))
    expected = last.groupBy("source_id").agg(F.sum("e").alias("expected"))
    seconds = F.expr("(max(received_time_ns) - min(received_time_ns)) div 1000000000")
    rows = raw.groupBy("source_id").agg(F.count("*").alias("records"), F.sum(F.octet_length("payload")).alias("bytes"), seconds.alias("seconds")).join(expected, "source_id")
    return rows.select("source_id", "records", "bytes", "seconds", F.call_function("div", C("records") * 1_000_000, C("seconds")).alias("records_per_ms"), (C("expected") - C("records")).alias("loss"))


@query(
    f"""WITH r AS (SELECT source_id, received_time_ns AS t, strlen(payload) AS b, native_trade_id AS id FROM raw_json), o AS (SELECT source_id, max(n) AS pm, max(b) AS pb FROM (SELECT source_id, t // 1000000000 AS s, count(*) AS n, sum(b) AS b
    FROM r WHERE t < {MIDDLE} GROUP BY ALL) GROUP BY 1), x AS (SELECT *, ((t - {MIDDLE}) * CASE WHEN source_id = 'S0' THEN 1 ELSE 10 END) // 10000 AS q FROM r WHERE t >= {MIDDLE} AND NOT (source_id = 'S2' AND id % 50 = 0)),
    w AS (SELECT source_id, count(*) AS n, sum(b) AS b, max(q) - min(q) AS ns FROM x GROUP BY 1), u AS (SELECT source_id, max(n) AS bm, max(b) AS bb FROM (SELECT source_id, q // 30000000000 AS s, count(*) AS n, sum(b) AS b FROM x GROUP BY ALL) GROUP BY 1),
    e AS (SELECT source_id, count(*) AS e FROM r WHERE t >= {MIDDLE} GROUP BY 1), c AS (SELECT source_id, ns >= 3600000000000 AS duration, n::HUGEINT * 1000000000 >= pm::HUGEINT * 2 * ns AND b::HUGEINT * 1000000000 >= pb::HUGEINT * 2 * ns AS sustained,
    bm >= pm * 150 AND bb >= pb * 150 AS burst, n = e AS accounted FROM o JOIN w USING (source_id) JOIN u USING (source_id) JOIN e USING (source_id))
    SELECT *, CASE WHEN duration AND sustained AND burst AND accounted THEN 'pass' ELSE 'fail' END AS verdict FROM c""",
    ["raw_json"],
)
def q9_load_gate(spark, d):
    """The second half of the month, replayed at speed, against the first; one source loses records in the replay."""
    raw = V.raw_json(spark, d)
    late = raw.where(C("received_time_ns") >= MIDDLE)
    faster = F.when(C("source_id") == "S0", 1).otherwise(10)
    at = F.call_function("div", (C("received_time_ns") - MIDDLE) * faster, L(10_000))
    run = late.where("NOT (source_id = 'S2' AND native_trade_id % 50 = 0)").withColumn("received_time_ns", at)
    expected = late.groupBy("source_id").agg(F.count("*").alias("expected"))
    return gates.load_gate(raw.where(C("received_time_ns") < MIDDLE), run, ["source_id"], "received_time_ns", F.octet_length("payload"), expected)


LEGAL = {"F": ["F", "O"], "O": ["F", "P"], "P": ["O"]}
_DECLARED = "SELECT 'K' || (o_custkey % 300) AS source_id, epoch_us(o_orderdate) * 1000 AS start_ns, epoch_us(o_orderdate) * 1000 + (o_orderkey % 90 - 3) * 86400000000000 AS end_ns, o_orderstatus AS state FROM orders"


@query(
    f"""WITH d AS ({_DECLARED} UNION ALL SELECT * FROM ({_DECLARED} WHERE o_orderkey % 400 = 0)), o AS (SELECT DISTINCT * FROM d), w AS (SELECT *, lead(start_ns) OVER (PARTITION BY source_id ORDER BY start_ns, end_ns NULLS LAST) AS nx,
    lag(state) OVER (PARTITION BY source_id ORDER BY start_ns, end_ns, state) AS p FROM o)
    SELECT source_id, 'repeated' AS fault, count(*) AS n FROM (SELECT source_id FROM d GROUP BY source_id, start_ns, end_ns, state HAVING count(*) > 1) GROUP BY 1
    UNION ALL SELECT source_id, 'overlapping', count(*) FROM w WHERE nx < end_ns GROUP BY 1 UNION ALL SELECT source_id, 'inverted', count(*) FROM o WHERE end_ns <= start_ns GROUP BY 1
    UNION ALL SELECT source_id, 'illegal_transition', count(*) FROM w WHERE CASE WHEN p IS NULL THEN state <> 'F' ELSE p || state NOT IN ('FF', 'FO', 'OF', 'OP', 'PO') END GROUP BY 1"""
)
def q8_declaration_faults(spark, d):
    day = 86_400_000_000_000
    rows = V.load(spark, d, "orders").withColumn("start_ns", V.ns_of("o_orderdate"))
    rows = rows.select(F.concat(L("K"), C("o_custkey") % 300).alias("source_id"), "start_ns", (C("start_ns") + (C("o_orderkey") % 90 - 3) * day).alias("end_ns"), C("o_orderstatus").alias("state"), "o_orderkey")
    declared = rows.unionByName(rows.where("o_orderkey % 400 = 0")).drop("o_orderkey")
    return gates.declaration_faults(declared, "source_id", "start_ns", "end_ns", "state", LEGAL, "F")


@query(
    """SELECT utc_date, CASE WHEN utc_date LIKE '%-07' OR bool_and(opportunity_id % 811 = 0) THEN 'absent' WHEN bool_or(opportunity_id % 811 = 0) THEN 'n' WHEN bool_or(opportunity_id % 499 = 0) THEN 'digest' END AS fault FROM opportunities
    WHERE outcome IS NOT NULL GROUP BY 1 HAVING utc_date LIKE '%-07' OR bool_or(opportunity_id % 811 = 0 OR opportunity_id % 499 = 0)""",
    ["opportunities"],
)
def s14_archive_verified(spark, d):
    """All dates archived with their commits, then verified after rows were lost, a day deleted and outcomes changed."""
    root = tables.shared_folder(spark)
    ledger = V.opportunities(spark, d).where("outcome IS NOT NULL")
    month = ledger.withColumn("month", F.substring("utc_date", 1, 7)).repartition("month")
    month.write.partitionBy("month").parquet(f"{root}/rows")
    gates.archive_commits(ledger).write.parquet(f"{root}/commits")
    rows = spark.read.parquet(f"{root}/rows").select(*ledger.columns)
    outcome = F.when(C("opportunity_id") % 499 == 0, "altered").otherwise(C("outcome"))
    rows = rows.where("opportunity_id % 811 <> 0 AND utc_date NOT LIKE '%-07'").withColumn("outcome", outcome)
    return gates.archive_faults(rows, spark.read.parquet(f"{root}/commits"), "expected_ns")


@query(
    """SELECT source_id, epoch_id, arrival_ordinal, kind, row_number() OVER (PARTITION BY source_id ORDER BY epoch_id, arrival_ordinal, kind DESC) AS place FROM (SELECT source_id, epoch_id, arrival_ordinal, 'record' AS kind FROM arrivals
    UNION ALL SELECT source_id, epoch_id, arrival_ordinal, 'disconnect' FROM arrivals WHERE channel_id = 'error')""",
    ["arrivals"],
)
def w5_interleaved(spark, d):
    """A disconnect marker right after each control record, in one order with all records."""
    rows = V.arrivals(spark, d).select("source_id", "epoch_id", "arrival_ordinal", "channel_id")
    return sets.disconnects(rows, C("channel_id") == "error", ["source_id"], ["epoch_id", "arrival_ordinal"]).drop("channel_id")


@query(
    """SELECT symbol, event_id, bids, asks, CAST(best_bid AS VARCHAR) AS best_bid FROM (SELECT instrument_uid AS symbol, event_id, received_time_ns, count(*) FILTER (side = 'buy') AS bids, count(*) FILTER (side = 'sell') AS asks,
    arg_min(price, level_ordinal) FILTER (side = 'buy') AS best_bid FROM book_levels GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY received_time_ns DESC, event_id DESC) = 1""",
    ["book_levels"],
)
def r9_replaced_books(spark, d):
    """Every message is a whole book; the last one of each coin stands."""
    level = lambda side: F.transform(side, lambda x: F.struct(x[0].alias("px"), x[1].alias("sz"), L(1).alias("n")))

    def build():
        return {"channel": L("l2Book"), "data": F.struct(C("instrument_uid").alias("coin"), C("ms").alias("time"), F.array(level(C("bids")), level(C("asks"))).alias("levels"))}

    rows = N.split(N.apply(G.from_books(spark, d, build), venues.HYPERLIQUID["book"], keep=["event_id"]))[0]
    last = books.latest_books(rows, ["symbol"], ["event_time_ns", "event_id"])
    size = lambda c: F.size(c).cast("long").alias(c)
    return last.select("symbol", "event_id", size("bids"), size("asks"), F.get("bids", L(0))["price"].cast("string").alias("best_bid"))
