"""Queries of the books, stateful batch forms and the quality ledger."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators import books, joins, quality
from tickloom.plans import views as V
from tickloom.plans.registry import query

C, L = F.col, F.lit
HALF = 915_148_800_000_000_000
ORDER = ["received_time_ns", "event_id", "level_ordinal"]
BOOK_SQL = f"""SELECT instrument_uid, side, price, arg_max(action, (received_time_ns, event_id, level_ordinal)) AS act,
    arg_max(amount, (received_time_ns, event_id, level_ordinal)) AS amount FROM book_levels WHERE received_time_ns <= {HALF} GROUP BY ALL HAVING act <> 'delete'"""


def _book(spark, d):
    return books.book_at(V.book_levels(spark, d), ["instrument_uid"], C("received_time_ns") <= HALF, ORDER)


@query(f"SELECT instrument_uid, side, CAST(price AS VARCHAR) AS price, CAST(amount AS VARCHAR) AS amount FROM ({BOOK_SQL})", ["book_levels"])
def r3_book_at_time(spark, d):
    return _book(spark, d).select("instrument_uid", "side", C("price").cast("string").alias("price"), C("amount").cast("string").alias("amount"))


@query(
    f"""SELECT instrument_uid, side, CAST(price AS VARCHAR) AS price, level FROM (SELECT *, row_number() OVER (PARTITION BY instrument_uid, side
    ORDER BY CASE WHEN side = 'buy' THEN -price ELSE price END)::INTEGER AS level FROM ({BOOK_SQL})) WHERE level <= 10""",
    ["book_levels"],
)
def w20_top_levels(spark, d):
    return books.top_levels(_book(spark, d), ["instrument_uid"], 10).select("instrument_uid", "side", C("price").cast("string").alias("price"), "level")


def _updates(spark, d):
    """Book events with holes: every 23rd is lost."""
    e = V.book_events(spark, d).withColumn("previous_sequence", C("first_sequence") - 1)
    return e.where("event_id % 23 <> 0")


@query(
    """SELECT event_id FROM (SELECT *, lag(last_sequence) OVER (PARTITION BY instrument_uid ORDER BY received_time_ns, event_id) AS p FROM book_events WHERE event_id % 23 <> 0) WHERE first_sequence - 1 <> p""",
    ["book_events"],
)
def r4_chain_gaps(spark, d):
    return books.sequence_gaps(_updates(spark, d), ["instrument_uid"], ["received_time_ns", "event_id"], chained=True).select("event_id")


@query(
    """SELECT event_id FROM (SELECT *, lag(last_sequence) OVER (PARTITION BY instrument_uid ORDER BY received_time_ns, event_id) AS p FROM book_events WHERE event_id % 23 <> 0) WHERE first_sequence > p + 1""",
    ["book_events"],
)
def r4_bridge_gaps(spark, d):
    return books.sequence_gaps(_updates(spark, d), ["instrument_uid"], ["received_time_ns", "event_id"]).select("event_id")


@query("SELECT instrument_uid, arg_max(native_trade_id, (received_time_ns, native_trade_id)) AS native_trade_id, CAST(arg_max(price, (received_time_ns, native_trade_id)) AS VARCHAR) AS price FROM trades GROUP BY 1", ["trades"])
def r9_latest_books(spark, d):
    rows = V.trades(spark, d).select("instrument_uid", "received_time_ns", "native_trade_id", C("price").cast("string").alias("price"))
    return books.latest_books(rows, ["instrument_uid"], ["received_time_ns", "native_trade_id"]).select("instrument_uid", "native_trade_id", "price")


@query(
    """SELECT native_trade_id, list_last(list_filter(list(x) OVER w, lambda y: y.h)).v AS now_mark FROM (SELECT *, {'h': channel_id IN ('signup', 'view', 'click'),
    'v': CASE WHEN channel_id = 'view' THEN NULL WHEN channel_id = 'click' THEN '' ELSE native_trade_id::VARCHAR END} AS x, count_if(channel_id = 'signup') OVER
    (PARTITION BY instrument_uid ORDER BY received_time_ns, native_trade_id) AS seed FROM trades) WHERE seed > 0 WINDOW w AS (PARTITION BY instrument_uid, seed ORDER BY received_time_ns, native_trade_id)""",
    ["trades"],
)
def r10_sparse_ticker(spark, d):
    k = C("channel_id")
    rows = V.trades(spark, d).withColumns(
        {
            "kind": F.when(k == "signup", "snapshot").otherwise("delta"),
            "has_mark": k.isin("signup", "view", "click"),
            "mark": F.when(k == "click", "").when(k != "view", C("native_trade_id").cast("string")),
        }
    )
    return books.sparse_state(rows, ["instrument_uid"], ["received_time_ns", "native_trade_id"], ["mark"]).select("native_trade_id", "now_mark")


@query("SELECT native_trade_id, CASE WHEN buyer_is_maker THEN 'contracts,quote' ELSE 'contracts' END AS units FROM trades", ["trades"])
def r11_open_interest(spark, d):
    v = books.open_interest_variants(C("amount"), L(None).cast("decimal(38,18)"), F.when(C("buyer_is_maker"), C("price")))
    return V.trades(spark, d).select("native_trade_id", F.array_join(F.transform(v, lambda x: x["unit"]), ",").alias("units"))


KEYS = ["source_id", "channel_id", "instrument_uid"]


@query(
    """SELECT g.gap_id, min(received_time_ns) AS resolved_ns, CASE WHEN min(received_time_ns) IS NULL THEN 'open' ELSE 'recovered' END AS state FROM gaps g LEFT JOIN trades t ON t.source_id = g.source_id
    AND t.channel_id = g.channel_id AND t.instrument_uid = g.instrument_uid AND t.native_trade_id % 2 = 0 AND received_time_ns >= end_ns GROUP BY 1""",
    ["trades", "gaps"],
)
def r12_gap_ledger(spark, d):
    rows = quality.gap_ledger(V.gaps(spark, d), V.trades(spark, d).where("native_trade_id % 2 = 0"), KEYS, "received_time_ns")
    return rows.select("gap_id", "resolved_ns", "state")


HOURS_SQL = """SELECT source_id, hour, n FROM (SELECT source_id, received_time_ns // 3600000000000 AS hour, count(*) AS n FROM trades GROUP BY ALL)
    JOIN (SELECT source_id, max(received_time_ns) AS h FROM trades GROUP BY 1) USING (source_id) WHERE (hour + 1) * 3600000000000 <= h"""


@query(HOURS_SQL, ["trades"])
def r13_closed_hours(spark, d):
    return quality.closed_hours(V.trades(spark, d), "source_id", "received_time_ns")


def _checkpoints(spark, d):
    rows = V.arrivals(spark, d).select("source_id", "epoch_id", "arrival_ordinal", F.md5(C("native_trade_id").cast("string").cast("binary")).alias("sha"))
    return rows.where("arrival_ordinal <= 50"), rows.where("arrival_ordinal >= 40").withColumn("sha", F.when(C("arrival_ordinal") == 45, "x").otherwise(C("sha")))


@query("SELECT source_id, epoch_id, max(arrival_ordinal) AS arrival_ordinal FROM arrivals GROUP BY ALL", ["arrivals"])
def r14_checkpoints(spark, d):
    old, new = _checkpoints(spark, d)
    return quality.advance_checkpoints(old, new, ["source_id", "epoch_id"], ["arrival_ordinal"], "sha")[0].select("source_id", "epoch_id", "arrival_ordinal")


@query("SELECT source_id, epoch_id, arrival_ordinal FROM arrivals WHERE arrival_ordinal = 45", ["arrivals"])
def r14_checkpoint_conflicts(spark, d):
    old, new = _checkpoints(spark, d)
    return quality.advance_checkpoints(old, new, ["source_id", "epoch_id"], ["arrival_ordinal"], "sha")[1]


@query(
    """SELECT opportunity_id, coalesce(outcome, CASE WHEN opportunity_id % 2 = 0 THEN 'observed' END) AS outcome, CASE WHEN opportunity_id % 2 = 1 THEN 'kept' WHEN outcome IS NULL THEN 'terminalised'
    WHEN outcome = 'observed' THEN 'replayed' ELSE 'conflict' END AS what FROM opportunities UNION ALL SELECT -1, 'observed', 'inserted'""",
    ["opportunities"],
)
def r15_lifecycle_merge(spark, d):
    o = V.opportunities(spark, d).select("opportunity_id", "outcome")
    changes = o.where("opportunity_id % 2 = 0").withColumn("outcome", L("observed")).union(spark.createDataFrame([(-1, "observed")], "opportunity_id long, outcome string"))
    return quality.merge_outcomes(o, changes, "opportunity_id")


@query(
    """SELECT * FROM (SELECT channel_id, received_time_ns AS from_ns, lead(received_time_ns) OVER (PARTITION BY channel_id ORDER BY received_time_ns) - received_time_ns AS silent_ns FROM trades) WHERE silent_ns > 5400000000000""",
    ["trades"],
)
def r16_silences(spark, d):
    return quality.silences(V.trades(spark, d), ["channel_id"], "received_time_ns", 5_400_000_000_000)


DEADLINE_SQL = """SELECT r.native_trade_id AS request_id, CASE WHEN count(a.native_trade_id) > 0 THEN 'acknowledged' ELSE 'missed' END AS outcome FROM (SELECT * FROM trades WHERE channel_id = 'click') r
    LEFT JOIN (SELECT * FROM trades WHERE channel_id = 'view') a ON a.instrument_uid = r.instrument_uid AND a.received_time_ns BETWEEN r.received_time_ns AND r.received_time_ns + 21600000000000 GROUP BY 1"""


@query(DEADLINE_SQL, ["trades"])
def r17_deadlines(spark, d):
    t = V.trades(spark, d).select("instrument_uid", "channel_id", C("native_trade_id").alias("request_id"), C("received_time_ns").alias("at_ns"))
    return quality.deadlines(t.where("channel_id = 'click'"), t.where("channel_id = 'view'").drop("request_id"), ["instrument_uid"], 21_600_000_000_000)


@query("SELECT source_id, epoch_id, arrival_ordinal, native_trade_id % 41 = 0 AS duplicate FROM arrivals_gapped", ["arrivals_gapped"])
def r18_duplicate_flags(spark, d):
    rows = V.arrivals_gapped(spark, d)
    return rows.select("source_id", "epoch_id", "arrival_ordinal", quality.duplicate_flags(rows, ["source_id", "epoch_id", "arrival_ordinal"]).alias("duplicate"))


@query("SELECT native_trade_id, CASE WHEN received_time_ns < 1705276800000000000 THEN 'v1' ELSE 'v2' END AS mapper_version FROM trades", ["trades"])
def r19_cutover(spark, d):
    rows = joins.active_at(V.trades(spark, d), V.bindings(spark, d), ["channel_id"], "received_time_ns", "valid_from_ns", "valid_to_ns")
    return rows.select("native_trade_id", "mapper_version")


# ---- ledger jobs --------------------------------------------------------------------------------------------


@query(
    """SELECT utc_date, count(*) AS n, arg_min(opportunity_id, (expected_ns, opportunity_id)) AS first_id, arg_max(opportunity_id, (expected_ns, opportunity_id)) AS last_id
    FROM opportunities WHERE outcome IS NOT NULL GROUP BY 1""",
    ["opportunities"],
)
def q1_spill_generation(spark, d):
    return quality.spill_boundaries(V.opportunities(spark, d).where("outcome IS NOT NULL"), ["utc_date"], ["expected_ns", "opportunity_id"], "opportunity_id")


@query("SELECT event_id AS correction_id FROM events WHERE event_id NOT IN (SELECT event_id - 7 FROM events WHERE event_id % 5 = 0)")
def q3_corrections(spark, d):
    rows = V.load(spark, d, "events").select(C("event_id").alias("correction_id"), F.when(C("event_id") % 5 == 0, C("event_id") - 7).alias("supersedes"))
    return quality.standing(rows, "correction_id", "supersedes").select("correction_id")


@query(
    """SELECT scope, total, incidents FROM (SELECT scope, count(*) AS total FROM opportunities GROUP BY 1) LEFT JOIN
    (SELECT 'scope' || (user_id % 20) AS scope, count(DISTINCT event_id) AS incidents FROM events WHERE event_type = 'error' GROUP BY 1) USING (scope)""",
    ["opportunities"],
)
def q4_incidents(spark, d):
    incidents = V.load(spark, d, "events").where("event_type = 'error'").groupBy(F.concat(L("scope"), C("user_id") % 20).alias("scope")).agg(F.count_distinct("event_id").alias("incidents"))
    return V.opportunities(spark, d).groupBy("scope").agg(F.count("*").alias("total")).join(incidents, "scope", "left")


@query("SELECT gap_id FROM gaps WHERE source_id = 'S1' AND channel_id = 'view' AND start_ns < 1705276800000000000 AND end_ns > 1704672000000000000", ["gaps"])
def q5_gap_search(spark, d):
    from tickloom.operators.filters import overlaps

    g = V.gaps(spark, d).where("source_id = 'S1' AND channel_id = 'view'")
    return g.where(overlaps("start_ns", "end_ns", 1_704_672_000_000_000_000, 1_705_276_800_000_000_000)).select("gap_id")


@query("SELECT source_id, channel_id, instrument_uid, count(*) AS n, count(*) > 1 AS conflict FROM gaps WHERE end_ns > 1706400000000000000 GROUP BY ALL", ["gaps"])
def q6_sole_open(spark, d):
    return quality.sole_open(V.gaps(spark, d).where("end_ns > 1706400000000000000"), KEYS)


@query(
    """SELECT o_custkey, count(*) > count(DISTINCT o_orderdate) AS repeated, coalesce(count_if(o_orderdate <= p), 0) > 0 AS unordered FROM
    (SELECT *, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS p FROM orders) GROUP BY 1"""
)
def q8_declarations(spark, d):
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    rows = V.load(spark, d, "orders").withColumn("p", F.lag("o_orderdate").over(w))
    return rows.groupBy("o_custkey").agg((F.count("*") > F.count_distinct("o_orderdate")).alias("repeated"), (F.count_if(C("o_orderdate") <= C("p")) > 0).alias("unordered"))


@query(
    """SELECT channel_id, verdict FROM (SELECT channel_id, CASE WHEN min(n) * 10 >= 2 * max(n) AND max(n) * 10 >= 5 * max(n) THEN 'pass' ELSE 'fail' END AS verdict FROM
    (SELECT channel_id, epoch_id, count(*) AS n FROM trades GROUP BY ALL) GROUP BY 1)""",
    ["trades"],
)
def q9_release_thresholds(spark, d):
    daily = V.trades(spark, d).groupBy("channel_id", "epoch_id").count().groupBy("channel_id").agg(F.min("count").alias("low"), F.max("count").alias("peak"))
    return quality.release_verdict(daily, ["channel_id"], C("low") * 10, C("peak") * 10, C("peak"), L(0))


@query(
    """SELECT p_brand, item FROM (SELECT DISTINCT p_brand FROM part), (VALUES ('fault'), ('determinism'), ('canary')) r(item) WHERE (p_brand, item) NOT IN
    (SELECT p_brand, CASE p_size % 3 WHEN 0 THEN 'fault' WHEN 1 THEN 'determinism' ELSE 'canary' END FROM part WHERE p_partkey % 50 = 0)"""
)
def q10_matrix(spark, d):
    part = V.load(spark, d, "part")
    required = spark.createDataFrame([("fault",), ("determinism",), ("canary",)], "item string")
    item = F.element_at(F.array(L("fault"), L("determinism"), L("canary")), C("p_size") % 3 + 1)
    return quality.lacking(part.select("p_brand").distinct(), required, part.where("p_partkey % 50 = 0").select("p_brand", item.alias("item")), ["p_brand", "item"])
