"""Queries of the ordering and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators import digests, replay, sets, windows
from tickloom.plans import views as V
from tickloom.plans.registry import query

EPOCH = ["source_id", "epoch_id"]


@query("SELECT native_trade_id, arrival_ordinal + 100 AS arrival_ordinal FROM arrivals", ["arrivals"])
def w1_arrival_ordinals(spark, d):
    rows = V.trades(spark, d)
    resume = rows.select(*EPOCH).distinct().withColumn("last_ordinal", F.lit(100).cast("long"))
    return windows.number_arrivals(rows, EPOCH, ["received_time_ns", "native_trade_id"], resume).select("native_trade_id", "arrival_ordinal")


@query(
    """SELECT source_id, epoch_id, p + 1 AS first_missing, arrival_ordinal - 1 AS last_missing FROM (SELECT *, lag(arrival_ordinal, 1, 0::BIGINT)
    OVER (PARTITION BY source_id, epoch_id ORDER BY arrival_ordinal) AS p FROM arrivals_gapped) WHERE arrival_ordinal > p + 1""",
    ["arrivals_gapped"],
)
def w2_ordinal_gaps(spark, d):
    return windows.ordinal_gaps(V.arrivals_gapped(spark, d), EPOCH)


_SEGMENTS = """SELECT source_id, epoch_id, seg, min(arrival_ordinal) AS first, max(arrival_ordinal + seg % 3 * 5) AS last FROM
    (SELECT *, arrival_ordinal // 20 AS seg FROM arrivals) GROUP BY ALL"""


def _segments(spark, d):
    rows = V.arrivals(spark, d).withColumn("seg", F.expr("arrival_ordinal div 20"))
    return rows.groupBy(*EPOCH, "seg").agg(F.min("arrival_ordinal").alias("first"), (F.max("arrival_ordinal") + F.col("seg") % 3 * 5).alias("last"))


@query(
    f"""SELECT source_id, epoch_id, first, last, CASE WHEN e >= first THEN e + 1 ELSE first END AS emit_from FROM (SELECT *, max(last) OVER
    (PARTITION BY source_id, epoch_id ORDER BY first, last ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS e FROM ({_SEGMENTS}))""",
    ["arrivals"],
)
def w3_overlap_rest(spark, d):
    return windows.overlap_rest(_segments(spark, d), EPOCH, "first", "last").select(*EPOCH, "first", "last", "emit_from")


@query(
    """SELECT *, lag(epoch_id) OVER (PARTITION BY source_id ORDER BY first_ns, epoch_id) AS previous_epoch FROM
    (SELECT source_id, epoch_id, min(received_time_ns) AS first_ns FROM arrivals GROUP BY ALL)""",
    ["arrivals"],
)
def w4_epoch_boundaries(spark, d):
    return windows.epoch_boundaries(V.arrivals(spark, d), "source_id", "epoch_id", "received_time_ns")


@query("SELECT source_id, epoch_id, arrival_ordinal, 'disconnect' AS kind FROM arrivals WHERE channel_id = 'error'", ["arrivals"])
def w5_disconnects(spark, d):
    controls = V.arrivals(spark, d).where("channel_id = 'error'").select(*EPOCH, "arrival_ordinal")
    marks = sets.with_markers(controls.limit(0), controls, ["source_id", "epoch_id", "arrival_ordinal"])
    return marks.select(*EPOCH, "arrival_ordinal", F.lit("disconnect").alias("kind"))


@query(
    f"""SELECT source_id, epoch_id, seg, CASE WHEN seg % 7 = 3 THEN 'missing' WHEN seg % 5 = 2 THEN 'corrupt' END AS reason FROM ({_SEGMENTS})
    WHERE seg % 7 = 3 OR seg % 5 = 2""",
    ["arrivals"],
)
def w6_bad_segments(spark, d):
    listed = _segments(spark, d).withColumn("n", F.col("last") - F.col("first"))
    found = listed.where("seg % 7 <> 3").select(*EPOCH, "seg", (F.col("n") + F.when(F.col("seg") % 5 == 2, 1).otherwise(0)).alias("found"))
    reason = F.when(F.col("found").isNull(), "missing").when(F.col("found") != F.col("n"), "corrupt")
    return listed.join(found, [*EPOCH, "seg"], "left").select(*EPOCH, "seg", reason.alias("reason")).where("reason IS NOT NULL")


@query(
    """SELECT source_id, epoch_id, arrival_ordinal, native_trade_id FROM arrivals JOIN (SELECT source_id, epoch_id, min(received_time_ns) AS f FROM arrivals GROUP BY ALL)
    USING (source_id, epoch_id) ORDER BY source_id, f, epoch_id, arrival_ordinal""",
    ["arrivals"],
)
def w7_native_order(spark, d):
    rows = windows.native_order(V.arrivals(spark, d), "source_id", "epoch_id", "received_time_ns", "arrival_ordinal")
    return rows.select("source_id", "epoch_id", "arrival_ordinal", "native_trade_id")


@query("SELECT received_time_ns, source_id, channel_id, epoch_id, arrival_ordinal, native_trade_id FROM arrivals ORDER BY ALL", ["arrivals"])
def w8_observed_order(spark, d):
    keys = ["received_time_ns", "source_id", "channel_id", "epoch_id", "arrival_ordinal", "native_trade_id"]
    return windows.observed_order(V.arrivals(spark, d).select(*keys), keys)


@query(
    """SELECT native_trade_id, row_number() OVER (PARTITION BY channel_id, source_id ORDER BY instrument_uid, f, epoch_id, arrival_ordinal, native_trade_id) AS dataset_ordinal
    FROM arrivals JOIN (SELECT channel_id, source_id, instrument_uid, epoch_id, min(received_time_ns) AS f FROM arrivals GROUP BY ALL) USING (channel_id, source_id, instrument_uid, epoch_id)""",
    ["arrivals"],
)
def w9_dataset_order(spark, d):
    return windows.dataset_order(V.arrivals(spark, d), ["channel_id", "source_id"])[0].select("native_trade_id", "dataset_ordinal")


@query("SELECT channel_id, source_id, epoch_id, arrival_ordinal FROM arrivals_gapped GROUP BY ALL HAVING count(*) > 1", ["arrivals_gapped"])
def w9_repeated_coordinates(spark, d):
    return windows.dataset_order(V.arrivals_gapped(spark, d), ["channel_id", "source_id"])[1].drop("count")


@query(
    """SELECT source_id, instrument_uid, received_time_ns, native_trade_id FROM trades WHERE (source_id, instrument_uid, received_time_ns, native_trade_id) > ('S1', 'I100', 1705000000000000000, 0)
    ORDER BY ALL LIMIT 501""",
    ["trades"],
)
def w10_keyset_page(spark, d):
    keys = ["source_id", "instrument_uid", "received_time_ns", "native_trade_id"]
    cursor = dict(zip(keys, ("S1", "I100", 1_705_000_000_000_000_000, 0), strict=True))
    return windows.page(V.trades(spark, d).select(*keys), keys, 500, cursor)


@query(
    """SELECT native_trade_id FROM (SELECT native_trade_id, (exchange_time_ns, native_trade_id) AS k, lag((exchange_time_ns, native_trade_id)) OVER
    (PARTITION BY source_id, epoch_id ORDER BY arrival_ordinal) AS b FROM arrivals) WHERE k <= b""",
    ["arrivals"],
)
def w11_page_order_guard(spark, d):
    return windows.order_faults(V.arrivals(spark, d), EPOCH, "arrival_ordinal", ["exchange_time_ns", "native_trade_id"]).select("native_trade_id")


@query("SELECT channel_id, max(epoch_id) AS epoch_id FROM windows_of GROUP BY 1", ["windows_of"])
def w12_latest_dataset(spark, d):
    sets_ = V.windows_of(spark, d).select("channel_id", "epoch_id").distinct()
    return windows.latest(sets_, ["channel_id"], ["epoch_id"])


@query(
    """SELECT instrument_uid, generation, state, valid_from_ns, valid_to_ns FROM (SELECT *, observed_ns AS valid_from_ns, lead(observed_ns) OVER w AS valid_to_ns,
    coalesce(sum(CASE WHEN before = 'closed' THEN 1 ELSE 0 END) OVER w, 0)::BIGINT + 1 AS generation FROM (SELECT *, lag(s) OVER (PARTITION BY instrument_uid ORDER BY observed_ns) AS before FROM
    (SELECT *, CASE WHEN terms = 'F' AND state = '5-LOW' THEN 'closed' ELSE state END AS s FROM instrument_versions)) WHERE s IS DISTINCT FROM before
    WINDOW w AS (PARTITION BY instrument_uid ORDER BY observed_ns)) WHERE s <> 'closed'""",
    ["instrument_versions"],
)
def w13_versions(spark, d):
    closed = (F.col("terms") == "F") & (F.col("state") == "5-LOW")
    rows = V.instrument_versions(spark, d).withColumn("state", F.when(closed, "closed").otherwise(F.col("state")))
    return windows.versions(rows, "instrument_uid", "observed_ns", ["state"], F.col("state") == "closed")


@query(
    """SELECT coverage_id FROM (SELECT *, lead(start_ns) OVER (PARTITION BY source_id, channel_id ORDER BY start_ns, end_ns) AS n FROM windows_of) WHERE n < end_ns""",
    ["windows_of"],
)
def w14_overlapping(spark, d):
    return windows.overlapping(V.windows_of(spark, d), ["source_id", "channel_id"], "start_ns", "end_ns").select("coverage_id")


_LEGAL = {"signup": ("view", "click"), "view": ("click", "view", "purchase"), "click": ("purchase", "view"), "purchase": ("view",)}


@query(
    """SELECT native_trade_id FROM (SELECT *, lag(channel_id) OVER (PARTITION BY instrument_uid ORDER BY received_time_ns, native_trade_id) AS b FROM trades)
    WHERE NOT CASE b WHEN 'signup' THEN channel_id IN ('view','click') WHEN 'view' THEN channel_id IN ('click','view','purchase') WHEN 'click' THEN channel_id IN ('purchase','view')
    WHEN 'purchase' THEN channel_id = 'view' WHEN 'error' THEN false ELSE channel_id = 'signup' END""",
    ["trades"],
)
def w15_lifecycle(spark, d):
    return windows.lifecycle_faults(V.trades(spark, d), "instrument_uid", ["received_time_ns", "native_trade_id"], "channel_id", _LEGAL, "signup").select("native_trade_id")


@query(
    """SELECT instrument_uid, observed_ns, attribute, before, after FROM (SELECT instrument_uid, observed_ns, unnest([{'attribute': 'state', 'before': lag(state) OVER w, 'after': state},
    {'attribute': 'terms', 'before': lag(terms) OVER w, 'after': terms}], recursive := true), row_number() OVER w AS n FROM instrument_versions
    WINDOW w AS (PARTITION BY instrument_uid ORDER BY observed_ns)) WHERE n > 1 AND before IS DISTINCT FROM after""",
    ["instrument_versions"],
)
def w16_attribute_changes(spark, d):
    return windows.changes(V.instrument_versions(spark, d), ["instrument_uid"], ["observed_ns"], ["state", "terms"])


@query(
    """SELECT native_trade_id FROM (SELECT *, lag(channel_id) OVER (PARTITION BY instrument_uid ORDER BY received_time_ns, native_trade_id) AS b FROM trades) WHERE b IS DISTINCT FROM channel_id""",
    ["trades"],
)
def w17_transitions(spark, d):
    return windows.transitions(V.trades(spark, d), ["instrument_uid"], ["received_time_ns", "native_trade_id"], ["channel_id"]).select("native_trade_id")


@query("SELECT source_id, epoch_id, min(arrival_ordinal) AS at FROM arrivals WHERE native_trade_id % 37 = 0 GROUP BY ALL", ["arrivals"])
def w18_first_mismatch(spark, d):
    a = V.arrivals(spark, d)
    b = a.withColumn("price", F.when(F.col("native_trade_id") % 37 != 0, F.col("price")))
    return windows.first_mismatch(a.where("price IS NOT NULL"), b, EPOCH, "arrival_ordinal", "price")


@query(
    """SELECT native_trade_id, coalesce(exchange_time_ns < max(exchange_time_ns) OVER (PARTITION BY source_id, epoch_id ORDER BY arrival_ordinal
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS regressed FROM arrivals""",
    ["arrivals"],
)
def w19_time_regressions(spark, d):
    rows = V.arrivals(spark, d)
    return windows.time_regressions(rows, EPOCH, ["arrival_ordinal"], "exchange_time_ns").select("native_trade_id", "regressed")


@query("SELECT l_orderkey, list_sort(list(l_linenumber)) = list(l_linenumber ORDER BY l_partkey, l_suppkey, l_linenumber) AND count(DISTINCT l_linenumber) = count(*) AS ascending FROM lineitem GROUP BY 1")
def w22_array_evidence(spark, d):
    rows = V.load(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_partkey", "l_suppkey", "l_linenumber")))["l_linenumber"].alias("x"))
    return rows.select("l_orderkey", windows.strictly_ascending("x").alias("ascending"))


@query(f"SELECT source_id, epoch_id, seg, native_trade_id, row_number() OVER (PARTITION BY source_id, epoch_id, arrival_ordinal // 20 ORDER BY arrival_ordinal) AS record_ordinal FROM (SELECT *, arrival_ordinal // 20 AS seg FROM arrivals)", ["arrivals"])
def w21_record_ordinals(spark, d):
    rows = V.arrivals(spark, d).withColumn("seg", F.expr("arrival_ordinal div 20"))
    w = Window.partitionBy(*EPOCH, "seg").orderBy("arrival_ordinal")
    return rows.select(*EPOCH, "seg", "native_trade_id", F.row_number().over(w).cast("long").alias("record_ordinal"))


# ---- sets -----------------------------------------------------------------------------------------------


@query(
    """SELECT received_time_ns AS at_ns, 'record' AS kind, native_trade_id::VARCHAR AS id FROM trades UNION ALL SELECT start_ns, 'gap', gap_id FROM gaps""",
    ["trades", "gaps"],
)
def t1_records_and_gaps(spark, d):
    records = V.trades(spark, d).select(F.col("received_time_ns").alias("at_ns"), F.col("native_trade_id").cast("string").alias("id"))
    marks = V.gaps(spark, d).select(F.col("start_ns").alias("at_ns"), F.col("gap_id").alias("id"))
    return sets.with_markers(records, marks, ["at_ns", "id"]).select("at_ns", "kind", "id")


_REPLAY = ["source_id", "instrument_uid"]
_REPLAY_SQL = """SELECT *, row_number() OVER w AS place, (least(sum(k) OVER w - k, (SELECT count(*) FROM r) - 1) // 500)::BIGINT AS page FROM
    (SELECT *, 'gap' AS kind, 0 AS k FROM g UNION ALL SELECT *, 'record', 1 FROM r) WINDOW w AS (ORDER BY source_id, instrument_uid, at_ns, k, channel_id, id ROWS UNBOUNDED PRECEDING)"""
_REPLAY_ROWS = """r AS (SELECT source_id, instrument_uid, received_time_ns AS at_ns, channel_id, lpad(native_trade_id::VARCHAR, 12, '0') AS id FROM trades),
    g AS (SELECT source_id, instrument_uid, start_ns AS at_ns, channel_id, gap_id AS id FROM gaps)"""


def _replay(spark, d):
    shared = [*_REPLAY, "at_ns", "channel_id", "id"]
    records = V.trades(spark, d).withColumns({"at_ns": F.col("received_time_ns"), "id": F.lpad(F.col("native_trade_id").cast("string"), 12, "0")}).select(shared)
    marks = V.gaps(spark, d).withColumns({"at_ns": F.col("start_ns"), "id": F.col("gap_id")}).select(shared)
    return replay.pages(records, marks, _REPLAY, "at_ns", ["channel_id", "id"], 500)


@query(f"WITH {_REPLAY_ROWS} SELECT id, kind, place, page FROM ({_REPLAY_SQL})", ["trades", "gaps"])
def t1_replay(spark, d):
    """The whole dataset in the order of a replay, in pages of 500 records with the gaps between them."""
    return _replay(spark, d).select("id", "kind", "place", "page")


@query(
    f"""WITH {_REPLAY_ROWS}, p AS ({_REPLAY_SQL}) SELECT page, count(*) FILTER (kind = 'record') AS records, count(*) FILTER (kind = 'gap') AS gaps,
    max_by(id, place) FILTER (kind = 'record') AS last_id, page < (SELECT max(page) FROM p) AS has_more, NULL::VARCHAR AS fault FROM p GROUP BY page""",
    ["trades", "gaps"],
)
def w11_replay_pages(spark, d):
    """All pages of the replay, each checked in itself and against the one before."""
    found = replay.checked(_replay(spark, d), [*_REPLAY, "at_ns", "channel_id", "id"], 500)
    return found.select("page", "records", "gaps", F.col("last_key.id").alias("last_id"), "has_more", "fault")


def _ledgers(spark, d):
    o = V.opportunities(spark, d)
    archived = o.where("opportunity_id % 3 = 0").withColumn("outcome", F.when(F.col("opportunity_id") % 30 == 0, "other").otherwise(F.col("outcome")))
    return o.where("opportunity_id % 2 = 0"), archived


@query("SELECT opportunity_id FROM opportunities WHERE opportunity_id % 2 = 0 OR (opportunity_id % 3 = 0)", ["opportunities"])
def t2_merged_ledgers(spark, d):
    current, archived = _ledgers(spark, d)
    rows, _ = sets.merged(current, archived, "opportunity_id", digests.row_hash(current))
    return rows.select("opportunity_id").distinct()


@query("SELECT opportunity_id FROM opportunities WHERE opportunity_id % 30 = 0", ["opportunities"])
def t2_conflicts(spark, d):
    current, archived = _ledgers(spark, d)
    return sets.merged(current, archived, "opportunity_id", digests.row_hash(current))[1]


@query("SELECT o_custkey AS id FROM orders UNION SELECT c_custkey FROM customer UNION SELECT s_suppkey FROM supplier")
def t3_distinct_ids(spark, d):
    ids = [V.load(spark, d, t).select(F.col(c).alias("id")) for t, c in (("orders", "o_custkey"), ("customer", "c_custkey"), ("supplier", "s_suppkey"))]
    return ids[0].union(ids[1]).union(ids[2]).distinct()


@query(
    """SELECT native_trade_id, 'missing' AS side FROM trades WHERE native_trade_id % 17 = 0 UNION ALL SELECT native_trade_id, 'extra' FROM trades WHERE native_trade_id % 17 <> 0 AND native_trade_id % 41 = 0""",
    ["trades"],
)
def t4_set_equality(spark, d):
    return sets.set_difference(V.trades(spark, d).select("native_trade_id"), V.arrivals_gapped(spark, d).select("native_trade_id"))


@query("SELECT DISTINCT instrument_uid FROM trades WHERE instrument_uid NOT IN (SELECT instrument_uid FROM gaps)", ["trades", "gaps"])
def t5_not_found(spark, d):
    return V.trades(spark, d).select("instrument_uid").distinct().join(V.gaps(spark, d), "instrument_uid", "left_anti")


@query(
    """SELECT l_orderkey, (count(DISTINCT l_partkey) FILTER (l_linenumber <= 4) - count(DISTINCT l_partkey) FILTER (l_linenumber <= 4 AND p2))::INTEGER AS missing,
    (count(l_suppkey) - count(DISTINCT l_suppkey))::INTEGER AS repeated FROM (SELECT *, l_partkey IN (SELECT i.l_partkey FROM lineitem i WHERE i.l_orderkey = o.l_orderkey AND i.l_linenumber > 2) AS p2 FROM lineitem o) GROUP BY 1"""
)
def t6_inventory(spark, d):
    pick = lambda c: F.collect_list(F.when(c, F.col("l_partkey")))
    rows = V.load(spark, d, "lineitem").groupBy("l_orderkey").agg(
        pick(F.col("l_linenumber") <= 4).alias("a"), pick(F.col("l_linenumber") > 2).alias("b"), F.collect_list("l_suppkey").alias("s")
    )
    return rows.select("l_orderkey", sets.inventory(F.col("a"), F.col("b"))["missing"].alias("missing"), sets.inventory(F.col("s"), F.col("s"))["repeated"].alias("repeated"))


@query(
    """SELECT native_trade_id, CASE WHEN native_trade_id % 19 = 0 THEN 'only_second' WHEN native_trade_id % 23 = 0 THEN 'only_first' ELSE 'differs' END AS difference FROM trades
    WHERE (native_trade_id % 19 = 0) <> (native_trade_id % 23 = 0) OR (native_trade_id % 29 = 0 AND native_trade_id % 19 <> 0)""",
    ["trades"],
)
def t7_run_comparison(spark, d):
    a = V.trades(spark, d).where("native_trade_id % 19 <> 0")
    b = V.trades(spark, d).where("native_trade_id % 23 <> 0").withColumn("price", F.when(F.col("native_trade_id") % 29 == 0, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(38,18)"))
    return sets.run_comparison(a, b, "native_trade_id", ["price", "amount"])
