"""Queries of the aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.operators import aggs, digests, windows
from tickloom.plans import views as V
from tickloom.plans.q_filters import multiset_sql
from tickloom.plans.registry import query

DAY = 1_704_067_200_000_000_000
END = DAY + 30 * V.NS_PER_DAY


@query("SELECT source_id, channel_id, count(*) AS n, min(received_time_ns) AS first_ns, max(received_time_ns) AS last_ns FROM trades GROUP BY ALL", ["trades"])
def g1_extent(spark, d):
    return aggs.extent(V.trades(spark, d), ["source_id", "channel_id"])


@query("SELECT instrument_uid, count(*) AS n, CAST(sum(price) AS VARCHAR) AS total FROM trades WHERE price IS NOT NULL GROUP BY 1 ORDER BY n DESC, instrument_uid LIMIT 1000", ["trades"])
def g2_research(spark, d):
    return aggs.research(V.trades(spark, d)).withColumn("total", F.col("total").cast("string"))


@query(multiset_sql("(SELECT DISTINCT source_id, native_trade_id FROM arrivals_gapped)", "source_id", ["native_trade_id"]), ["arrivals_gapped"])
def g3_distinct_events(spark, d):
    ids = V.arrivals_gapped(spark, d).select("source_id", "native_trade_id").distinct()
    return digests.multiset_digest(ids, ["source_id"])


@query(
    """SELECT scope, count(*) AS total, count_if(outcome IS NULL) AS open, count_if(outcome = 'observed') AS observed, count_if(outcome = 'missed') AS missed FROM opportunities GROUP BY 1""",
    ["opportunities"],
)
def g4_outcome_counts(spark, d):
    o = V.opportunities(spark, d)
    return aggs.outcome_counts(o.where("opportunity_id % 2 = 0"), o.where("opportunity_id % 2 = 1"), ["observed", "missed"])


@query("SELECT CASE native_trade_id % 13 WHEN 1 THEN 'missing' WHEN 2 THEN 'null' ELSE 'empty' END AS code, count(*) AS n FROM raw_json WHERE native_trade_id % 13 IN (1, 2, 3) GROUP BY 1", ["raw_json"])
def g5_rejections(spark, d):
    from tickloom.functions.scalars import json_state

    rows = V.raw_json(spark, d).select(json_state(F.col("payload"), "p").alias("code"))
    return rows.where("code <> 'value'").groupBy("code").agg(F.count("*").alias("n"))


@query(
    """SELECT channel_id, min(received_time_ns) AS first_ns, max(received_time_ns) AS last_ns, count(*) AS n,
    arg_min(native_trade_id, (received_time_ns, native_trade_id)) AS first_at, arg_max(native_trade_id, (received_time_ns, native_trade_id)) AS last_at FROM trades GROUP BY 1""",
    ["trades"],
)
def g6_schema_observations(spark, d):
    return aggs.schema_observations(V.trades(spark, d), "channel_id", "received_time_ns", "native_trade_id")


@query("SELECT source_id, channel_id, instrument_uid, min(received_time_ns) AS start_ns, max(received_time_ns) + 1 AS end_ns FROM trades GROUP BY ALL", ["trades"])
def g7_tuple_coverage(spark, d):
    e = aggs.extent(V.trades(spark, d), ["source_id", "channel_id", "instrument_uid"])
    return e.select("source_id", "channel_id", "instrument_uid", F.col("first_ns").alias("start_ns"), (F.col("last_ns") + 1).alias("end_ns"))


@query("SELECT channel_id AS name, CASE WHEN amount < 50 THEN 'counter' ELSE 'histogram' END AS kind, count(*) AS n, CAST(sum(amount) AS VARCHAR) AS total FROM trades GROUP BY ALL", ["trades"])
def g8_telemetry(spark, d):
    kind = F.when(F.col("amount") < 50, "counter").otherwise("histogram")
    return V.trades(spark, d).groupBy(F.col("channel_id").alias("name"), kind.alias("kind")).agg(F.count("*").alias("n"), F.sum("amount").cast("string").alias("total"))


@query(
    """SELECT instrument_uid, CASE WHEN count(DISTINCT CASE WHEN NOT p THEN u END) <= 1 THEN CAST(sum(CASE WHEN NOT p THEN amount END) AS VARCHAR) END AS total,
    count_if(p) AS excluded, count(DISTINCT CASE WHEN NOT p THEN u END) > 1 AS mixed FROM (SELECT *, native_trade_id % 10 = 0 AS p,
    CASE WHEN instrument_uid LIKE '%7' AND native_trade_id % 2 = 0 THEN 'quote' ELSE 'base' END AS u FROM trades) GROUP BY 1""",
    ["trades"],
)
def g9_strict_total(spark, d):
    unit = F.when(F.col("instrument_uid").endswith("7") & (F.col("native_trade_id") % 2 == 0), "quote").otherwise("base")
    out = aggs.strict_total(V.trades(spark, d).withColumn("unit", unit), ["instrument_uid"], "amount", "unit", F.col("native_trade_id") % 10 == 0)
    return out.withColumn("total", F.col("total").cast("string"))


@query(
    """SELECT source_id, channel_id, epoch_id, count(*) AS n, min(received_time_ns) AS first_ns, max(received_time_ns) AS last_ns, count(price) AS n_price,
    CAST(sum(price) AS VARCHAR) AS sum_price, count(amount) AS n_amount, CAST(sum(amount) AS VARCHAR) AS sum_amount FROM trades GROUP BY ALL""",
    ["trades"],
)
def g10_evidence(spark, d):
    return aggs.evidence(V.trades(spark, d), ["source_id", "channel_id", "epoch_id"], "received_time_ns", ["price", "amount"])


@query("SELECT s AS state, count(o_orderkey) AS n FROM (VALUES ('F'), ('O'), ('P'), ('X')) v(s) LEFT JOIN orders ON o_orderstatus = s GROUP BY 1")
def g11_state_counts(spark, d):
    states = spark.createDataFrame([("F",), ("O",), ("P",), ("X",)], "state string")
    return aggs.zero_filled(V.load(spark, d, "orders").withColumnRenamed("o_orderstatus", "state"), states, "state")


@query("SELECT source_id, channel_id, ((sum(amount)::BIGINT * 30 + 28) // 29)::BIGINT AS projected FROM trades GROUP BY ALL", ["trades"])
def g12_capacity(spark, d):
    return aggs.capacity(V.trades(spark, d).withColumn("size", F.col("amount").cast("long")), ["source_id", "channel_id"], "size", 29)


@query(
    """SELECT source_id, count(*) AS records, sum(amount)::BIGINT AS bytes, (max(received_time_ns) - min(received_time_ns)) // 1000000000 AS seconds,
    count(*) * 1000000 // ((max(received_time_ns) - min(received_time_ns)) // 1000000000) AS records_per_ms, 4000 - count(*) AS loss FROM trades GROUP BY 1""",
    ["trades"],
)
def g13_throughput(spark, d):
    s = F.expr("(max(received_time_ns) - min(received_time_ns)) div 1000000000")
    n = F.count("*")
    return V.trades(spark, d).groupBy("source_id").agg(
        n.alias("records"),
        F.sum("amount").cast("long").alias("bytes"),
        s.alias("seconds"),
        F.call_function("div", n * 1_000_000, s).alias("records_per_ms"),
        (F.lit(4000) - n).alias("loss"),
    )


@query(
    "SELECT channel_id, " + ", ".join(f"count_if(lag <= {e}) AS le_{e}" for e in aggs.LAG_EDGES_MS)
    + ", count(*) AS n FROM (SELECT *, (received_time_ns - exchange_time_ns) // 1000000 AS lag FROM trades) GROUP BY 1",
    ["trades"],
)
def g14_lag_histogram(spark, d):
    return aggs.histogram(V.trades(spark, d), ["channel_id"], F.expr("(received_time_ns - exchange_time_ns) div 1000000"))


_W = 30 * V.NS_PER_DAY // 180


@query(
    f"""SELECT cell, max(rank) AS worst FROM (SELECT CASE WHEN end_ns - start_ns > 43200000000000 THEN 2 ELSE 1 END AS rank,
    unnest(range(greatest(0, (start_ns - {DAY}) // {_W}), least(179, (end_ns - 1 - {DAY}) // {_W}) + 1)) AS cell FROM gaps WHERE start_ns < {END} AND end_ns > {DAY}) GROUP BY 1""",
    ["gaps"],
)
def g15_coverage_tape(spark, d):
    rank = F.when(F.col("end_ns") - F.col("start_ns") > 43_200_000_000_000, 2).otherwise(1)
    return aggs.tape(V.gaps(spark, d), DAY, END, rank)


_NOW = DAY + 30 * V.NS_PER_DAY - 100 * 1_000_000_000


@query(
    f"""SELECT channel_id, CASE WHEN {_NOW} - max(end_ns) > 300000000000 THEN 'broken' WHEN {_NOW} - max(end_ns) > 60000000000 THEN 'stale' ELSE 'fresh' END AS verdict
    FROM windows_of GROUP BY 1""",
    ["windows_of"],
)
def g16_freshness(spark, d):
    return aggs.freshness(V.windows_of(spark, d), ["channel_id"], "end_ns", _NOW)


@query(
    """SELECT c_nationkey, count_if(c_acctbal >= 5000) AS good, count_if(c_acctbal < 5000 AND c_acctbal >= 0) AS degraded, count_if(c_acctbal < 0) AS broken,
    greatest(max(CASE WHEN c_acctbal >= 5000 THEN 0 WHEN c_acctbal >= 0 THEN 1 ELSE 2 END), max(c_custkey % 2)::INTEGER)::INTEGER AS verdict FROM customer GROUP BY 1"""
)
def g17_continuity(spark, d):
    rank = F.when(F.col("c_acctbal") >= 5000, 0).when(F.col("c_acctbal") >= 0, 1).otherwise(2)
    return aggs.continuity(V.load(spark, d, "customer"), ["c_nationkey"], rank, (F.col("c_custkey") % 2).cast("int"))


@query(
    f"""SELECT c.channel_id, count_if(d.coverage_id IS NULL) AS without_dataset, count_if(c.coverage_id LIKE '%/I1%') AS uncommitted,
    CASE WHEN max(end_ns) < {END - 1800 * 10**9} THEN 'broken' WHEN max(end_ns) < {END - 300 * 10**9} THEN 'stale' ELSE 'current' END AS lag
    FROM windows_of c LEFT JOIN (SELECT coverage_id FROM windows_of WHERE epoch_id <> '2024-01-03') d USING (coverage_id) GROUP BY 1""",
    ["windows_of"],
)
def g18_projection_verdict(spark, d):
    c = V.windows_of(spark, d)
    built = c.where("epoch_id <> '2024-01-03'").select("coverage_id", F.lit(True).alias("built"))
    last = F.max("end_ns")
    lag = F.when(last < END - aggs.LAG_BROKEN_S * 10**9, "broken").when(last < END - aggs.LAG_STALE_S * 10**9, "stale").otherwise("current")
    return c.join(built, "coverage_id", "left").groupBy("channel_id").agg(
        F.count_if(F.col("built").isNull()).alias("without_dataset"), F.count_if(F.col("coverage_id").contains("/I1")).alias("uncommitted"), lag.alias("lag")
    )


_B = 1_705_276_800_000_000_000


@query(f"SELECT count_if(received_time_ns < {_B}) AS before, count_if(received_time_ns = {_B}) AS at, count_if(received_time_ns > {_B}) AS after FROM trades", ["trades"])
def g19_cutover_counts(spark, d):
    t = F.col("received_time_ns")
    return V.trades(spark, d).agg(F.count_if(t < _B).alias("before"), F.count_if(t == _B).alias("at"), F.count_if(t > _B).alias("after"))


@query(
    """SELECT channel_id, hour, count(*) AS n, max(gap) AS longest_gap_ns, max(received_time_ns - exchange_time_ns) AS longest_lag_ns FROM (SELECT *,
    received_time_ns // 3600000000000 AS hour, received_time_ns - lag(received_time_ns) OVER (PARTITION BY channel_id ORDER BY received_time_ns, native_trade_id) AS gap FROM trades) GROUP BY ALL""",
    ["trades"],
)
def g20_channel_rates(spark, d):
    rows = windows.next_time(V.trades(spark, d), ["channel_id"], "received_time_ns", "before_ns", backwards=True)
    rows = rows.withColumn("gap", F.col("received_time_ns") - F.col("before_ns"))
    return rows.groupBy("channel_id", F.expr("received_time_ns div 3600000000000").alias("hour")).agg(
        F.count("*").alias("n"), F.max("gap").alias("longest_gap_ns"), F.max(F.col("received_time_ns") - F.col("exchange_time_ns")).alias("longest_lag_ns")
    )


@query(
    """SELECT cycle, count(DISTINCT page) = max(page) + 1 AS pages_complete, count(*) = count(DISTINCT symbol) AS symbols_unique FROM
    (SELECT p_brand AS cycle, p_partkey // 50 % 4 AS page, p_name AS symbol FROM part WHERE p_size > 10) GROUP BY 1"""
)
def g21_pages(spark, d):
    rows = V.load(spark, d, "part").where("p_size > 10").select(F.col("p_brand").alias("cycle"), F.expr("p_partkey div 50 % 4").alias("page"), F.col("p_name").alias("symbol"))
    return aggs.pages_complete(rows, "cycle", "page", "symbol")
