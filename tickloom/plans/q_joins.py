"""Queries of the join operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import scalars as X
from tickloom.operators import joins
from tickloom.plans import views as V
from tickloom.plans.registry import query

DAY = 1_704_067_200_000_000_000
MIDDLE = 1_705_276_800_000_000_000


@query(
    """SELECT native_trade_id, mapper_version FROM trades t LEFT JOIN bindings b ON t.channel_id = b.channel_id
    AND received_time_ns >= valid_from_ns AND (valid_to_ns IS NULL OR received_time_ns < valid_to_ns)""",
    ["trades", "bindings"],
)
def j1_active_binding(spark, d):
    rows = joins.active_at(V.trades(spark, d), V.bindings(spark, d), ["channel_id"], "received_time_ns", "valid_from_ns", "valid_to_ns")
    return rows.select("native_trade_id", "mapper_version")


@query(
    """SELECT native_trade_id, CASE WHEN s_suppkey IS NULL THEN 'quarantine' ELSE s_name END AS instrument FROM trades
    LEFT JOIN (SELECT 'I' || s_suppkey AS instrument_uid, s_suppkey, s_name FROM supplier) USING (instrument_uid)""",
    ["trades"],
)
def j2_instrument_lookup(spark, d):
    names = V.load(spark, d, "supplier").select(F.concat(F.lit("I"), "s_suppkey").alias("instrument_uid"), F.col("s_name").alias("instrument"))
    known, unknown = joins.lookup(V.trades(spark, d), names, ["instrument_uid"])
    return known.select("native_trade_id", "instrument").unionByName(unknown.select("native_trade_id", F.lit("quarantine").alias("instrument")))


_VERSIONS = """SELECT instrument_uid, state, terms, observed_ns AS valid_from_ns,
    lead(observed_ns) OVER (PARTITION BY instrument_uid ORDER BY observed_ns) AS valid_to_ns FROM instrument_versions"""


def _versions(spark, d):
    from pyspark.sql.window import Window

    w = Window.partitionBy("instrument_uid").orderBy("observed_ns")
    v = V.instrument_versions(spark, d).withColumn("valid_to_ns", F.lead("observed_ns").over(w))
    return v.withColumnRenamed("observed_ns", "valid_from_ns")


@query(
    f"SELECT instrument_uid, state, terms FROM ({_VERSIONS}) WHERE valid_from_ns <= 900000000000000000 AND (valid_to_ns IS NULL OR valid_to_ns > 900000000000000000)",
    ["instrument_versions"],
)
def j3_catalog_as_of(spark, d):
    return joins.as_of(_versions(spark, d), 900_000_000_000_000_000).select("instrument_uid", "state", "terms")


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_quantity::BIGINT * p_size) AS quote_units,
    CASE WHEN (l_quantity::BIGINT * 1000000) % p_size = 0 THEN l_quantity::BIGINT * 1000000 // p_size END AS base_e6
    FROM lineitem JOIN part ON l_partkey = p_partkey"""
)
def j4_contract_conversion(spark, d):
    terms = joins.small(V.load(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_size"))
    rows = V.load(spark, d, "lineitem").join(terms, "l_partkey")
    n, size = F.col("l_quantity").cast("decimal(18,0)"), F.col("p_size").cast("decimal(18,0)")
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        X.exact_multiply(n, size).cast("long").alias("quote_units"),
        (X.exact_divide(n, size) * 1_000_000).cast("long").alias("base_e6"),
    )


@query(
    f"""SELECT o_orderkey, coalesce(CASE terms WHEN 'F' THEN 'base' WHEN 'P' THEN 'quote' END, 'provisional') AS unit
    FROM (SELECT *, 'I' || (o_custkey % 200) AS instrument_uid, epoch_us(o_orderdate) * 1000 + 1 AS t FROM orders) o
    LEFT JOIN ({_VERSIONS}) v ON o.instrument_uid = v.instrument_uid AND t >= valid_from_ns AND (valid_to_ns IS NULL OR t < valid_to_ns)""",
    ["instrument_versions"],
)
def j5_unit_inference(spark, d):
    o = V.load(spark, d, "orders").select("o_orderkey", F.concat(F.lit("I"), F.col("o_custkey") % 200).alias("instrument_uid"), (V.ns_of("o_orderdate") + 1).alias("t"))
    rows = joins.active_at(o, _versions(spark, d), ["instrument_uid"], "t", "valid_from_ns", "valid_to_ns")
    unit = F.when(F.col("terms") == "F", "base").when(F.col("terms") == "P", "quote").otherwise("provisional")
    return rows.select("o_orderkey", unit.alias("unit"))


@query(
    """SELECT native_trade_id, coalesce(string_agg(gap_id, ',' ORDER BY gap_id), '') AS gap_ids FROM (SELECT DISTINCT native_trade_id, gap_id
    FROM trades t LEFT JOIN gaps g ON t.instrument_uid = g.instrument_uid AND t.source_id = g.source_id
    AND received_time_ns >= start_ns AND received_time_ns < end_ns) GROUP BY 1""",
    ["trades", "gaps"],
)
def j6_window_annotation(spark, d):
    rows = joins.containing_windows(
        V.trades(spark, d), V.gaps(spark, d), ["source_id", "instrument_uid"], "received_time_ns", "gap_id", "ids", row_keys=["native_trade_id"]
    )
    return rows.select("native_trade_id", F.array_join("ids", ",").alias("gap_ids"))


@query(
    f"""SELECT w.epoch_id, g.gap_id FROM windows_of w JOIN gaps g ON g.source_id = w.source_id AND g.channel_id = w.channel_id
    AND g.start_ns < w.end_ns AND g.end_ns > w.start_ns WHERE list_contains(['click','view'], g.channel_id) AND w.epoch_id = '2024-01-05'""",
    ["windows_of", "gaps"],
)
def j7_dataset_references(spark, d):
    """One row per window of the date and gap that overlap; the pairs of a gap are counted and then written out."""
    families = F.array(F.lit("click"), F.lit("view"))
    w = V.windows_of(spark, d).where("epoch_id = '2024-01-05'").select("source_id", "channel_id", "epoch_id", F.col("start_ns").alias("l_start"), F.col("end_ns").alias("l_end"))
    g = V.gaps(spark, d).where(F.array_contains(families, F.col("channel_id")))
    g = g.select("source_id", "channel_id", "gap_id", F.col("start_ns").alias("r_start"), F.col("end_ns").alias("r_end"))
    found = joins.overlap_counts(w, g, ["source_id", "channel_id"]).select(F.lit("2024-01-05").alias("epoch_id"), "gap_id", "n")
    return joins.repeated(found, "n")


@query(
    """SELECT native_trade_id, coalesce(string_agg(id, ',' ORDER BY id), '') AS ids FROM trades t LEFT JOIN (SELECT source_id, gap_id AS id, start_ns, end_ns FROM gaps WHERE instrument_uid IN ('I1', 'I2')
    UNION ALL SELECT DISTINCT source_id, 'open' || epoch_id, min(received_time_ns) OVER (PARTITION BY source_id, epoch_id), NULL::BIGINT FROM trades) w
    ON w.source_id = t.source_id AND received_time_ns >= start_ns AND (end_ns IS NULL OR received_time_ns < end_ns) GROUP BY 1""",
    ["trades", "gaps"],
)
def j6_open_windows(spark, d):
    """Windows of hours and windows without an end, on one key a source."""
    rows = V.trades(spark, d)
    closed = V.gaps(spark, d).where("instrument_uid IN ('I1', 'I2')").select("source_id", F.col("gap_id").alias("id"), "start_ns", "end_ns")
    open_ = rows.groupBy("source_id", F.concat(F.lit("open"), "epoch_id").alias("id")).agg(F.min("received_time_ns").alias("start_ns"))
    windows = closed.unionByName(open_, allowMissingColumns=True)
    found = joins.containing_windows(rows, windows, ["source_id"], "received_time_ns", "id", "ids", row_keys=["native_trade_id"])
    return found.select("native_trade_id", F.array_join("ids", ",").alias("ids"))


@query(
    """SELECT l_orderkey, l_linenumber, s_name, n_name, r_name FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey JOIN orders o ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F' AND l_linestatus = 'F'
    AND EXISTS (SELECT 1 FROM customer WHERE c_custkey = o.o_custkey AND c_acctbal > 5000)"""
)
def j8_committed_segments(spark, d):
    t = lambda n: V.load(spark, d, n)
    orders = t("orders").where("o_orderstatus = 'F'").join(t("customer").where("c_acctbal > 5000"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    lines = t("lineitem").where("l_linestatus = 'F'").join(orders.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    rows = lines.join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("l_orderkey", "l_linenumber", "s_name", "n_name", "r_name")


@query("SELECT s_suppkey, s_name, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def j9_source_projection(spark, d):
    s, n, r = (V.load(spark, d, x) for x in ("supplier", "nation", "region"))
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "s_name", "n_name", "r_name")


@query("SELECT o_orderkey AS dataset_id, l_linenumber AS input_ordinal, l_partkey AS segment_id FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderdate < TIMESTAMP '1995-06-01'")
def j10_lineage(spark, d):
    o = V.load(spark, d, "orders").where("o_orderdate < TIMESTAMP_NTZ'1995-06-01 00:00:00'").select(F.col("o_orderkey").alias("dataset_id"))
    lines = V.load(spark, d, "lineitem").select(F.col("l_orderkey").alias("dataset_id"), F.col("l_linenumber").alias("input_ordinal"), F.col("l_partkey").alias("segment_id"))
    return o.join(lines, "dataset_id").orderBy("dataset_id", "input_ordinal")


@query("SELECT opportunity_id, scope FROM opportunities WHERE opportunity_id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')", ["opportunities"])
def j11_not_archived(spark, d):
    archived = V.load(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("opportunity_id"))
    return V.opportunities(spark, d).join(archived, "opportunity_id", "left_anti").select("opportunity_id", "scope")


_CANDIDATES = """SELECT opportunity_id, expected_ns, utc_date FROM opportunities WHERE outcome IS NOT NULL AND expected_ns < 900000000000000000
    AND opportunity_id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') ORDER BY expected_ns, opportunity_id LIMIT 500"""


@query(f"SELECT opportunity_id, utc_date FROM ({_CANDIDATES}) WHERE utc_date = (SELECT min(utc_date) FROM ({_CANDIDATES}))", ["opportunities"])
def j12_spill_candidates(spark, d):
    claimed = V.load(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("opportunity_id"))
    ready = V.opportunities(spark, d).where("outcome IS NOT NULL AND expected_ns < 900000000000000000").join(claimed, "opportunity_id", "left_anti")
    batch = ready.orderBy("expected_ns", "opportunity_id").limit(500)
    first = batch.agg(F.min("utc_date").alias("utc_date"))
    return batch.join(F.broadcast(first), "utc_date").select("opportunity_id", "utc_date")


@query("SELECT c_custkey, o_orderkey AS manifest_id FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P'")
def j13_optional_manifest(spark, d):
    manifests = V.load(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("manifest_id"))
    return V.load(spark, d, "customer").select("c_custkey").join(manifests, "c_custkey", "left")


@query(
    """SELECT coalesce(a.k, b.k) AS object_key, CASE WHEN size_expected IS NULL THEN 'orphan' WHEN size_found IS NULL THEN 'lost' WHEN NOT has_manifest THEN 'manifestless'
    WHEN size_found <> size_expected THEN 'unverifiable' ELSE 'commit' END AS verdict
    FROM (SELECT p_partkey AS k, p_size AS size_found FROM part WHERE p_partkey % 7 <> 0) a FULL JOIN
    (SELECT p_partkey AS k, p_size + CASE WHEN p_partkey % 11 = 0 THEN 1 ELSE 0 END AS size_expected, p_partkey % 13 <> 0 AS has_manifest FROM part WHERE p_partkey % 5 <> 0) b ON a.k = b.k"""
)
def j14_object_reconcile(spark, d):
    part = V.load(spark, d, "part").withColumnRenamed("p_partkey", "object_key")
    listed = part.where("object_key % 7 <> 0").select("object_key", F.col("p_size").alias("size_found"))
    expected = F.col("p_size") + F.when(F.col("object_key") % 11 == 0, 1).otherwise(0)
    known = part.where("object_key % 5 <> 0").select("object_key", expected.alias("size_expected"), (F.col("object_key") % 13 != 0).alias("has_manifest"))
    return joins.reconcile(listed, known, "object_key")


@query(
    """SELECT o_orderkey, a.l_partkey AS meta, a.l_suppkey AS context, pos FROM (SELECT l_orderkey AS o_orderkey, l_partkey, l_suppkey,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber) - 1 AS pos, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) a WHERE n % 3 <> 0"""
)
def j15_positional_pairs(spark, d):
    rows = V.load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_sort(F.collect_list(F.struct("l_partkey", "l_suppkey", "l_linenumber"))).alias("x"))
    short = F.when(F.size("x") % 3 == 0, F.slice("x.l_suppkey", 1, F.size("x") - 1)).otherwise(F.col("x.l_suppkey"))
    rows = rows.select("o_orderkey", F.col("x.l_partkey").alias("meta"), short.alias("context"))
    pairs = rows.select("o_orderkey", F.posexplode(joins.paired("meta", "context")).alias("pos", "p"))
    return pairs.select("o_orderkey", F.col("p.meta").alias("meta"), F.col("p.context").alias("context"), F.col("pos").cast("long").alias("pos"))


@query("SELECT event_id AS incident_id, coalesce(json_extract_string(props, '$.key'), json_extract_string(props, '$.k')) AS tuple_key FROM events")
def j16_incident_tuples(spark, d):
    body = F.from_json(F.concat(F.lit("["), "props", F.lit("]")), "array<struct<key:string,k:string>>")
    rows = V.load(spark, d, "events").select(F.col("event_id").alias("incident_id"), F.explode(body).alias("t"))
    return rows.select("incident_id", F.coalesce("t.key", "t.k").alias("tuple_key"))


@query(f"SELECT coverage_id FROM windows_of WHERE start_ns < {DAY + V.NS_PER_HOUR * 13} AND end_ns > {DAY + V.NS_PER_HOUR * 12}", ["windows_of"])
def j17_segments_of_hour(spark, d):
    from tickloom.operators.filters import overlaps

    return V.windows_of(spark, d).where(overlaps("start_ns", "end_ns", DAY + 12 * V.NS_PER_HOUR, DAY + 13 * V.NS_PER_HOUR)).select("coverage_id")


@query(
    """SELECT a.event_id AS request_id, b.event_id AS response_id FROM events a JOIN events b ON a.user_id = b.user_id AND date_trunc('day', a.ts) = date_trunc('day', b.ts)
    AND a.event_type = 'click' AND b.event_type = 'view' AND json_extract_string(a.props, '$.k') = json_extract_string(b.props, '$.k')"""
)
def j18_request_response(spark, d):
    e = V.load(spark, d, "events").select("event_id", "user_id", "event_type", F.substring(F.col("ts").cast("string"), 1, 10).alias("cycle"), F.get_json_object("props", "$.k").alias("rid"))
    asked = e.where("event_type = 'click'").withColumnRenamed("event_id", "request_id").drop("event_type")
    given = e.where("event_type = 'view'").withColumnRenamed("event_id", "response_id").drop("event_type")
    return asked.join(given, ["user_id", "cycle", "rid"]).select("request_id", "response_id")


@query("SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN 'lost' WHEN p_partkey % 11 = 0 THEN 'corrupt' ELSE 'verified' END AS state FROM part")
def j19_restore_check(spark, d):
    part = V.load(spark, d, "part").select("p_partkey", F.sha2("p_name", 256).alias("sha"))
    stored = part.where("p_partkey % 7 <> 0").withColumn("sha", F.when(F.col("p_partkey") % 11 == 0, "x").otherwise(F.col("sha")))
    return joins.restore_check(part, stored, "p_partkey", "sha")
