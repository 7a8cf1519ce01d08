"""Queries of the scalar and filter operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions import scalars as X
from tickloom.functions import shapes
from tickloom.operators import digests, filters
from tickloom.plans import views as V
from tickloom.plans.registry import query

DAY = 1_704_067_200_000_000_000
SPEC = filters.QuerySpec(DAY, DAY + filters.MOST_NS, sources=("S0", "S1"), channels=("click", "purchase", "view"), limit=200)
SPEC_SQL = f"received_time_ns >= {SPEC.start_ns} AND received_time_ns < {SPEC.end_ns} AND source_id IN ('S0','S1') AND channel_id IN ('click','purchase','view')"


@query(
    f"""SELECT source_id, channel_id, instrument_uid, native_trade_id, received_time_ns, CAST(price AS VARCHAR) AS price FROM arrivals
    WHERE {SPEC_SQL} ORDER BY source_id, instrument_uid, received_time_ns, epoch_id, arrival_ordinal LIMIT 201""",
    ["arrivals"],
)
def f1_bounded_query(spark, d):
    rows = filters.bounded_query(V.arrivals(spark, d), SPEC)
    return filters.decimals_as_text(rows.select("source_id", "channel_id", "instrument_uid", "native_trade_id", "received_time_ns", "price"))


@query(f"SELECT count(*) AS n FROM arrivals WHERE NOT ({SPEC_SQL})", ["arrivals"])
def f3_result_guard(spark, d):
    return filters.escapes(V.arrivals(spark, d), SPEC).agg(F.count("*").alias("n"))


@query("SELECT native_trade_id, CAST(price AS VARCHAR) AS price, CAST(amount AS VARCHAR) AS amount FROM trades", ["trades"])
def f4_decimals_as_text(spark, d):
    return filters.decimals_as_text(V.trades(spark, d).select("native_trade_id", "price", "amount"))


@query(f"SELECT coverage_id FROM windows_of WHERE start_ns < {DAY + V.NS_PER_HOUR * 30} AND end_ns > {DAY + V.NS_PER_HOUR * 20}", ["windows_of"])
def f5_overlap(spark, d):
    return V.windows_of(spark, d).where(filters.overlaps("start_ns", "end_ns", DAY + V.NS_PER_HOUR * 20, DAY + V.NS_PER_HOUR * 30)).select("coverage_id")


@query(
    f"""SELECT a.native_trade_id FROM arrivals a JOIN (SELECT source_id, epoch_id, min(received_time_ns) AS s, max(received_time_ns) + 1 AS e
    FROM arrivals GROUP BY ALL) g USING (source_id, epoch_id) WHERE s < {DAY + 2 * V.NS_PER_DAY} AND e > {DAY + V.NS_PER_DAY}
    AND received_time_ns >= {DAY + V.NS_PER_DAY} AND received_time_ns < {DAY + 2 * V.NS_PER_DAY}""",
    ["arrivals"],
)
def f6_native_replay(spark, d):
    rows = V.arrivals(spark, d)
    segments = rows.groupBy("source_id", "epoch_id").agg(F.min("received_time_ns").alias("s"), (F.max("received_time_ns") + 1).alias("e"))
    a, b = DAY + V.NS_PER_DAY, DAY + 2 * V.NS_PER_DAY
    chosen = segments.where(filters.overlaps("s", "e", a, b)).select("source_id", "epoch_id")
    return rows.where(F.col("received_time_ns").between(a, b - 1)).join(chosen, ["source_id", "epoch_id"], "left_semi").select("native_trade_id")


@query(
    """SELECT o_orderkey AS dataset_id FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'""",
)
def f7_committed(spark, d):
    rows = V.load(spark, d, "orders").select(
        F.col("o_orderkey").alias("dataset_id"),
        F.when(F.col("o_orderstatus") == "F", "committed").otherwise("open").alias("state"),
        F.when(F.col("o_orderpriority") != "5-LOW", V.ns_of("o_orderdate")).alias("committed_at"),
    )
    return filters.committed(rows).select("dataset_id")


@query(
    """SELECT native_trade_id, CASE WHEN price > 0 THEN '' ELSE 'price' END || CASE WHEN amount > 0 THEN '' ELSE 'amount' END AS broken FROM trades""",
    ["trades"],
)
def f8_trade_contract(spark, d):
    rows = V.trades(spark, d).withColumn("side", X.aggressor_side(F.col("buyer_is_maker")))
    return filters.with_violations(rows, "trade").select("native_trade_id", F.array_join("violations", "").alias("broken"))


@query(
    """SELECT instrument_uid, event_id, CASE WHEN bool_and(price > 0 AND amount >= 0 AND (action = 'delete') = (amount = 0))
    THEN '' ELSE 'levels' END AS broken FROM book_levels GROUP BY ALL""",
    ["book_levels"],
)
def f8_book_contract(spark, d):
    levels = F.collect_list(F.struct("price", "amount", "action")).alias("levels")
    rows = V.book_levels(spark, d).groupBy("instrument_uid", "event_id", "received_time_ns").agg(levels, F.count("*").alias("last_sequence"))
    rows = rows.withColumns({"first_sequence": F.lit(1), "update_kind": F.lit("delta"), "source_id": F.lit("S")})
    return filters.with_violations(rows, "book_update").select("instrument_uid", "event_id", F.array_join("violations", "").alias("broken"))


@query(
    """SELECT p_brand, count(DISTINCT p_partkey) FILTER (p_size <= 25) AS absent, count(DISTINCT p_partkey) FILTER (p_size > 40) AS extra FROM part GROUP BY p_brand""",
)
def f9_symbol_scope(spark, d):
    pick = lambda c: F.collect_set(F.when(c, F.col("p_partkey")))
    sets = V.load(spark, d, "part").groupBy("p_brand").agg(pick(F.col("p_size") <= 40).alias("asked"), pick(F.col("p_size") > 25).alias("given"))
    sets = sets.withColumn("x", filters.scope_difference(F.col("asked"), F.col("given")))
    return sets.select("p_brand", F.size("x.absent").cast("long").alias("absent"), F.size("x.extra").cast("long").alias("extra"))


# ---- scalars --------------------------------------------------------------------------------------------


@query(
    """SELECT native_trade_id, CASE WHEN regexp_full_match(p, '-?[0-9]+(\\.[0-9]{1,18})?') THEN CAST(CAST(p AS DECIMAL(38,18)) AS VARCHAR) END AS price
    FROM (SELECT native_trade_id, json_extract_string(payload, '$.p') AS p FROM raw_json)""",
    ["raw_json"],
)
def x1_strict_decimal(spark, d):
    text = F.get_json_object("payload", "$.p")
    return V.raw_json(spark, d).select("native_trade_id", X.decimal_text(X.strict_decimal(text)).alias("price"))


@query("SELECT instrument_uid, CAST(sum(price) AS VARCHAR) AS total FROM trades GROUP BY 1", ["trades"])
def x2_decimal_text(spark, d):
    return V.trades(spark, d).groupBy("instrument_uid").agg(X.decimal_text(F.sum("price")).alias("total"))


@query(
    """SELECT native_trade_id, CASE native_trade_id % 13 WHEN 1 THEN 'missing' WHEN 2 THEN 'null' WHEN 3 THEN 'empty' ELSE 'value' END AS state FROM raw_json""",
    ["raw_json"],
)
def x3_json_state(spark, d):
    return V.raw_json(spark, d).select("native_trade_id", X.json_state(F.col("payload"), "p").alias("state"))


@query()
def x4_structural_fingerprint(spark, d):
    rows = V.raw_json(spark, d).select(shapes.structural_fingerprint("payload").alias("fingerprint"))
    return rows.groupBy("fingerprint").agg(F.count("*").alias("n"))


_ID_SQL = "sha256(concat_ws('|', strlen(source_id) || ':' || source_id, strlen(channel_id) || ':' || channel_id, strlen(native_trade_id::VARCHAR) || ':' || native_trade_id))"


@query(f"SELECT native_trade_id, {_ID_SQL} AS event_id FROM trades", ["trades"])
def x5_event_id(spark, d):
    return V.trades(spark, d).select("native_trade_id", X.digest(F.col("source_id"), F.col("channel_id"), F.col("native_trade_id")).alias("event_id"))


_TRADE_COLUMNS = (
    "amount", "buyer_is_maker", "channel_id", "epoch_id", "exchange_time_ns", "instrument_uid", "native_trade_id", "price", "received_time_ns", "source_id",
)


def _hash_sql(columns):
    """SHA-256 over names and values, each behind its length, as digests.row_hash does."""
    part = lambda c: f"'{len(c)}:{c}', coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    return f"sha256(concat_ws('|', {', '.join(map(part, columns))}))"


@query(f"SELECT native_trade_id, {_hash_sql(_TRADE_COLUMNS)} AS logical_hash FROM trades", ["trades"])
def x6_row_hash(spark, d):
    rows = V.trades(spark, d)
    return rows.select("native_trade_id", digests.row_hash(rows).alias("logical_hash"))


@query(f"SELECT native_trade_id, {_hash_sql(_TRADE_COLUMNS)} AS semantic_hash FROM trades", ["trades"])
def x7_semantic_hash(spark, d):
    rows = V.trades(spark, d).withColumn("mapper_version", F.lit("v1"))
    return rows.select("native_trade_id", digests.row_hash(rows, ["mapper_version"]).alias("semantic_hash"))


@query(
    "SELECT event_id, level_ordinal, sha256(concat_ws('|', strlen(event_id::VARCHAR) || ':' || event_id, strlen(level_ordinal::VARCHAR) || ':' || level_ordinal)) AS row_id FROM book_levels",
    ["book_levels"],
)
def x8_row_id(spark, d):
    return V.book_levels(spark, d).select("event_id", "level_ordinal", X.digest(F.col("event_id"), F.col("level_ordinal")).alias("row_id"))


def multiset_sql(rows, by, columns):
    """digests.multiset_digest of some columns of ``rows`` in SQL."""
    return digests.digest_sql(f"SELECT {by}, {_hash_sql(columns)} AS h FROM {rows}", by)


_OF_SOURCE = [c for c in _TRADE_COLUMNS if c != "source_id"]


@query(multiset_sql("trades", "source_id", _OF_SOURCE), ["trades"])
def x9_multiset_digest(spark, d):
    return digests.multiset_digest(V.trades(spark, d), ["source_id"])


@query(
    multiset_sql("(SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY received_time_ns, native_trade_id) AS position FROM trades)", "source_id", sorted([*_OF_SOURCE, "position"])),
    ["trades"],
)
def x9_ordered_digest(spark, d):
    return digests.ordered_digest(V.trades(spark, d), ["received_time_ns", "native_trade_id"], ["source_id"])


@query(
    f"""SELECT source_id, h AS row_hash, count(*) FILTER (s = 'a') AS n_a, count(*) FILTER (s = 'b') AS n_b FROM (SELECT source_id, 'a' AS s, {_hash_sql(_OF_SOURCE)} AS h FROM trades UNION ALL
    SELECT source_id, 'b', {_hash_sql(_OF_SOURCE)} FROM (SELECT * REPLACE (CASE WHEN native_trade_id % 211 = 0 THEN price + 1 ELSE price END AS price) FROM trades WHERE native_trade_id % 307 <> 0)) GROUP BY ALL HAVING n_a <> n_b""",
    ["trades"],
)
def x9_differing_rows(spark, d):
    """Rows in which a second run differs: some prices, and some rows are missing."""
    rows = V.trades(spark, d)
    price = F.when(F.col("native_trade_id") % 211 == 0, (F.col("price") + 1).cast("decimal(38,18)")).otherwise(F.col("price"))
    other = rows.where("native_trade_id % 307 <> 0").withColumn("price", price)
    return digests.differences(rows, other, ["source_id"]).select("source_id", "row_hash", "n_a", "n_b")


@query(
    """SELECT native_trade_id, '{"channel":"' || channel_id || '","source":"' || source_id || '"}' AS canonical FROM trades""", ["trades"]
)
def x10_flat_json(spark, d):
    return V.trades(spark, d).select("native_trade_id", X.flat_json(source=F.col("source_id"), channel=F.col("channel_id")).alias("canonical"))


@query()
def x10_canonical_json(spark, d):
    return V.raw_json(spark, d).select("native_trade_id", shapes.canonical_json("payload").alias("canonical"))


@query("SELECT native_trade_id, received_time_ns // 1000000 * 1000000 AS ns, CASE WHEN native_trade_id % 2 = 0 THEN native_trade_id * 1000000000 END AS guarded FROM trades", ["trades"])
def x11_native_time(spark, d):
    big = F.when(F.col("native_trade_id") % 2 == 0, F.col("native_trade_id")).otherwise(F.lit(X.INT64_MAX))
    ms = F.expr("received_time_ns div 1000000")
    return V.trades(spark, d).select("native_trade_id", X.native_to_ns(ms, "ms").alias("ns"), X.native_to_ns(big, "s").alias("guarded"))


@query(
    """SELECT native_trade_id, CAST(CAST(price * 100 AS BIGINT) * CAST(amount * 100 AS BIGINT) AS BIGINT) AS product_e4,
    CASE WHEN amount <> 0 AND (CAST(price * 100 AS BIGINT) * 1000000) % CAST(amount * 100 AS BIGINT) = 0
    THEN CAST(price * 100 AS BIGINT) * 1000000 // CAST(amount * 100 AS BIGINT) END AS quotient_e6 FROM trades""",
    ["trades"],
)
def x12_exact_arithmetic(spark, d):
    p, a = F.col("price"), F.col("amount")
    return V.trades(spark, d).select(
        "native_trade_id",
        (X.exact_multiply(p, a) * 10000).cast("long").alias("product_e4"),
        (X.exact_divide(p, a) * 1000000).cast("long").alias("quotient_e6"),
    )


@query()
def x12_wide_arithmetic(spark, d):
    t = V.trades(spark, d)
    return t.select("native_trade_id", shapes.wide_multiply("price", "amount").alias("product"), shapes.wide_divide("price", "amount").alias("quotient"))


@query()
def x13_book_checksum(spark, d):
    level = F.concat_ws(":", F.col("price").cast("decimal(18,2)").cast("string"), F.col("amount").cast("decimal(18,2)").cast("string"))
    side = lambda s: F.collect_list(F.when(F.col("side") == s, F.struct("price", level.alias("t"))))
    books = V.book_levels(spark, d).groupBy("event_id").agg(F.reverse(F.array_sort(side("buy"))).alias("b"), F.array_sort(side("sell")).alias("a"))
    return books.select("event_id", X.book_checksum(F.col("b.t"), F.col("a.t")).alias("checksum"))


@query("SELECT native_trade_id, epoch_id AS utc_date, (received_time_ns // 3600000000000 % 24)::INTEGER AS utc_hour, substr(epoch_id, 1, 7) AS utc_month FROM trades", ["trades"])
def x14_utc_parts(spark, d):
    ns = F.col("received_time_ns")
    day = X.ns_date(ns).cast("string")
    return V.trades(spark, d).select("native_trade_id", day.alias("utc_date"), X.ns_hour(ns).alias("utc_hour"), F.substring(day, 1, 7).alias("utc_month"))


@query(
    """SELECT native_trade_id, substr(h,1,8)||'-'||substr(h,9,4)||'-'||substr(h,13,4)||'-'||substr(h,17,4)||'-'||substr(h,21,12) AS id FROM
    (SELECT native_trade_id, sha256('5:trade|' || strlen(native_trade_id::VARCHAR) || ':' || native_trade_id) AS h FROM trades)""",
    ["trades"],
)
def x15_uuid(spark, d):
    return V.trades(spark, d).select("native_trade_id", X.uuid_of("trade", F.col("native_trade_id")).alias("id"))


@query(
    """SELECT native_trade_id, CASE native_trade_id % 3 WHEN 0 THEN 'clock_uncertain,source_duplicate_candidate' WHEN 1 THEN 'source_duplicate_candidate' END AS flags FROM trades""",
    ["trades"],
)
def x16_quality_flags(spark, d):
    k = F.col("native_trade_id") % 3
    given = F.when(k == 0, F.array(F.lit("source_duplicate_candidate"), F.lit("clock_uncertain"), F.lit("source_duplicate_candidate"))).when(k == 1, F.array(F.lit("source_duplicate_candidate"))).otherwise(F.array(F.lit("odd")))
    return V.trades(spark, d).select("native_trade_id", F.array_join(X.quality_flags(given), ",").alias("flags"))


@query("SELECT p_partkey, p_size % 3 = 0 AND p_size % 2 = 1 AS agrees FROM part")
def x17_unit_agreement(spark, d):
    k = F.col("p_size")
    kind = F.when(k % 3 == 0, "quote_per_base").otherwise("base")
    base, quote = F.lit("B"), F.when(k % 2 == 1, "Q")
    return V.load(spark, d, "part").select("p_partkey", X.unit_agrees(kind, base, quote, "quote_per_base").alias("agrees"))


@query("SELECT native_trade_id, received_time_ns - exchange_time_ns AS age_ns FROM trades", ["trades"])
def x18_field_age(spark, d):
    return V.trades(spark, d).select("native_trade_id", X.field_age(F.col("received_time_ns"), F.col("exchange_time_ns")).alias("age_ns"))


@query(
    """SELECT native_trade_id, CASE WHEN (s IS NULL) <> (e IS NULL) OR coalesce(e - s <> d, false) THEN false WHEN c = 'complete' THEN w = 'all_observed' AND d = 0 AND NOT per
    WHEN c = 'largest_in_window' THEN w = 'largest_per_symbol' AND d > 0 AND per ELSE true END AS fits FROM
    (SELECT native_trade_id, ['complete', 'largest_in_window', 'partial_nonchronological', 'trade_flag_only'][native_trade_id % 4 + 1] AS c,
    ['all_observed', 'largest_per_symbol', 'unknown'][native_trade_id % 3 + 1] AS w, CASE WHEN native_trade_id % 7 > 1 THEN exchange_time_ns END AS s,
    CASE WHEN native_trade_id % 7 > 0 THEN received_time_ns END AS e, native_trade_id % 11 < 5 AS per,
    CASE WHEN native_trade_id % 5 = 0 THEN 0 ELSE received_time_ns - exchange_time_ns END AS d FROM trades)""",
    ["trades"],
)
def x19_liquidation_completeness(spark, d):
    k = F.col("native_trade_id")
    pick = lambda values: F.element_at(F.array(*map(F.lit, values)), (k % len(values) + 1).cast("int"))
    start, end = F.when(k % 7 > 1, F.col("exchange_time_ns")), F.when(k % 7 > 0, F.col("received_time_ns"))
    duration = F.when(k % 5 == 0, 0).otherwise(F.col("received_time_ns") - F.col("exchange_time_ns"))
    fits = X.liquidation_window_fits(pick(X.LIQUIDATION_COMPLETENESS), pick(X.WINDOW_SELECTIONS), start, end, duration, k % 11 < 5)
    return V.trades(spark, d).select("native_trade_id", fits.alias("fits"))


@query("SELECT opportunity_id, opportunity_id % 3 < 2 AND opportunity_id % 5 <> 0 AS eligible FROM opportunities", ["opportunities"])
def x20_eligibility(spark, d):
    k = F.col("opportunity_id")
    kind = F.element_at(F.array(F.lit("deterministic"), F.lit("request_bound"), F.lit("stochastic")), (k % 3 + 1).cast("int"))
    return V.opportunities(spark, d).select("opportunity_id", X.has_denominator(kind, k % 5 == 0).alias("eligible"))


@query("SELECT doc_id, NOT regexp_matches(text, '[\\x00-\\x1f\\x7f]') AND strlen(text) BETWEEN 1 AND 500 AS valid FROM documents")
def x21_valid_text(spark, d):
    return V.load(spark, d, "documents").select("doc_id", X.valid_text(F.col("text"), 500).alias("valid"))
