"""The input tables recast as market data, once as Spark frames and once as DuckDB common tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators.windows import number_arrivals

NS_PER_HOUR = 3_600_000_000_000
NS_PER_DAY = 24 * NS_PER_HOUR


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ns_of(ts: str) -> F.Column:
    """Epoch nanoseconds of a zone-free timestamp column; no session time zone takes part."""
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', cast({ts} AS timestamp_ntz)) * 1000")


def trades(spark: SparkSession, d: str) -> DataFrame:
    wide = "decimal(38,18)"
    return load(spark, d, "events").select(
        F.concat(F.lit("S"), F.col("user_id") % 3).alias("source_id"),
        F.col("event_type").alias("channel_id"),
        F.concat(F.lit("I"), F.col("user_id")).alias("instrument_uid"),
        F.col("event_id").alias("native_trade_id"),
        ns_of("ts").alias("received_time_ns"),
        (ns_of("ts") - F.col("event_id") % 1000 * 1_000_000).alias("exchange_time_ns"),
        F.substring(F.col("ts").cast("string"), 1, 10).alias("epoch_id"),
        F.col("value").cast("decimal(18,2)").cast(wide).alias("price"),
        F.get_json_object("props", "$.k").cast("decimal(18,2)").cast(wide).alias("amount"),
        (F.col("event_id") % 2 == 0).alias("buyer_is_maker"),
    )


def arrivals(spark: SparkSession, d: str) -> DataFrame:
    return number_arrivals(trades(spark, d), ["source_id", "epoch_id"], ["received_time_ns", "native_trade_id"])


def arrivals_gapped(spark: SparkSession, d: str) -> DataFrame:
    kept = arrivals(spark, d).where("native_trade_id % 17 <> 0")
    return kept.unionByName(kept.where("native_trade_id % 41 = 0"))


def windows_of(spark: SparkSession, d: str) -> DataFrame:
    """Coverage per channel, instrument and day: [first, last + 1 ns)."""
    return (
        trades(spark, d)
        .groupBy("source_id", "channel_id", "instrument_uid", "epoch_id")
        .agg(F.min("received_time_ns").alias("start_ns"), (F.max("received_time_ns") + 1).alias("end_ns"))
        .withColumn("coverage_id", F.concat_ws("/", "channel_id", "instrument_uid", "epoch_id"))
    )


def gaps(spark: SparkSession, d: str) -> DataFrame:
    """Silences of more than six hours per channel and instrument."""
    w = Window.partitionBy("source_id", "channel_id", "instrument_uid").orderBy("received_time_ns", "native_trade_id")
    rows = trades(spark, d).withColumn("next_ns", F.lead("received_time_ns").over(w))
    return rows.where(F.col("next_ns") - F.col("received_time_ns") > 6 * NS_PER_HOUR).select(
        "source_id",
        "channel_id",
        "instrument_uid",
        (F.col("received_time_ns") + 1).alias("start_ns"),
        F.col("next_ns").alias("end_ns"),
        F.concat_ws("/", "channel_id", "instrument_uid", "native_trade_id").alias("gap_id"),
    )


def bindings(spark: SparkSession, d: str) -> DataFrame:
    """Two mapper versions per channel, the second from the middle of the month on."""
    middle = F.lit(1_705_276_800_000_000_000)
    channels = load(spark, d, "events").select(F.col("event_type").alias("channel_id")).distinct()
    first = channels.select("channel_id", F.lit("v1").alias("mapper_version"), F.lit(0).cast("long").alias("valid_from_ns"), middle.alias("valid_to_ns"))
    second = channels.select("channel_id", F.lit("v2").alias("mapper_version"), middle.alias("valid_from_ns"), F.lit(None).cast("long").alias("valid_to_ns"))
    return first.unionByName(second)


def book_levels(spark: SparkSession, d: str) -> DataFrame:
    """One row per level: the lines of an order are the levels of one book event of an instrument."""
    lines = load(spark, d, "lineitem")
    heads = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    short = lambda c: F.col(c).cast("decimal(18,2)")
    gone = F.col("l_discount") == 0
    rows = lines.select(
        "l_orderkey",
        F.col("l_linenumber").cast("long").alias("level_ordinal"),
        short("l_extendedprice").alias("price"),
        F.when(gone, F.lit(0).cast("decimal(18,2)")).otherwise(short("l_quantity")).alias("amount"),
        F.when(gone, "delete").otherwise("upsert").alias("action"),
    )
    # lines may repeat a line number within an order; the first by price and amount stands. They are dealt by order, which
    # serves the window, the join and groupings by event
    w = Window.partitionBy("l_orderkey", "level_ordinal").orderBy("price", "amount")
    rows = rows.repartition("l_orderkey").withColumn("n", F.row_number().over(w)).where("n = 1").join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        F.concat(F.lit("I"), F.col("o_custkey") % 50).alias("instrument_uid"),
        F.col("o_orderkey").alias("event_id"),
        ns_of("o_orderdate").alias("received_time_ns"),
        F.when(F.col("level_ordinal") % 2 == 0, "buy").otherwise("sell").alias("side"),
        "level_ordinal",
        F.col("price").cast("decimal(38,18)").alias("price"),
        F.col("amount").cast("decimal(38,18)").alias("amount"),
        "action",
    )


def book_events(spark: SparkSession, d: str, *more: F.Column) -> DataFrame:
    """One row per book event, with the running level count of its instrument as sequence range.

    ``more`` are aggregates over an event's levels, so that who needs the levels too doesn't make them again.
    """
    w = Window.partitionBy("instrument_uid").orderBy("received_time_ns", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    events = book_levels(spark, d).groupBy("instrument_uid", "event_id", "received_time_ns").agg(F.count("*").alias("levels"), *more)
    return events.withColumn("last_sequence", F.sum("levels").over(w)).withColumn(
        "first_sequence", F.col("last_sequence") - F.col("levels") + 1
    )


def instrument_versions(spark: SparkSession, d: str) -> DataFrame:
    """Observations of an instrument's state and terms over time, one per instrument and day."""
    rows = load(spark, d, "orders").groupBy((F.col("o_custkey") % 200).alias("k"), ns_of("o_orderdate").alias("observed_ns"))
    return rows.agg(F.min("o_orderpriority").alias("state"), F.max("o_orderstatus").alias("terms")).select(
        F.concat(F.lit("I"), F.col("k")).alias("instrument_uid"), "observed_ns", "state", "terms"
    )


def opportunities(spark: SparkSession, d: str) -> DataFrame:
    """Expected events: orders; status O is still open."""
    outcome = F.when(F.col("o_orderstatus") == "F", "observed").when(F.col("o_orderstatus") == "P", "missed")
    return load(spark, d, "orders").select(
        F.col("o_orderkey").alias("opportunity_id"),
        F.concat(F.lit("scope"), F.col("o_custkey") % 20).alias("scope"),
        ns_of("o_orderdate").alias("expected_ns"),
        outcome.alias("outcome"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("utc_date"),
    )


def raw_json(spark: SparkSession, d: str) -> DataFrame:
    """Spot trade messages as JSON text; the id mod 13 decides which field is broken, if any."""
    t = trades(spark, d)
    case = F.col("native_trade_id") % 13
    p = (
        F.when(case == 1, F.lit(None).cast("string"))
        .when(case == 2, F.lit("null"))
        .when(case == 3, F.lit('""'))
        .when(case == 4, F.lit('"1.0000000000000000001"'))
        .when(case == 5, F.lit('"1e3"'))
        .otherwise(F.concat(F.lit('"'), F.col("price").cast("decimal(18,2)").cast("string"), F.lit('"')))
    )
    ms = F.expr("received_time_ns div 1000000")
    parts = F.concat_ws(
        ",",
        F.lit('"e":"trade"'),
        F.concat(F.lit('"E":'), ms),
        F.concat(F.lit('"s":"'), "instrument_uid", F.lit('"')),
        F.concat(F.lit('"t":'), "native_trade_id"),
        F.when(p.isNotNull(), F.concat(F.lit('"p":'), p)),
        F.concat(F.lit('"q":"'), F.col("amount").cast("decimal(18,2)").cast("string"), F.lit('"')),
        F.concat(F.lit('"T":'), ms),
        F.concat(F.lit('"m":'), F.col("buyer_is_maker").cast("string")),
        F.lit('"M":true'),
        F.when(case == 6, F.lit('"z":1')),
    )
    return t.select(
        "source_id", "channel_id", "epoch_id", "native_trade_id", "received_time_ns", F.concat(F.lit("{"), parts, F.lit("}")).alias("payload")
    )


#: name: (views it reads, DuckDB text)
SQL: dict[str, tuple[tuple[str, ...], str]] = {
    "trades": (
        (),
        """SELECT 'S' || (user_id % 3) AS source_id, event_type AS channel_id, 'I' || user_id AS instrument_uid,
        event_id AS native_trade_id, epoch_us(ts) * 1000 AS received_time_ns,
        epoch_us(ts) * 1000 - event_id % 1000 * 1000000 AS exchange_time_ns, strftime(ts, '%Y-%m-%d') AS epoch_id,
        CAST(CAST(value AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS price,
        CAST(CAST(json_extract_string(props, '$.k') AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS amount,
        event_id % 2 = 0 AS buyer_is_maker FROM events""",
    ),
    "arrivals": (
        ("trades",),
        "SELECT *, row_number() OVER (PARTITION BY source_id, epoch_id ORDER BY received_time_ns, native_trade_id) AS arrival_ordinal FROM trades",
    ),
    "arrivals_gapped": (
        ("arrivals",),
        """SELECT * FROM arrivals WHERE native_trade_id % 17 <> 0
        UNION ALL SELECT * FROM arrivals WHERE native_trade_id % 17 <> 0 AND native_trade_id % 41 = 0""",
    ),
    "windows_of": (
        ("trades",),
        """SELECT source_id, channel_id, instrument_uid, epoch_id, min(received_time_ns) AS start_ns,
        max(received_time_ns) + 1 AS end_ns, channel_id || '/' || instrument_uid || '/' || epoch_id AS coverage_id
        FROM trades GROUP BY ALL""",
    ),
    "gaps": (
        ("trades",),
        """SELECT source_id, channel_id, instrument_uid, received_time_ns + 1 AS start_ns, next_ns AS end_ns,
        channel_id || '/' || instrument_uid || '/' || native_trade_id AS gap_id FROM (SELECT *, lead(received_time_ns) OVER
        (PARTITION BY source_id, channel_id, instrument_uid ORDER BY received_time_ns, native_trade_id) AS next_ns FROM trades)
        WHERE next_ns - received_time_ns > 21600000000000""",
    ),
    "bindings": (
        (),
        """SELECT DISTINCT event_type AS channel_id, 'v1' AS mapper_version, 0::BIGINT AS valid_from_ns,
        1705276800000000000::BIGINT AS valid_to_ns FROM events
        UNION ALL SELECT DISTINCT event_type, 'v2', 1705276800000000000::BIGINT, NULL::BIGINT FROM events""",
    ),
    "book_levels": (
        (),
        """SELECT 'I' || (o_custkey % 50) AS instrument_uid, o_orderkey AS event_id, epoch_us(o_orderdate) * 1000 AS received_time_ns,
        CASE WHEN l_linenumber % 2 = 0 THEN 'buy' ELSE 'sell' END AS side, l_linenumber::BIGINT AS level_ordinal,
        CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS price,
        CASE WHEN l_discount = 0 THEN CAST(0 AS DECIMAL(38,18)) ELSE CAST(CAST(l_quantity AS DECIMAL(18,2)) AS DECIMAL(38,18)) END AS amount,
        CASE WHEN l_discount = 0 THEN 'delete' ELSE 'upsert' END AS action
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        QUALIFY row_number() OVER (PARTITION BY event_id, level_ordinal ORDER BY price, amount) = 1""",
    ),
    "book_events": (
        ("book_levels",),
        """SELECT *, last_sequence - levels + 1 AS first_sequence FROM (SELECT *, sum(levels) OVER (PARTITION BY instrument_uid
        ORDER BY received_time_ns, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS last_sequence FROM
        (SELECT instrument_uid, event_id, received_time_ns, count(*) AS levels FROM book_levels GROUP BY ALL))""",
    ),
    "instrument_versions": (
        (),
        """SELECT 'I' || (o_custkey % 200) AS instrument_uid, epoch_us(o_orderdate) * 1000 AS observed_ns,
        min(o_orderpriority) AS state, max(o_orderstatus) AS terms FROM orders GROUP BY ALL""",
    ),
    "opportunities": (
        (),
        """SELECT o_orderkey AS opportunity_id, 'scope' || (o_custkey % 20) AS scope, epoch_us(o_orderdate) * 1000 AS expected_ns,
        CASE o_orderstatus WHEN 'F' THEN 'observed' WHEN 'P' THEN 'missed' END AS outcome,
        strftime(o_orderdate, '%Y-%m-%d') AS utc_date FROM orders""",
    ),
    "raw_json": (
        ("trades",),
        """SELECT source_id, channel_id, epoch_id, native_trade_id, received_time_ns, '{' || concat_ws(',', '"e":"trade"',
        '"E":' || (received_time_ns // 1000000), '"s":"' || instrument_uid || '"', '"t":' || native_trade_id,
        CASE native_trade_id % 13 WHEN 1 THEN NULL WHEN 2 THEN '"p":null' WHEN 3 THEN '"p":""'
        WHEN 4 THEN '"p":"1.0000000000000000001"' WHEN 5 THEN '"p":"1e3"'
        ELSE '"p":"' || CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR) || '"' END,
        '"q":"' || CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) || '"', '"T":' || (received_time_ns // 1000000),
        '"m":' || CAST(buyer_is_maker AS VARCHAR), '"M":true', CASE WHEN native_trade_id % 13 = 6 THEN '"z":1' END) || '}' AS payload
        FROM trades""",
    ),
}


def with_views(sql: str, views: Iterable[str]) -> str:
    """``sql`` behind the common tables of ``views`` and of what they read."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in SQL[name][0]:
            need(other)
        if name not in order:
            order.append(name)

    for name in views:
        need(name)
    tables = ", ".join(f"{n} AS ({SQL[n][1]})" for n in order)
    if not tables:
        return sql
    return f"WITH {tables}, {sql[5:]}" if sql.startswith("WITH ") else f"WITH {tables} {sql}"
