"""Checks before a release or an archive counts: telemetry rollup, rebuild evidence, load gates, declarations, archives."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.aggs import evidence
from tickloom.operators.digests import multiset_digest
from tickloom.operators.windows import lifecycle_faults, null_safe_join, overlapping

# What a dataset's rebuild is compared by, and the multiples of the observed peak that a release must bear.
REBUILD_KEYS = ("load_generation_id", "family", "catalog_snapshot_id", "schema_name", "schema_version", "source_id", "channel_id", "instrument_uid")
REBUILD_DECIMALS = (
    "price", "amount", "bid_price", "bid_amount", "ask_price", "ask_amount", "price_change", "price_change_percent", "weighted_average_price",
    "first_trade_before_window_price", "last_price", "last_amount", "native_best_bid_price", "native_best_bid_amount", "native_best_ask_price",
    "native_best_ask_amount", "open_price", "high_price", "low_price", "base_volume", "quote_volume",
)
SUSTAINED_TIMES, SUSTAINED_S, BURST_TIMES, BURST_S = 2, 3600, 5, 30


def telemetry(samples: DataFrame) -> DataFrame:
    """(name, value) of samples (name, type, value, observations, total): one value for each counter and gauge, the sum over
    its label sets; ``<name>_count`` and ``<name>_sum`` for each histogram. Other types are refused as ``<name>_unsupported``."""
    rows = samples.groupBy("name", "type").agg(F.sum("value").alias("v"), F.sum("observations").alias("c"), F.sum("total").alias("s"))
    one = lambda suffix, c: F.struct(F.concat("name", F.lit(suffix)).alias("name"), F.col(c).cast("decimal(38,18)").alias("value"))
    plain, histogram = F.array(one("", "v")), F.array(one("_count", "c"), one("_sum", "s"))
    unsupported = F.array(F.struct(F.concat("name", F.lit("_unsupported")).alias("name"), F.lit(None).cast("decimal(38,18)").alias("value")))
    return rows.select(F.inline(F.when(F.col("type").isin("counter", "gauge"), plain).when(F.col("type") == "histogram", histogram).otherwise(unsupported)))


def rebuild_evidence(rows: DataFrame, decimals: Sequence[str] = REBUILD_DECIMALS) -> DataFrame:
    """Evidence of a dataset by all eight keys: counts, bounds, count and exact sum of each decimal, digest of the rows.

    Columns that the family doesn't have count as null. The digest is the multiset digest of whole rows of a key.
    """
    lacking = {c: F.lit(None).cast("decimal(38,18)") for c in decimals if c not in rows.columns}
    sums = evidence(rows.withColumns(lacking), REBUILD_KEYS, "received_time_ns", decimals)
    return null_safe_join(sums, multiset_digest(rows, REBUILD_KEYS).drop("n"), REBUILD_KEYS)


def rebuild_faults(before: DataFrame, after: DataFrame, decimals: Sequence[str] = REBUILD_DECIMALS) -> DataFrame:
    """(keys..., fault): the first thing in which two rebuilds of a key differ, or absent or unlisted."""
    names = ["n", "first_ns", "last_ns", *(f"{k}_{c}" for c in decimals for k in ("n", "sum")), "digest"]
    side = lambda df, s: rebuild_evidence(df, decimals).select(*REBUILD_KEYS, F.struct(*names).alias(s))
    both = side(before, "b").unionByName(side(after, "a"), allowMissingColumns=True)
    both = both.groupBy(*REBUILD_KEYS).agg(F.max("b").alias("b"), F.max("a").alias("a"))
    fault = F.when(F.col("a").isNull(), "absent").when(F.col("b").isNull(), "unlisted")
    for c in names:
        fault = fault.when(~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")), c)
    return both.select(*REBUILD_KEYS, fault.alias("fault")).where("fault IS NOT NULL")


def peak_rates(df: DataFrame, by: Sequence[str], time: str, size: Column, seconds: int) -> DataFrame:
    """(by..., messages, bytes): the most of each in any tumbling span of ``seconds``."""
    span = F.call_function("div", F.col(time), F.lit(seconds * 1_000_000_000))
    each = df.groupBy(*by, span.alias("__span")).agg(F.count("*").alias("__n"), F.sum(size).alias("__b"))
    return each.groupBy(*by).agg(F.max("__n").alias("messages"), F.max("__b").alias("bytes"))


def load_gate(observed: DataFrame, run: DataFrame, by: Sequence[str], time: str, size: Column, expected: DataFrame) -> DataFrame:
    """(by..., duration, sustained, burst, accounted, verdict) of a load run against what was observed before.

    Sustained: over its whole length, an hour at least, the run has twice the messages and bytes per second of the busiest
    observed second. Burst: in some 30 s it has five times as many. Accounted: as many records as ``expected`` says
    (by..., expected). A run fails if any of the four is false; a source without a run fails.
    """
    peak = peak_rates(observed, by, time, size, 1).withColumnsRenamed({"messages": "__pm", "bytes": "__pb"})
    burst = peak_rates(run, by, time, size, BURST_S).withColumnsRenamed({"messages": "__bm", "bytes": "__bb"})
    whole = run.groupBy(*by).agg(F.count("*").alias("__n"), F.sum(size).alias("__b"), (F.max(time) - F.min(time)).alias("__ns"))
    rows = reduce(lambda a, b: null_safe_join(a, b, by), (whole, burst, expected), peak)
    ns = F.col("__ns").cast("decimal(38,0)")
    per_second = lambda n, least: F.col(n).cast("decimal(38,0)") * 1_000_000_000 >= F.col(least) * SUSTAINED_TIMES * ns
    checks = {
        "duration": F.col("__ns") >= SUSTAINED_S * 1_000_000_000,
        "sustained": per_second("__n", "__pm") & per_second("__b", "__pb"),
        "burst": (F.col("__bm") >= F.col("__pm") * BURST_TIMES * BURST_S) & (F.col("__bb") >= F.col("__pb") * BURST_TIMES * BURST_S),
        "accounted": F.col("__n") == F.col("expected"),
    }
    found = {c: F.coalesce(x, F.lit(False)) for c, x in checks.items()}
    verdict = F.when(reduce(lambda a, b: a & b, found.values()), "pass").otherwise("fail")
    return rows.select(*by, *(x.alias(c) for c, x in found.items()), verdict.alias("verdict"))


def declaration_faults(declared: DataFrame, key: str, start: str, end: str, state: str, legal: Mapping[str, Sequence[str]], first: str) -> DataFrame:
    """(key, fault, n) of declarations with a validity and a state: repeated, overlapping, illegal_transition, inverted."""
    marked = lambda df, fault: df.groupBy(key).agg(F.count("*").alias("n")).select(key, F.lit(fault).alias("fault"), "n")
    repeated = declared.groupBy(*declared.columns).agg(F.count("*").alias("__n")).where("__n > 1")
    once = declared.distinct()
    inverted = once.where(F.col(end) <= F.col(start))
    parts = [(repeated, "repeated"), (overlapping(once, [key], start, end), "overlapping"), (lifecycle_faults(once, key, [start, end, state], state, legal, first), "illegal_transition"), (inverted, "inverted")]
    return reduce(DataFrame.unionByName, (marked(df, fault) for df, fault in parts))


ARCHIVE_COMMIT = ("utc_date", "n", "first_id", "last_id", "digest")


def archive_commits(rows: DataFrame, key: str = "opportunity_id", date: str = "utc_date") -> DataFrame:
    """One commit record per date: count, id bounds and digest of its rows."""
    bounds = rows.groupBy(date).agg(F.min(key).alias("first_id"), F.max(key).alias("last_id"))
    return multiset_digest(rows, [date]).join(bounds, date).select(*ARCHIVE_COMMIT)


def archive_faults(archived: DataFrame, commits: DataFrame, time: str, key: str = "opportunity_id", date: str = "utc_date") -> DataFrame:
    """(utc_date, fault): dates whose archived rows and commit record disagree, or whose rows don't belong there.

    absent, unlisted, n, first_id, last_id, digest as recomputed; open: a row without outcome; foreign_date: a row of
    another day; repeated: an id twice.
    """
    names = ARCHIVE_COMMIT[1:]
    day = F.date_format(F.timestamp_micros(F.call_function("div", F.col(time), F.lit(1000))), "yyyy-MM-dd")
    inner = archived.groupBy(date).agg(F.count_if(F.col("outcome").isNull()).alias("__open"), F.count_if(day != F.col(date)).alias("__foreign"), (F.count(key) - F.count_distinct(key)).alias("__again"))
    found = archive_commits(archived, key, date).select(date, F.struct(*names).alias("f")).join(inner, date)
    both = commits.select(date, F.struct(*names).alias("e")).join(found, date, "full_outer")
    fault = F.when(F.col("f").isNull(), "absent").when(F.col("e").isNull(), "unlisted")
    for c, name in (("__open", "open"), ("__foreign", "foreign_date"), ("__again", "repeated")):
        fault = fault.when(F.col(c) > 0, name)
    for c in names:
        fault = fault.when(~F.col(f"f.{c}").eqNullSafe(F.col(f"e.{c}")), c)
    return both.select(date, fault.alias("fault")).where("fault IS NOT NULL")
