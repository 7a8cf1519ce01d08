"""Aggregations: extents, exact totals, ledgers, rollups and verdicts. All are partial-then-final groupings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Edges of the lag histogram in milliseconds. Fixed values.
LAG_EDGES_MS = (1, 5, 10, 50, 100, 250, 500, 1000, 5000)
STALE_S, BROKEN_S, LAG_STALE_S, LAG_BROKEN_S, TAPE_CELLS = 60, 300, 300, 1800, 180


def extent(df: DataFrame, by: Sequence[str] = (), time: str = "received_time_ns") -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.min(time).alias("first_ns"), F.max(time).alias("last_ns"))


def research(df: DataFrame, top: int = 1000) -> DataFrame:
    """Count and exact price sum per instrument, largest count first; only a top-n reaches the driver."""
    priced = df.where("price IS NOT NULL").groupBy("instrument_uid").agg(F.count("*").alias("n"), F.sum("price").alias("total"))
    return priced.orderBy(F.desc("n"), "instrument_uid").limit(top)


def outcome_counts(current: DataFrame, archived: DataFrame, outcomes: Sequence[str]) -> DataFrame:
    """Per scope: all, open, and each outcome, over the union of both ledgers."""
    rows = current.unionByName(archived)
    each = [F.count_if(F.col("outcome") == o).alias(o) for o in outcomes]
    return rows.groupBy("scope").agg(F.count("*").alias("total"), F.count_if(F.col("outcome").isNull()).alias("open"), *each)


def schema_observations(df: DataFrame, fingerprint: str, time: str, coordinate: str) -> DataFrame:
    return df.groupBy(fingerprint).agg(
        F.min(time).alias("first_ns"),
        F.max(time).alias("last_ns"),
        F.count("*").alias("n"),
        F.min_by(coordinate, F.struct(time, coordinate)).alias("first_at"),
        F.max_by(coordinate, F.struct(time, coordinate)).alias("last_at"),
    )


def strict_total(df: DataFrame, by: Sequence[str], value: str, unit: str, provisional: Column) -> DataFrame:
    """Exact sum over rows of proven units; provisional ones are counted, mixed units give no total."""
    proven = F.when(~provisional, F.col(value))
    units = F.count_distinct(F.when(~provisional, F.col(unit)))
    return df.groupBy(*by).agg(
        F.when(units <= 1, F.sum(proven)).alias("total"), F.count_if(provisional).alias("excluded"), (units > 1).alias("mixed")
    )


def zero_filled(df: DataFrame, states: DataFrame, state: str) -> DataFrame:
    counts = df.groupBy(state).agg(F.count("*").alias("n"))
    return states.join(counts, state, "left").select(state, F.coalesce("n", F.lit(0)).alias("n"))


def ceiling_divide(a: Column, b: Column) -> Column:
    return F.call_function("div", a + b - 1, b)


def capacity(df: DataFrame, by: Sequence[str], size: str, seen_days: int, days: int = 30) -> DataFrame:
    """Bytes for ``days`` days at the seen rate, rounded up."""
    return df.groupBy(*by).agg(F.sum(size).alias("seen")).select(*by, ceiling_divide(F.col("seen") * days, F.lit(seen_days)).alias("projected"))


def histogram(df: DataFrame, by: Sequence[str], value: Column, edges: Sequence[int] = LAG_EDGES_MS) -> DataFrame:
    """Cumulative counts at fixed edges, and the whole count."""
    each = [F.count_if(value <= e).alias(f"le_{e}") for e in edges]
    return df.groupBy(*by).agg(*each, F.count("*").alias("n"))


def tape(windows: DataFrame, from_ns: int, to_ns: int, rank: Column, cells: int = TAPE_CELLS) -> DataFrame:
    """(cell, worst): the worst rank of the intervals that touch each of equal cells of a time range."""
    width = (to_ns - from_ns) // cells
    inside = windows.where((F.col("start_ns") < to_ns) & (F.col("end_ns") > from_ns))
    cell = lambda t: F.greatest(F.lit(0).cast("long"), F.least(F.lit(cells - 1).cast("long"), F.call_function("div", t - from_ns, F.lit(width))))
    spread = inside.select(rank.alias("rank"), F.explode(F.sequence(cell(F.col("start_ns")), cell(F.col("end_ns") - 1))).alias("cell"))
    return spread.groupBy("cell").agg(F.max("rank").alias("worst"))


def freshness(df: DataFrame, by: Sequence[str], end: str, now_ns: int) -> DataFrame:
    age = F.lit(now_ns) - F.max(end)
    verdict = F.when(age > BROKEN_S * 1_000_000_000, "broken").when(age > STALE_S * 1_000_000_000, "stale").otherwise("fresh")
    return df.groupBy(*by).agg(verdict.alias("verdict"))


def continuity(df: DataFrame, by: Sequence[str], state_rank: Column, severity: Column) -> DataFrame:
    """Counts by class, and the worse of the worst state and the worst incident."""
    return df.groupBy(*by).agg(
        F.count_if(state_rank == 0).alias("good"),
        F.count_if(state_rank == 1).alias("degraded"),
        F.count_if(state_rank == 2).alias("broken"),
        F.greatest(F.max(state_rank), F.max(severity)).alias("verdict"),
    )


def pages_complete(df: DataFrame, cycle: str, page: str, symbol: str) -> DataFrame:
    """Whether a cycle has pages 0..n-1, each symbol once."""
    return df.groupBy(cycle).agg(
        (F.count_distinct(page) == F.max(page) + 1).alias("pages_complete"),
        (F.count("*") == F.count_distinct(symbol)).alias("symbols_unique"),
    )


def evidence(df: DataFrame, by: Sequence[str], time: str, decimals: Sequence[str]) -> DataFrame:
    """What two builds of one dataset are compared by: counts, bounds, and count and sum of each decimal."""
    sums = [x for c in decimals for x in (F.count(c).alias(f"n_{c}"), F.sum(c).cast("string").alias(f"sum_{c}"))]
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.min(time).alias("first_ns"), F.max(time).alias("last_ns"), *sums)
