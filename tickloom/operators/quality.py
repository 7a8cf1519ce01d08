"""The quality ledger: gaps, completeness, checkpoints, lifecycles, spills, corrections and release checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators.windows import carried, next_time, null_safe_join, spans

NS_PER_HOUR = 3_600_000_000_000


def gap_ledger(gaps: DataFrame, observations: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """Each gap with ``resolved_ns``: the first observation of its tuple at or after its end; else it stays open.

    It is looked for within the hour of the gap's end first, then in the first times of the tuple's later hours.
    """
    g = gaps.select(*keys, "gap_id", "start_ns", "end_ns", F.lit(None).cast("long").alias("__t"), F.col("end_ns").alias("__at"), F.lit(0).alias("__k"))
    o = observations.select(*keys, F.lit(None).cast("string").alias("gap_id"), *(F.lit(None).cast("long").alias(c) for c in ("start_ns", "end_ns")), F.col(time).alias("__t"), F.col(time).alias("__at"), F.lit(1).alias("__k"))
    rows = g.unionByName(o).withColumn("__span", F.call_function("div", F.col("__at"), F.lit(NS_PER_HOUR)))
    later = Window.partitionBy(*keys).orderBy("__span").rowsBetween(1, Window.unboundedFollowing)
    firsts = rows.groupBy(*keys, "__span").agg(F.min("__t").alias("__min"))
    firsts = firsts.withColumn("__beyond", F.first("__min", ignorenulls=True).over(later)).drop("__min")
    within = Window.partitionBy(*keys, "__span").orderBy("__at", "__k").rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("__within", F.first("__t", ignorenulls=True).over(within)).where("__k = 0")
    rows = null_safe_join(rows, firsts, [*keys, "__span"]).withColumn("resolved_ns", F.coalesce("__within", "__beyond"))
    state = F.when(F.col("resolved_ns").isNull(), "open").otherwise("recovered")
    return rows.select(*keys, "gap_id", "start_ns", "end_ns", "resolved_ns", state.alias("state"))


def gap_lifecycle(events: DataFrame, keys: Sequence[str], span_ns: int = NS_PER_HOUR) -> DataFrame:
    """(keys..., gap_id, start_ns, end_ns, resolved_ns, state) of each gap that opens: open, recovered or permanent.

    ``events`` has at_ns, kind (gap, recovered, permanent), gap_id, start_ns, end_ns. A tuple has one open gap: gaps between
    two endings are one, the first. So the number of endings before a gap, counted in chunks of ``span_ns``, is both
    its group and the number of the ending that it meets.
    """
    ends = F.when(F.col("kind") == "gap", 0).otherwise(1)
    order = ["at_ns", ends, "gap_id"]
    rows = carried(events, keys, spans("at_ns", span_ns), order, sums={"__n": ends.cast("long")})
    first = F.min(F.struct("at_ns", "gap_id", "start_ns", "end_ns")).alias("g")
    opened = rows.where("kind = 'gap'").groupBy(*keys, "__n").agg(first)
    ended = rows.where("kind <> 'gap'").select(*keys, (F.col("__n") - 1).alias("__n"), F.col("at_ns").alias("resolved_ns"), F.col("kind").alias("state"))
    both = null_safe_join(opened, ended, [*keys, "__n"])
    return both.select(*keys, "g.gap_id", "g.start_ns", "g.end_ns", "resolved_ns", F.coalesce("state", F.lit("open")).alias("state"))


def closed_hours(df: DataFrame, source: str, time: str) -> DataFrame:
    """(source, hour, n): hours whose end the source's high-water mark has passed."""
    hour = F.call_function("div", F.col(time), F.lit(NS_PER_HOUR))
    high = df.groupBy(source).agg(F.max(time).alias("__high"))
    return df.groupBy(source, hour.alias("hour")).agg(F.count("*").alias("n")).join(high, source).where((F.col("hour") + 1) * NS_PER_HOUR <= F.col("__high")).drop("__high")


def advance_checkpoints(old: DataFrame, new: DataFrame, keys: Sequence[str], position: Sequence[str], digest: str) -> tuple[DataFrame, DataFrame]:
    """(the furthest checkpoint per key, conflicts: one position with two digests)."""
    both = old.unionByName(new)
    furthest = both.groupBy(*keys).agg(F.max(F.struct(*position, digest)).alias("c")).select(*keys, "c.*")
    conflicts = both.groupBy(*keys, *position).agg(F.count_distinct(digest).alias("forms")).where("forms > 1").drop("forms")
    return furthest, conflicts


def merge_outcomes(ledger: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The ledger after the changes, with what happened: inserted, terminalised, replayed, conflict or kept.

    An open row takes an outcome once; the same again is a replay and another is a conflict that changes nothing.
    """
    new = changes.select(key, F.col("outcome").alias("__new"), F.lit(True).alias("__c"))
    both = ledger.select(key, "outcome", F.lit(True).alias("__l")).join(new, key, "full_outer")
    what = (
        F.when(F.col("__c").isNull(), "kept")
        .when(F.col("__l").isNull(), "inserted")
        .when(F.col("outcome").eqNullSafe(F.col("__new")), "replayed")
        .when(F.col("outcome").isNull(), "terminalised")
        .otherwise("conflict")
    )
    after = F.when(F.col("__l").isNull() | F.col("outcome").isNull(), F.coalesce("__new", "outcome")).otherwise(F.col("outcome"))
    return both.select(key, after.alias("outcome"), what.alias("what"))


def silences(df: DataFrame, by: Sequence[str], time: str, limit_ns: int) -> DataFrame:
    """(by..., from_ns, silent_ns): stretches without a row that are longer than the limit."""
    rows = next_time(df.select(*by, F.col(time).alias("from_ns")), by, "from_ns", "__next")
    return rows.select(*by, "from_ns", (F.col("__next") - F.col("from_ns")).alias("silent_ns")).where(F.col("silent_ns") > limit_ns)


def silent_since(df: DataFrame, by: Sequence[str], time: str, limit_ns: int) -> DataFrame:
    """(by..., from_ns): stretches without a row longer than the limit, also those still open at the latest time of all keys."""
    rows = next_time(df.select(*by, F.col(time).alias("from_ns")), by, "from_ns", "__next")
    high = df.agg(F.max(time).alias("__high"))
    ended = rows.where(F.col("__next") - F.col("from_ns") > limit_ns).select(*by, "from_ns")
    last = rows.where("__next IS NULL").join(high, F.col("__high") - F.col("from_ns") > limit_ns)
    return ended.unionByName(last.select(*by, "from_ns"))


def next_answers(requests: DataFrame, answers: DataFrame, keys: Sequence[str], span_ns: int = NS_PER_HOUR) -> DataFrame:
    """``requests`` with ``answered_ns``: the first answer of its keys at or after ``at_ns``, or null.

    Both sides are sorted together within spans of time, and a request whose span has no later answer takes the first
    one of the key's following spans. A request is one row throughout, however many answers its key has, and answers
    at the time of a request are for it.
    """
    marked = requests.withColumns({"__k": F.lit(0), "__t": F.lit(None).cast("long"), "__at": F.col("at_ns")})
    given = answers.select(*keys, F.lit(1).alias("__k"), F.col("at_ns").alias("__t"), F.col("at_ns").alias("__at"))
    rows = marked.unionByName(given, allowMissingColumns=True).withColumn("__span", spans("__at", span_ns))
    later = Window.partitionBy(*keys).orderBy("__span").rowsBetween(1, Window.unboundedFollowing)
    firsts = rows.groupBy(*keys, "__span").agg(F.min("__t").alias("__min"))
    beyond = firsts.select(*keys, "__span", F.lit(2).alias("__k"), F.first("__min", ignorenulls=True).over(later).alias("__t"))
    # the answer beyond a span stands at its end
    both = rows.unionByName(beyond, allowMissingColumns=True)
    within = Window.partitionBy(*keys, "__span").orderBy(F.col("__at").asc_nulls_last(), "__k").rowsBetween(0, Window.unboundedFollowing)
    found = both.withColumn("answered_ns", F.first("__t", ignorenulls=True).over(within)).where("__k = 0")
    return found.drop("__k", "__t", "__at", "__span")


def deadlines(requests: DataFrame, answers: DataFrame, keys: Sequence[str], limit_ns: int) -> DataFrame:
    """(request_id, outcome) of each request: acknowledged if its next answer came within the limit, else missed."""
    found = next_answers(requests, answers, keys, max(limit_ns, 1))
    late = F.coalesce(F.col("answered_ns") - F.col("at_ns") > limit_ns, F.lit(True))
    return found.select("request_id", F.when(late, "missed").otherwise("acknowledged").alias("outcome"))


def duplicate_flags(df: DataFrame, keys: Sequence[str]) -> Column:
    """A column: whether other rows share the keys. Rows are flagged, never dropped."""
    return F.count("*").over(Window.partitionBy(*keys)) > 1


def spill_boundaries(df: DataFrame, by: Sequence[str], order: Sequence[str], key: str) -> DataFrame:
    """(by..., n, first_id, last_id) of a batch in its order."""
    position = F.struct(*order)
    return df.groupBy(*by).agg(F.count("*").alias("n"), F.min_by(key, position).alias("first_id"), F.max_by(key, position).alias("last_id"))


def standing(corrections: DataFrame, key: str, supersedes: str) -> DataFrame:
    """Corrections that no other supersedes."""
    gone = corrections.where(F.col(supersedes).isNotNull()).select(F.col(supersedes).alias(key)).distinct()
    return corrections.join(gone, key, "left_anti")


def sole_open(gaps: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys..., n, conflict): open gaps per tuple; more than one is a conflict."""
    return gaps.groupBy(*keys).agg(F.count("*").alias("n")).withColumn("conflict", F.col("n") > 1)


def lacking(declared: DataFrame, required: DataFrame, results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Declared contracts crossed with the few required items, less what has a passing result."""
    return declared.crossJoin(F.broadcast(required)).join(results, list(keys), "left_anti")


def release_verdict(df: DataFrame, by: Sequence[str], sustained: Column, burst: Column, peak: Column, lost: Column) -> DataFrame:
    """Whether a source holds twice its peak sustained, five times in bursts, without loss."""
    fine = (sustained >= 2 * peak) & (burst >= 5 * peak) & (lost == 0)
    return df.select(*by, F.when(fine, "pass").otherwise("fail").alias("verdict"))
