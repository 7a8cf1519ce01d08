"""Temporal and catalogue joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.windows import NS_PER_HOUR, carried, spans


def small(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most_rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def within(time: Column, start: Column, end: Column) -> Column:
    """Half-open validity; an open end is null."""
    return (time >= start) & (end.isNull() | (time < end))


def active_at(df: DataFrame, versions: DataFrame, keys: Sequence[str], time: str, start: str, end: str, how: str = "left") -> DataFrame:
    """Each row with the version of its keys that is valid at its time."""
    v = small(versions).alias("v")
    on = within(F.col(time), F.col(f"v.{start}"), F.col(f"v.{end}"))
    for k in keys:
        on = on & (F.col(f"r.{k}") == F.col(f"v.{k}"))
    kept = [F.col(f"v.{c}") for c in versions.columns if c not in keys]
    return df.alias("r").join(v, on, how).select("r.*", *kept)


def lookup(df: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows that the dimension knows, rows for quarantine)."""
    d = small(dimension)
    return df.join(d, list(keys)), df.join(d, list(keys), "left_anti")


def as_of(versions: DataFrame, time_ns: int, start: str = "valid_from_ns", end: str = "valid_to_ns") -> DataFrame:
    return versions.where(within(F.lit(time_ns), F.col(start), F.col(end)))


# ---- intervals of mixed lengths --------------------------------------------------------------------------------

#: Bits of the narrowest buckets (2^36 ns is 69 s) and from one width to the next; an open end has a width of its own.
NARROWEST, STEP, WIDEST = 36, 3, 63


def shift_for(start: Column, end: Column, narrowest: int = NARROWEST) -> Column:
    """Bits of the width of the buckets that an interval is put into: no shorter than itself, WIDEST for an open end.

    An interval thus touches two buckets at most, whether it lasts seconds or years.
    """
    over = F.greatest(F.ceil(F.log2((end - start).cast("double"))) - narrowest, F.lit(0).cast("long"))
    steps = F.ceil(over / STEP) * STEP + narrowest
    return F.when(end.isNull(), WIDEST).otherwise(F.least(steps, F.lit(WIDEST).cast("long"))).cast("int")


def in_buckets(windows: DataFrame, start: str = "start_ns", end: str = "end_ns", narrowest: int = NARROWEST) -> DataFrame:
    """``windows`` once for each bucket they touch, with ``__shift`` and ``__b``; windows that hold nothing go."""
    held = windows.where(F.col(end).isNull() | (F.col(start) < F.col(end)))
    rows = held.withColumn("__shift", shift_for(F.col(start), F.col(end), narrowest))
    last = F.coalesce(F.col(end) - 1, F.lit((1 << 63) - 1))
    first, upto = (F.call_function("shiftright", x, F.col("__shift")) for x in (F.col(start), last))
    return rows.withColumn("__b", F.explode(F.sequence(first, upto)))


def _held(pieces: DataFrame) -> DataFrame:
    """Pieces are read for their widths, their sizes and the join: written once, to the folder that the cluster shares."""
    from tickloom.sources.tables import shared_folder

    folder = shared_folder(pieces.sparkSession)
    pieces.write.parquet(folder)
    return pieces.sparkSession.read.schema(pieces.schema).parquet(folder)


def _widths(pieces: DataFrame) -> list[int]:
    """The widths in use, a dozen at most."""
    return sorted(r[0] for r in pieces.select("__shift").distinct().collect())


def containing_windows(
    events: DataFrame,
    windows: DataFrame,
    keys: Sequence[str],
    time: str,
    id_col: str,
    out: str,
    row_keys: Sequence[str] = (),
    narrowest: int = NARROWEST,
) -> DataFrame:
    """(row_keys..., out): for each event the sorted ids of the windows [start_ns, end_ns) that hold its time.

    A window is in one or two buckets of a width that suits its length, and an open end (null) holds all later times.
    The windows of a key and bucket are one array, so an event meets one row for each width in use, by equality, and
    its array is filtered in place: events are neither spread nor grouped again, and equal events are each a row.
    """
    pieces = _held(in_buckets(windows.select(*keys, "start_ns", "end_ns", F.col(id_col).alias("__id")), narrowest=narrowest))
    rows = events.select(*row_keys, *(k for k in keys if k not in row_keys), F.col(time).alias("__t")).withColumn("__ids", F.array().cast("array<string>"))
    for shift in _widths(pieces):
        held = F.struct("start_ns", "end_ns", F.col("__id").cast("string").alias("id"))
        lists = small(pieces.where(F.col("__shift") == shift).groupBy(*keys, "__b").agg(F.collect_set(held).alias("__w")))
        rows = rows.withColumn("__b", F.expr(f"shiftright(__t, {shift})")).join(lists, [*keys, "__b"], "left")
        fits = F.filter("__w", lambda w: (F.col("__t") >= w["start_ns"]) & (w["end_ns"].isNull() | (F.col("__t") < w["end_ns"])))
        rows = rows.withColumn("__ids", F.concat("__ids", F.coalesce(F.transform(fits, lambda w: w["id"]), F.array().cast("array<string>")))).drop("__w", "__b")
    return rows.select(*row_keys, F.array_sort(F.array_distinct("__ids")).alias(out))


def _points_in(points: DataFrame, windows: DataFrame, keys: Sequence[str], point: str, start: str, end: str, narrowest: int) -> DataFrame:
    """Pairs of a point and a window [start, end) that holds it; each pair once. Null keys meet nothing."""
    pieces = _held(in_buckets(windows, start, end, narrowest))
    widths = F.array(*(F.lit(s) for s in _widths(pieces)))
    spread = points.withColumn("__shift", F.explode(widths.cast("array<int>")))
    spread = spread.withColumn("__b", F.call_function("shiftright", F.col(point), F.col("__shift")))
    found = spread.join(pieces, [*keys, "__shift", "__b"])
    return found.where((F.col(point) >= F.col(start)) & (F.col(end).isNull() | (F.col(point) < F.col(end)))).drop("__shift", "__b")


def overlapping_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], narrowest: int = NARROWEST) -> DataFrame:
    """Pairs of rows of equal keys whose intervals [l_start, l_end) and [r_start, r_end) overlap; open ends are null.

    Two intervals overlap where one holds the other's start, so there are two joins of points with windows, which share
    no pair: by equality on keys and bucket, never on the keys alone. Intervals that hold nothing overlap nothing.
    """
    held = lambda df, s: df.where(F.col(f"{s}_end").isNull() | (F.col(f"{s}_start") < F.col(f"{s}_end")))
    left, right = held(left, "l"), held(right, "r")
    inside = _points_in(right, left, keys, "r_start", "l_start", "l_end", narrowest)
    around = _points_in(left, right, keys, "l_start", "r_start", "r_end", narrowest).where("l_start > r_start")
    return inside.unionByName(around)


def overlap_counts(left: DataFrame, right: DataFrame, keys: Sequence[str], span: int = NS_PER_HOUR) -> DataFrame:
    """(columns of ``right``..., n): how many rows of ``left`` of equal keys overlap each row of ``right``; none, no row.

    The number of pairs of ``overlapping_pairs`` without making them. Of the intervals that begin before the right one's end,
    those overlap it that don't end by its start; both counts are running sums along the key, in chunks of ``span``. Equal
    rows of ``right`` are one row with the sum. Null keys meet nothing, and intervals that hold nothing overlap nothing.
    """
    known = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    held = lambda df, s: df.where(known).where(F.col(f"{s}_end").isNull() | (F.col(f"{s}_start") < F.col(f"{s}_end")))
    left, right = held(left, "l"), held(right, "r")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    # at one time: ends of right ask first, then left begins and ends, then starts of right ask
    point = lambda df, at, place, begun, ended: df.withColumns({"__at": at, "__place": F.lit(place), "__begun": begun, "__ended": ended})
    lefts = left.select(*keys, "l_start", "l_end")
    points = [
        point(lefts, F.col("l_start"), 1, one, none).drop("l_start", "l_end"),
        point(lefts.where("l_end IS NOT NULL"), F.col("l_end"), 1, none, one).drop("l_start", "l_end"),
        point(right, F.coalesce("r_end", F.lit((1 << 63) - 1)), 0, none, none),
        point(right, F.col("r_start"), 2, none, none),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), points)
    rows = carried(rows, keys, spans("__at", span), ["__at", "__place"], sums={"__b": F.col("__begun"), "__e": F.col("__ended")})
    n = F.sum(F.when(F.col("__place") == 0, F.col("__b")).otherwise(-F.col("__e"))).alias("n")
    return rows.where("__place <> 1").groupBy(*right.columns).agg(n).where("n > 0")


def repeated(rows: DataFrame, n: str, block: int = 4096, task_rows: int = 10_000_000) -> DataFrame:
    """Each row as often as its column ``n`` says, without it, in arrays of ``block`` items at most.

    What is read says little of how much is written: ``rows`` are held, and where they give more than ``task_rows`` their
    blocks are dealt to tasks that write about as many, so that no task is long and all end together.
    """
    rows = _held(rows)
    total = rows.agg(F.sum(n)).first()[0] or 0
    blocks = rows.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col(n) - 1, F.lit(block)))))
    size = F.least(F.lit(block).cast("long"), F.col(n) - F.col("__block") * block)
    blocks = blocks.withColumn("__size", size)
    if total > task_rows:
        blocks = blocks.repartition(-(-total // task_rows), *(c for c in rows.columns if c != n), "__block")
    return blocks.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__size")))).drop("col", "__block", "__size", n)


def reconcile(listed: DataFrame, catalogued: DataFrame, key: str) -> DataFrame:
    """(key, verdict): objects found against objects catalogued, by a full outer join.

    ``listed`` has size_found, ``catalogued`` has size_expected and has_manifest.
    """
    both = listed.join(catalogued, key, "full_outer")
    verdict = (
        F.when(F.col("size_expected").isNull(), "orphan")
        .when(F.col("size_found").isNull(), "lost")
        .when(~F.col("has_manifest"), "manifestless")
        .when(F.col("size_found") != F.col("size_expected"), "unverifiable")
        .otherwise("commit")
    )
    return both.select(key, verdict.alias("verdict"))


def restore_check(catalogued: DataFrame, stored: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, state): each catalogued segment as verified, corrupt or lost."""
    s = stored.select(key, F.col(digest).alias("__found"))
    state = F.when(F.col("__found").isNull(), "lost").when(F.col("__found") == F.col(digest), "verified").otherwise("corrupt")
    return catalogued.join(s, key, "left").select(key, state.alias("state"))


def paired(metadata: str, contexts: str) -> Column:
    """Positions of two arrays zipped; null, so rejected, where their lengths differ."""
    return F.when(F.size(metadata) == F.size(contexts), F.arrays_zip(metadata, contexts))
