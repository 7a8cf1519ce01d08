"""Ordering, sequence evidence, versions and paging. Every window is partitioned; global order is a range sort.

Running values along an epoch go through ``carried``, which cuts an epoch into chunks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


NS_PER_HOUR = 3_600_000_000_000


def spans(column: str, width: int) -> Column:
    """Number of the span of ``width`` that a whole-number column falls into; monotone in the column."""
    return F.floor(F.col(column) / F.lit(width)) if width & (width - 1) else F.expr(f"shiftright(`{column}`, {width.bit_length() - 1})")


def carried(
    df: DataFrame, by: Sequence[str], chunk: Column, order: Sequence[str | Column], sums: Mapping[str, Column] | None = None, maxima: Mapping[str, Column] | None = None, inclusive: bool = True
) -> DataFrame:
    """``df`` with running sums and maxima along each key in ``order``, up to the row (or up to the one before).

    Two passes over ``df``. The first reduces each chunk of a key to its sums and maxima, of which a key has few; these are
    accumulated along the key. The second sorts rows within their chunk, behind a head row that carries what came
    before it, so rows are shuffled once, by key and chunk, and a key with a third of all rows spreads over its chunks.
    ``chunk`` must not fall as ``order`` rises. Sums of nothing are 0 and maxima of nothing null; null keys are a key.
    """
    sums, maxima = dict(sums or {}), dict(maxima or {})
    names = {**{n: f"__v_{n}" for n in sums}, **{n: f"__v_{n}" for n in maxima}}
    rows = df.withColumns({"__chunk": chunk, **{names[n]: c for n, c in {**sums, **maxima}.items()}})
    parts = rows.groupBy(*by, "__chunk").agg(*(F.sum(names[n]).alias(names[n]) for n in sums), *(F.max(names[n]).alias(names[n]) for n in maxima))
    earlier = Window.partitionBy(*by).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    heads = parts.select(
        *by, "__chunk", *(F.coalesce(F.sum(names[n]).over(earlier), F.lit(0)).alias(names[n]) for n in sums), *(F.max(names[n]).over(earlier).alias(names[n]) for n in maxima), F.lit(0).alias("__row")
    )
    both = rows.withColumn("__row", F.lit(1)).unionByName(heads, allowMissingColumns=True)
    within = Window.partitionBy(*by, "__chunk").orderBy("__row", *order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    found = {**{n: F.coalesce(F.sum(names[n]).over(within), F.lit(0)) for n in sums}, **{n: F.max(names[n]).over(within) for n in maxima}}
    return both.withColumns(found).where("__row = 1").drop("__row", "__chunk", *(v for n, v in names.items()))


def number_arrivals(df: DataFrame, epoch: Sequence[str], order: Sequence[str], resume: DataFrame | None = None, span: int = NS_PER_HOUR) -> DataFrame:
    """``arrival_ordinal`` from 1 within each epoch, or on from ``resume`` (epoch columns and last_ordinal).

    The first order column, a whole number, is cut into chunks of ``span``.
    """
    rows = carried(df, epoch, spans(order[0], span), order, sums={"arrival_ordinal": F.lit(1).cast("long")})
    if resume is None:
        return rows
    rows = rows.join(resume, list(epoch), "left")
    return rows.withColumn("arrival_ordinal", F.col("arrival_ordinal") + F.coalesce("last_ordinal", F.lit(0))).drop("last_ordinal")


def ordinal_gaps(df: DataFrame, epoch: Sequence[str], ordinal: str = "arrival_ordinal", span: int = 1 << 16) -> DataFrame:
    """(epoch..., first_missing, last_missing), also before the first row; in chunks of ``span`` ordinals."""
    rows = carried(df.select(*epoch, ordinal), epoch, spans(ordinal, span), [ordinal], maxima={"__p": F.col(ordinal)}, inclusive=False)
    before = F.coalesce("__p", F.lit(0))
    gaps = rows.where(F.col(ordinal) > before + 1)
    return gaps.select(*epoch, (before + 1).cast("long").alias("first_missing"), (F.col(ordinal) - 1).alias("last_missing"))


def overlap_rest(segments: DataFrame, by: Sequence[str], first: str, last: str, span: int = 1 << 16) -> DataFrame:
    """Segments in order, with ``emit_from``: where the part begins that earlier segments have not given."""
    rows = carried(segments, by, spans(first, span), [first, last], maxima={"__end": F.col(last)}, inclusive=False)
    return rows.withColumn("emit_from", F.when(F.col("__end") >= F.col(first), F.col("__end") + 1).otherwise(F.col(first))).drop("__end")


def epoch_boundaries(df: DataFrame, source: str, epoch: str, time: str) -> DataFrame:
    """(source, epoch, first_ns, previous_epoch): epochs of a source by first time, then id."""
    firsts = df.groupBy(source, epoch).agg(F.min(time).alias("first_ns"))
    return firsts.withColumn("previous_epoch", F.lag(epoch).over(Window.partitionBy(source).orderBy("first_ns", epoch)))


def native_order(df: DataFrame, source: str, epoch: str, time: str, ordinal: str) -> DataFrame:
    """Source by source: epochs by (first time, id), then by ordinal."""
    firsts = df.groupBy(source, epoch).agg(F.min(time).alias("__first"))
    return df.join(firsts, [source, epoch]).orderBy(source, "__first", epoch, ordinal).drop("__first")


def observed_order(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All sources by the whole merge key; a range sort, never one partition."""
    return df.orderBy(*keys)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``left`` with the other columns of ``right``, where nulls in the keys equal each other."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    return left.join(renamed, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys], how).drop(*(f"__r_{k}" for k in keys))


def next_time(df: DataFrame, by: Sequence[str], time: str, out: str, backwards: bool = False, order: Sequence[Column] = (), span_ns: int = 3_600_000_000_000) -> DataFrame:
    """``df`` with the time of the following row of its key (the preceding one, if ``backwards``).

    Rows are sorted within spans of time; only the first and last times of the spans are sorted along a key, so a key
    that holds a third of all rows spreads over its spans.
    """
    rows = df.withColumn("__span", F.call_function("div", F.col(time), F.lit(span_ns)))
    near, edge = (F.lag, F.max) if backwards else (F.lead, F.min)
    edges = rows.groupBy(*by, "__span").agg(edge(time).alias("__edge"))
    edges = edges.withColumn("__beyond", near("__edge").over(Window.partitionBy(*by).orderBy("__span"))).drop("__edge")
    within = near(time).over(Window.partitionBy(*by, "__span").orderBy(time, *order))
    rows = null_safe_join(rows, edges, [*by, "__span"])
    return rows.withColumn(out, F.coalesce(within, "__beyond")).drop("__span", "__beyond")


def dataset_order(df: DataFrame, partition: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with dataset_ordinal, repeated coordinates).

    Rows are numbered within their instrument and epoch; only the sizes of these groups are summed along a partition.
    """
    group = [*partition, "instrument_uid", "epoch_id"]
    sizes = df.groupBy(*group).agg(F.min("received_time_ns").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy(*partition).orderBy("instrument_uid", "__first", "epoch_id").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__first", "__n")
    within = F.row_number().over(Window.partitionBy(*group).orderBy("arrival_ordinal", "native_trade_id"))
    rows = null_safe_join(df, starts, group).withColumn("dataset_ordinal", (F.col("__start") + within).cast("long")).drop("__start")
    coordinate = [*partition, "epoch_id", "arrival_ordinal"]
    repeated = df.groupBy(*coordinate).count().where("count > 1")
    return rows, repeated


def after(keys: Sequence[str], cursor: Mapping[str, object]) -> Column:
    """Rows past a cursor in lexicographic order, with a leading range on the first key so files can be pruned."""
    chain, equal = F.lit(False), F.lit(True)
    for k in keys:
        chain = chain | (equal & (F.col(k) > F.lit(cursor[k])))
        equal = equal & (F.col(k) == F.lit(cursor[k]))
    return (F.col(keys[0]) >= F.lit(cursor[keys[0]])) & chain


def page(df: DataFrame, keys: Sequence[str], size: int, cursor: Mapping[str, object] | None = None) -> DataFrame:
    """One page in key order and one row more, which tells whether there is another page."""
    rows = df if cursor is None else df.where(after(keys, cursor))
    return rows.orderBy(*keys).limit(size + 1)


def order_faults(df: DataFrame, by: Sequence[str], position: str, key: Sequence[str]) -> DataFrame:
    """Rows whose key does not lie beyond that of the row before."""
    here = F.struct(*key)
    return df.withColumn("__before", F.lag(here).over(Window.partitionBy(*by).orderBy(position))).where(here <= F.col("__before")).drop("__before")


def latest(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each group."""
    w = Window.partitionBy(*by).orderBy(*(F.desc(c) for c in order))
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def versions(observed: DataFrame, key: str, time: str, attributes: Sequence[str], closed: Column | None = None) -> DataFrame:
    """Slowly changing versions: (key, generation, attributes..., valid_from_ns, valid_to_ns).

    Unchanged observations are skipped. An observation that ``closed`` marks ends the version before it and
    opens none; what comes after it is a new generation.
    """
    w = Window.partitionBy(key).orderBy(time)
    ends = F.lit(False) if closed is None else F.coalesce(closed, F.lit(False))
    state = F.struct(*attributes, ends.alias("__closed"))
    rows = observed.withColumn("__s", state)
    rows = rows.withColumn("__before", F.lag("__s").over(w)).where(~F.col("__s").eqNullSafe(F.col("__before")))
    rows = rows.withColumn("valid_to_ns", F.lead(time).over(w))
    generation = F.coalesce(F.sum(F.col("__before.__closed").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)) + 1
    rows = rows.withColumn("generation", generation).where(~F.col("__s.__closed"))
    return rows.select(key, "generation", *attributes, F.col(time).alias("valid_from_ns"), "valid_to_ns")


def overlapping(df: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """Intervals that reach into the next of their key; an open end must be the last."""
    rows = next_time(df, by, start, "__next", order=[F.col(end).asc_nulls_last()], span_ns=24 * 3_600_000_000_000)
    return rows.where(F.col("__next").isNotNull() & (F.col(end).isNull() | (F.col("__next") < F.col(end)))).drop("__next")


def lifecycle_faults(df: DataFrame, key: str, order: Sequence[str], state: str, legal: Mapping[str, Sequence[str]], first: str) -> DataFrame:
    """Rows that start in another state than ``first`` or follow a state that does not lead to theirs."""
    w = Window.partitionBy(key).orderBy(*order)
    before = F.lag(state).over(w)
    allowed = F.lit(False)
    for a, followers in legal.items():
        allowed = allowed | ((F.col("__before") == a) & F.col(state).isin(*followers))
    rows = df.withColumn("__before", before)
    fine = F.when(F.col("__before").isNull(), F.col(state) == first).otherwise(allowed)
    return rows.where(~fine).drop("__before")


def changes(df: DataFrame, by: Sequence[str], order: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """(by..., order..., attribute, before, after): one row for each attribute that changed."""
    w = Window.partitionBy(*by).orderBy(*order)
    pairs = [F.struct(F.lit(a).alias("attribute"), F.lag(F.col(a).cast("string")).over(w).alias("before"), F.col(a).cast("string").alias("after")) for a in attributes]
    first = F.row_number().over(w) == 1
    rows = df.select(*by, *order, F.array(*pairs).alias("__p"), first.alias("__f")).where("NOT __f")
    moved = rows.select(*by, *order, F.inline(F.filter("__p", lambda p: ~p["before"].eqNullSafe(p["after"]))))
    return moved


def transitions(df: DataFrame, by: Sequence[str], order: Sequence[str], measured: Sequence[str]) -> DataFrame:
    """Rows whose measured columns differ from those of the row before, and the first of each key."""
    w = Window.partitionBy(*by).orderBy(*order)
    here = F.struct(*measured)
    return df.withColumn("__b", F.lag(here).over(w)).where(F.col("__b").isNull() | ~here.eqNullSafe(F.col("__b"))).drop("__b")


def first_mismatch(a: DataFrame, b: DataFrame, by: Sequence[str], ordinal: str, value: str) -> DataFrame:
    """(by..., at): the first ordinal at which two ordered runs differ or one of them has ended."""
    both = a.select(*by, ordinal, F.col(value).alias("__a")).join(b.select(*by, ordinal, F.col(value).alias("__b")), [*by, ordinal], "full_outer")
    return both.where(~F.col("__a").eqNullSafe(F.col("__b"))).groupBy(*by).agg(F.min(ordinal).alias("at"))


def time_regressions(df: DataFrame, by: Sequence[str], order: Sequence[str], time: str, span: int = 1 << 16) -> DataFrame:
    """``df`` with ``regressed``: whether the time lies before the latest seen so far; in chunks of the first order column."""
    rows = carried(df, by, spans(order[0], span), order, maxima={"__seen": F.col(time)}, inclusive=False)
    return rows.withColumn("regressed", F.coalesce(F.col(time) < F.col("__seen"), F.lit(False))).drop("__seen")


def strictly_ascending(array: str) -> Column:
    """Whether an array is sorted and without repeats."""
    return (F.array_sort(array) == F.col(array)) & (F.size(F.array_distinct(array)) == F.size(array))
