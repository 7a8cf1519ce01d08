"""Order books as of any event or time, declaratively; seeding and chains of ids are in ``engine``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators.windows import NS_PER_HOUR, carried, spans


def book_at(levels: DataFrame, by: Sequence[str], upto: Column, order: Sequence[str]) -> DataFrame:
    """(by..., side, price, amount): the last action per price among the levels that ``upto`` keeps, deletes gone.

    One partial-then-final grouping on the price level; a busy instrument spreads over its prices.
    """
    last = F.max_by(F.struct("action", "amount"), F.struct(*order)).alias("l")
    rows = levels.where(upto).groupBy(*by, "side", "price").agg(last)
    return rows.where("l.action <> 'delete'").select(*by, "side", "price", "l.amount")


def top_levels(book: DataFrame, by: Sequence[str], depth: int) -> DataFrame:
    """Best levels: bids from the highest price, asks from the lowest, ``level`` from 1."""
    rank = F.when(F.col("side") == "buy", -F.col("price")).otherwise(F.col("price"))
    w = Window.partitionBy(*by, "side").orderBy(rank)
    return book.withColumn("level", F.row_number().over(w)).where(F.col("level") <= depth)


def sequence_gaps(updates: DataFrame, by: Sequence[str], order: Sequence[str], chained: bool = False, span: int = NS_PER_HOUR) -> DataFrame:
    """Updates behind a hole in their sequence. ``chained`` compares the previous-final id, else first ids.

    Updates at or below the running last id are stale and don't count; what is left follows the running last id itself.
    """
    rows = carried(updates, by, spans(order[0], span), order, maxima={"__last": F.col("last_sequence")}, inclusive=False)
    rows = rows.where(F.col("last_sequence") > F.col("__last"))
    hole = F.col("previous_sequence") != F.col("__last") if chained else F.col("first_sequence") > F.col("__last") + 1
    return rows.where(hole).drop("__last")


def latest_books(rows: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last full-replacement message of each key."""
    other = [c for c in rows.columns if c not in by]
    return rows.groupBy(*by).agg(F.max_by(F.struct(*other), F.struct(*order)).alias("r")).select(*by, "r.*")


def levels_of_events(events: DataFrame) -> DataFrame:
    """One row per level; an event without levels keeps one row with null level columns."""
    head = [c for c in events.columns if c not in ("bids", "asks")]
    return events.select(*head, F.posexplode_outer(F.concat("bids", "asks")).alias("ordinal", "l")).select(*head, "ordinal", "l.*")


def events_of_levels(levels: DataFrame, key: Sequence[str], header: Sequence[str]) -> DataFrame:
    """The inverse: levels by ordinal, and ``consistent``: ordinals run from 0 and the header repeats unchanged."""
    level = F.struct("ordinal", "side", "price", "amount")
    rows = levels.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.when(F.col("ordinal").isNotNull(), level))).alias("levels"),
        F.count_distinct(F.struct(*header)).alias("__h"),
        *(F.first(c).alias(c) for c in header),
    )
    gapless = F.coalesce(F.size("levels") == F.coalesce(F.array_max("levels.ordinal"), F.lit(-1)) + 1, F.lit(True))
    return rows.withColumn("consistent", (F.col("__h") == 1) & gapless).drop("__h")


def with_snapshots(updates: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Events for ``engine.reconstruct`` from updates and a second frame of snapshots of the same keys.

    Both are merged by the sort of each epoch, so neither side of a busy instrument is gathered, as cogrouping would.
    """
    kind = lambda df, name: df.withColumn("update_kind", F.lit(name))
    return kind(updates, "delta").unionByName(kind(snapshots, "snapshot"), allowMissingColumns=True)


# ---- ticker state -------------------------------------------------------------------------------------------


def sparse_state(rows: DataFrame, by: Sequence[str], order: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Each field's value in force: the last one present since the last snapshot.

    ``kind`` is snapshot or delta; each field has a boolean ``has_<field>`` that says whether the message named
    it, so that a named null or empty text is a value.
    """
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__seed", F.count_if(F.col("kind") == "snapshot").over(w))
    inner = Window.partitionBy(*by, "__seed").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    now = {f: F.last(F.when(F.col(f"has_{f}"), F.struct(F.col(f).alias("v"))), ignorenulls=True).over(inner)["v"] for f in fields}
    return rows.where("__seed > 0").withColumns({f"now_{f}": c for f, c in now.items()}).drop("__seed")


def ticker_state(rows: DataFrame, by: Sequence[str], order: Sequence[str], time: str, fields: Sequence[str]) -> DataFrame:
    """``rows`` with ``now_<field>`` and ``refused``: fields in force within a connection, by the rules of its stream.

    ``sparse_state`` within each epoch_id, over the rows that are accepted: a delta before the epoch's first snapshot is
    ``unseeded``, and a row whose ``time`` lies before an accepted one has ``time_regressed``; neither changes anything.
    """
    key = [*by, "epoch_id"]
    w = Window.partitionBy(*key).orderBy(*order)
    upto, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__seeded", F.count_if(F.col("kind") == "snapshot").over(upto) > 0)
    seen = F.max(F.when(F.col("__seeded"), F.col(time))).over(before)
    refused = F.when(~F.col("__seeded"), "unseeded").when(F.col(time) < seen, "time_regressed")
    rows = rows.withColumn("refused", refused).drop("__seeded")
    kept = sparse_state(rows.where("refused IS NULL"), key, order, fields)
    return kept.unionByName(rows.where("refused IS NOT NULL"), allowMissingColumns=True)


def open_interest_variants(contracts: Column, base: Column, quote: Column) -> Column:
    """The given open-interest readings as a list; both-sided unless the venue says one."""
    items = [F.when(c.isNotNull(), F.struct(F.lit(k).alias("unit"), c.cast("decimal(38,18)").alias("value"), F.lit("two_sided").alias("sides"))) for k, c in (("contracts", contracts), ("base", base), ("quote", quote))]
    return F.array_compact(F.array(*items))
