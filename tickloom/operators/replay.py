"""Replay of a dataset in pages: records in key order with the gaps between them, and the checks of a reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators.windows import NS_PER_HOUR, carried, null_safe_join, spans


def pages(records: DataFrame, gaps: DataFrame, by: Sequence[str], time: str, rest: Sequence[str], size: int, span: int = NS_PER_HOUR) -> DataFrame:
    """Records and gaps with ``kind`` (record, gap), ``place`` from 1 in the order of the replay, and ``page`` from 0.

    The order is ``by``, ``time``, gaps before records, then ``rest``; a page has ``size`` records. A gap comes in the page of the
    record behind it, gaps behind the last record in the last page. Gaps share ``by``, ``time`` and ``rest``; their
    other columns are null for records, and the other way round. ``time`` is a whole number.

    Rows are counted along each key in chunks of ``span``, so a key with a third of all rows spreads over its chunks.
    Only one row per key is then accumulated over the keys, of which a dataset has as many as instruments.
    """
    both = gaps.withColumns({"kind": F.lit("gap"), "__rank": F.lit(0)}).unionByName(records.withColumns({"kind": F.lit("record"), "__rank": F.lit(1)}), allowMissingColumns=True)
    is_record = (F.col("kind") == "record").cast("long")
    rows = carried(both, by, spans(time, span), [time, "__rank", *rest], sums={"__place": F.lit(1).cast("long"), "__records": is_record})
    sizes = both.groupBy(*by).agg(F.count("*").alias("__n"), F.sum(is_record).alias("__m"))
    earlier = Window.partitionBy(F.lit(0)).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    starts = sizes.select(
        *by, F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__n"), F.coalesce(F.sum("__m").over(earlier), F.lit(0)).alias("__m"), F.sum("__m").over(every).alias("__all")
    )
    placed = null_safe_join(rows, starts, by)
    before = F.col("__m") + F.col("__records") - is_record
    last = F.greatest((F.col("__all") - 1), F.lit(0))
    return placed.withColumns(
        {"place": (F.col("__n") + F.col("__place")).cast("long"), "page": F.floor(F.least(before, last) / F.lit(size)).cast("long")}
    ).drop("__rank", "__place", "__records", "__n", "__m", "__all")


def checked(paged: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """(page, records, gaps, first_key, last_key, has_more, fault) of pages as they were served, by ``place``.

    ``fault`` is the first that holds of too_many (more than ``size`` records), not_ascending (a record's key does not lie
    beyond the one before it in the page) and not_past_cursor (nor does the first key lie beyond the last of the page
    before), else null. ``has_more`` tells whether another page follows. Pages are sorted one by one; a page meets the one
    before it by its number.
    """
    key = F.struct(*keys)
    record = F.col("kind") == "record"
    order = Window.partitionBy("page", "kind").orderBy("place")
    rows = paged.withColumn("__back", F.coalesce(record & (key <= F.lag(key).over(order)), F.lit(False)))
    found = rows.groupBy("page").agg(
        F.count_if(record).alias("records"), F.count_if(F.col("kind") == "gap").alias("gaps"), F.min_by(F.when(record, key), F.when(record, F.col("place"))).alias("first_key"),
        F.max_by(F.when(record, key), F.when(record, F.col("place"))).alias("last_key"), F.max("__back").alias("__back"),
    )
    before = found.select((F.col("page") + 1).alias("page"), F.col("last_key").alias("__cursor"))
    behind = found.select((F.col("page") - 1).alias("page"), F.lit(True).alias("__more"))
    fault = (
        F.when(F.col("records") > size, "too_many")
        .when(F.col("__back"), "not_ascending")
        .when(F.col("first_key") <= F.col("__cursor"), "not_past_cursor")
    )
    both = found.join(before, "page", "left").join(behind, "page", "left")
    return both.withColumns({"has_more": F.coalesce("__more", F.lit(False)), "fault": fault}).drop("__back", "__cursor", "__more")
