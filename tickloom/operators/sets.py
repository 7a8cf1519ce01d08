"""Set operations on record and ledger tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.windows import carried


def with_markers(records: DataFrame, markers: DataFrame, order: Sequence[str]) -> DataFrame:
    """Records and gap markers in one order; at one time a gap stands before a record."""
    a = markers.withColumns({"kind": F.lit("gap"), "kind_rank": F.lit(0)})
    b = records.withColumns({"kind": F.lit("record"), "kind_rank": F.lit(1)})
    return a.unionByName(b, allowMissingColumns=True).orderBy(order[0], "kind_rank", *order[1:])


def disconnects(records: DataFrame, control: Column, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Records with a row of kind disconnect right behind each control record, and ``place`` in that order, from 1.

    A record's place is its number among the records plus the markers before it; both are counted in two passes along
    a key, in chunks of the values of the first order column.
    """
    made = F.array(F.lit("record"), F.lit("disconnect"))
    rows = records.select("*", F.posexplode(F.when(control, made).otherwise(F.slice(made, 1, 1))).alias("__rank", "kind"))
    return carried(rows, by, F.col(order[0]), [*order, "__rank"], sums={"place": F.lit(1).cast("long")}).drop("__rank")


def merged(current: DataFrame, archived: DataFrame, key: str, digest: Column) -> tuple[DataFrame, DataFrame]:
    """(rows once, conflicting keys): equal rows of both count once, different rows of one key conflict."""
    both = current.unionByName(archived).withColumn("__d", digest)
    conflicts = both.groupBy(key).agg(F.count_distinct("__d").alias("forms")).where("forms > 1").select(key)
    return both.dropDuplicates([key, "__d"]).drop("__d"), conflicts


def set_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(columns..., side): rows of either that the other lacks, counting repeats; empty if both agree."""
    return expected.exceptAll(actual).withColumn("side", F.lit("missing")).unionByName(actual.exceptAll(expected).withColumn("side", F.lit("extra")))


def inventory(expected: Column, acknowledged: Column) -> Column:
    """What a subscription lacks, has beyond, and has more than once."""
    return F.struct(
        F.size(F.array_except(expected, acknowledged)).alias("missing"),
        F.size(F.array_except(acknowledged, expected)).alias("extra"),
        (F.size(acknowledged) - F.size(F.array_distinct(acknowledged))).alias("repeated"),
    )


def run_comparison(a: DataFrame, b: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """(key, difference): keys of one run only, and keys whose values differ."""
    left = a.select(key, F.struct(*values).alias("__a"))
    right = b.select(key, F.struct(*values).alias("__b"))
    verdict = F.when(F.col("__a").isNull(), "only_second").when(F.col("__b").isNull(), "only_first").otherwise("differs")
    return left.join(right, key, "full_outer").where(~F.col("__a").eqNullSafe(F.col("__b"))).select(key, verdict.alias("difference"))
