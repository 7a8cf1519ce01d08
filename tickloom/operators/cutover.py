"""Two runs of a mapping over one corpus, compared before the second takes over."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators.digests import row_hash
from tickloom.operators.windows import NS_PER_HOUR, carried, null_safe_join, spans

# The kinds of a difference, in the order of a report.
ACCEPTED, REJECTED, COUNTS, ROWS, BOOK, BOOK_HASH = (
    "accepted_field_identity", "rejection_projection", "rejection_counts", "ordered_semantic_row_hash", "downstream_book_result", "downstream_book_hash",
)


@dataclass(frozen=True)
class Run:
    """What one mapper made of a corpus: accepted rows, refused records with their code, and books' linked epochs."""

    accepted: DataFrame
    rejected: DataFrame
    epochs: DataFrame | None = None


def placed(rows: DataFrame, by: Sequence[str], order: Sequence[str], span: int) -> DataFrame:
    """``rows`` with ``index``, from 0, in ``order`` within each scope; a busy scope is numbered in chunks."""
    numbered = carried(rows, by, spans(order[0], span), order, sums={"__n": F.lit(1).cast("long")})
    return numbered.withColumn("index", F.col("__n") - 1).drop("__n")


def first_differences(a: DataFrame, b: DataFrame, by: Sequence[str], values: Mapping[str, Column]) -> DataFrame:
    """(by..., code, index): where two numbered lists first differ in each of the named values, also where one of them ends.

    One join serves all values. Null scopes are a scope.
    """
    names = {code: f"__v{n}" for n, code in enumerate(values)}
    wrapped = [F.struct(v.alias("v")).alias(names[code]) for code, v in values.items()]
    left, right = (df.select(*(F.col(c).alias(f"__{s}_{c}") for c in (*by, "index")), F.struct(*wrapped).alias(f"__{s}")) for df, s in ((a, "a"), (b, "b")))
    both = left.join(right, [F.col(f"__a_{c}").eqNullSafe(F.col(f"__b_{c}")) for c in by] + [F.col("__a_index") == F.col("__b_index")], "full_outer")
    here = lambda c: F.when(F.col("__a").isNull(), F.col(f"__b_{c}")).otherwise(F.col(f"__a_{c}")).alias(c)
    differs = [F.min(F.when(~F.col(f"__a.{v}").eqNullSafe(F.col(f"__b.{v}")), here("index"))).alias(v) for v in names.values()]
    found = both.groupBy(*(here(c) for c in by)).agg(*differs)
    listed = F.array(*(F.struct(F.lit(code).alias("code"), F.col(v).alias("index")) for code, v in names.items()))
    return found.select(*by, F.inline(listed)).where("index IS NOT NULL")


def compare_runs(
    baseline: Run,
    candidate: Run,
    scope: Sequence[str],
    order: Sequence[str],
    identity: Sequence[str],
    mapper_columns: Sequence[str] = ("mapper_version",),
    book_scope: Sequence[str] = ("instrument_uid",),
    span: int = NS_PER_HOUR,
) -> DataFrame:
    """(scope text, code, index): the first place, per scope, in which two runs differ in each of six ways.

    Accepted rows are compared in ``order`` by ``identity`` and then by all they mean, that is without ``mapper_columns``;
    refusals by record and code, and by the counts of their codes, in order of code; books by state, close reason,
    counts and last id of their epochs, and by their digests. Nothing is given for runs that agree, and only such a
    candidate may be published. Frames of a run are read several times, so what is dear to make should be files.
    """
    found = []
    name = lambda df, by: df.select(F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by)).alias("scope"), "code", "index")
    # rows are hashed before they are numbered, so that no others of their columns are shuffled
    meant = [r.accepted.select(*dict.fromkeys([*scope, *order, *identity]), F.unhex(row_hash(r.accepted, mapper_columns)).alias("__h")) for r in (baseline, candidate)]
    accepted = [placed(x, scope, order, span) for x in meant]
    found.append(name(first_differences(*accepted, scope, {ACCEPTED: F.struct(*identity), ROWS: F.col("__h")}), scope))
    refused = [placed(r.rejected.select(*dict.fromkeys([*scope, *order, *identity, "code"])), scope, order, span) for r in (baseline, candidate)]
    found.append(name(first_differences(*refused, scope, {REJECTED: F.struct(*identity, "code")}), scope))
    counts = [r.rejected.groupBy(*scope, F.col("code").alias("__c")).agg(F.count("*").alias("__n")) for r in (baseline, candidate)]
    codes = counts[0].select(*scope, "__c").union(counts[1].select(*scope, "__c")).distinct()
    codes = codes.withColumn("index", F.row_number().over(Window.partitionBy(*scope).orderBy("__c")).cast("long") - 1)
    listed = [null_safe_join(codes, c, [*scope, "__c"]) for c in counts]
    found.append(name(first_differences(*listed, scope, {COUNTS: F.coalesce("__n", F.lit(0))}), scope))
    if baseline.epochs is not None and candidate.epochs is not None:
        epochs = [r.epochs.withColumn("index", F.col("number") - 1) for r in (baseline, candidate)]
        result = F.struct("state", "close_reason", "accepted", "applied", "stale", "gaps", "refused", "last_sequence")
        found.append(name(first_differences(*epochs, book_scope, {BOOK: result, BOOK_HASH: F.col("output_digest")}), book_scope))
    return reduce(DataFrame.unionByName, found)
