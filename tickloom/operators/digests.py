"""Digests of rows, and of many rows as a tree over prefixes of their hashes, in which two tables can be compared."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.scalars import digest
from tickloom.operators.windows import NS_PER_HOUR, carried, null_safe_join, spans

#: A node with this many different rows or fewer is a leaf: its digest is over its rows.
LEAF_ROWS = 1024


def row_hash(df: DataFrame, leave_out: Sequence[str] = ()) -> Column:
    """Hash over all columns of a row, by name; leave some out for a semantic hash."""
    names = sorted(c for c in df.columns if c not in set(leave_out))
    return digest(*(p for c in names for p in (F.lit(c), F.to_json(F.struct(c)) if _nested(df, c) else F.col(c))))


def _nested(df: DataFrame, name: str) -> bool:
    return df.schema[name].dataType.typeName() in ("array", "map", "struct", "variant")


def depth_for(rows: int, leaf_rows: int = LEAF_ROWS) -> int:
    """Hex digits after which a branch holds a sixteenth of a leaf or less on average, so that none exceeds a leaf."""
    depth = 0
    while rows > leaf_rows << 4 * depth:
        depth += 1
    return depth + 1 if depth else 0


def _depth(df: DataFrame, by: Sequence[str], leaf_rows: int) -> int:
    largest = df.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
    return depth_for(largest or 0, leaf_rows)


def _leaves(hashed: DataFrame, by: Sequence[str], depth: int) -> DataFrame:
    """Nodes (by..., prefix, k different rows, n rows, the rows in order of hash, digest) at ``depth``."""
    counted = hashed.groupBy(*by, "__h").count()
    rows = F.array_sort(F.collect_list(F.concat_ws("*", "__h", "count"))).alias("rows")
    nodes = counted.groupBy(*by, F.substring("__h", 1, depth).alias("prefix")).agg(F.count("*").alias("k"), F.sum("count").alias("n"), rows)
    return nodes.withColumn("digest", F.sha2(F.array_join("rows", ","), 256))


def _parents(nodes: DataFrame, by: Sequence[str], depth: int, leaf_rows: int) -> DataFrame:
    """The nodes one digit higher. Rows go up only while they fit a leaf."""
    kids = F.array_sort(F.collect_list(F.struct("prefix", "digest", "rows")))
    up = nodes.groupBy(*by, F.substring("prefix", 1, depth - 1).alias("__p")).agg(F.sum("k").alias("k"), F.sum("n").alias("n"), kids.alias("__kids"))
    small = F.col("k") <= leaf_rows
    rows = F.when(small, F.flatten(F.transform("__kids", lambda x: x["rows"])))
    inner = F.array_join(F.transform("__kids", lambda x: F.concat_ws(":", F.right(x["prefix"], F.lit(1)), x["digest"])), ",")
    up = up.withColumn("rows", rows).withColumn("digest", F.sha2(F.when(small, F.array_join("rows", ",")).otherwise(inner), 256))
    return up.select(*by, F.col("__p").alias("prefix"), "k", "n", "rows", "digest")


def levels_of(df: DataFrame, by: Sequence[str], depth: int, leaf_rows: int = LEAF_ROWS) -> list[DataFrame]:
    """Nodes from the root (no digits) down to ``depth`` digits."""
    levels = [_leaves(df.select(*by, row_hash(df, by).alias("__h")), by, depth)]
    for d in range(depth, 0, -1):
        levels.insert(0, _parents(levels[0], by, d, leaf_rows))
    return levels


def multiset_digest(df: DataFrame, by: Sequence[str] = (), leaf_rows: int = LEAF_ROWS, depth: int | None = None) -> DataFrame:
    """(by..., n, digest): a digest of the rows of each group, whatever their order; repeats count.

    The digest is that of the root of a tree over hash prefixes: a node with ``leaf_rows`` different rows or fewer hashes
    its rows, each with its count, in order; a larger one the digests of its sixteen children. That depends on the
    group's rows alone. Equal rows are counted before they move, rows move once to leaves, and above them only up to
    sixteen digests a node do, so no task gathers more than a leaf. The tree is as deep as the largest group needs,
    which is counted first unless ``depth`` is given (``depth_for``; deeper than needed changes nothing).
    """
    deep = _depth(df, by, leaf_rows) if depth is None else depth
    return levels_of(df, by, deep, leaf_rows)[0].select(*by, "n", "digest")


def ordered_digest(df: DataFrame, order: Sequence[str], by: Sequence[str] = (), leaf_rows: int = LEAF_ROWS, span: int = NS_PER_HOUR) -> DataFrame:
    """(by..., n, digest): a digest that binds each row to its place, from 1, in ``order`` within its group.

    Places are counted in chunks of ``span`` of the first order column, so a large group is not sorted in one task.
    """
    placed = carried(df, by, spans(order[0], span), order, sums={"position": F.lit(1).cast("long")})
    return multiset_digest(placed, by, leaf_rows)


def differences(a: DataFrame, b: DataFrame, by: Sequence[str] = (), leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(by..., prefix, row_hash, n_a, n_b): rows, by hash, that ``a`` and ``b`` hold unequally often, and their branch.

    The trees are walked down from the root: only branches whose digests differ are opened, and rows are compared where
    a branch fits a leaf on both sides. The levels are written once to the folder that the cluster shares.
    """
    from tickloom.sources.tables import shared_folder

    depth = max(_depth(x, by, leaf_rows) for x in (a, b))
    spark = a.sparkSession

    def held(df: DataFrame) -> DataFrame:
        folder = shared_folder(spark)
        df.write.parquet(folder)
        return spark.read.schema(df.schema).parquet(folder)

    trees = []
    for x in (a, b):
        levels = [held(_leaves(x.select(*by, row_hash(x, by).alias("__h")), by, depth))]
        for d in range(depth, 0, -1):
            levels.insert(0, held(_parents(levels[0], by, d, leaf_rows)))
        trees.append(levels)
    found, within = [], None
    for d, (left, right) in enumerate(zip(*trees, strict=True)):
        named = [x.select(*by, "prefix", F.col("digest").alias(f"d_{s}"), F.col("rows").alias(f"r_{s}"), F.col("k").alias(f"k_{s}")) for x, s in ((left, "a"), (right, "b"))]
        if within is not None:
            # one more digit: only below the branches that differ above
            named = [null_safe_join(x.withColumn("__up", F.substring("prefix", 1, d - 1)), within, [*by, "__up"], "left_semi").drop("__up") for x in named]
        both = held(_either(*named, [*by, "prefix"]).where("NOT d_a <=> d_b"))
        fits = (F.coalesce("k_a", F.lit(0)) <= leaf_rows) & (F.coalesce("k_b", F.lit(0)) <= leaf_rows)
        found.append(_unequal_rows(both.where(fits | F.lit(d == depth)), by))
        within = both.where(~fits).select(*by, F.col("prefix").alias("__up"))
    return reduce(DataFrame.unionByName, found)


def _either(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A full outer join in which null keys equal each other, by grouping; each key is once on each side."""
    rest = [c for c in (*a.columns, *b.columns) if c not in keys]
    both = a.unionByName(b, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*(F.first(c, ignorenulls=True).alias(c) for c in rest))


def _unequal_rows(branches: DataFrame, by: Sequence[str]) -> DataFrame:
    def entries(side: str) -> Column:
        count = lambda x: F.split_part(x, F.lit("*"), F.lit(2)).cast("long")
        entry = lambda x: F.struct(F.split_part(x, F.lit("*"), F.lit(1)).alias("h"), count(x).alias("n"), F.lit(side).alias("s"))
        return F.transform(F.coalesce(f"r_{side}", F.array().cast("array<string>")), entry)

    rows = F.concat(entries("a"), entries("b"))
    each = branches.select(*by, "prefix", F.inline(rows))
    sides = [F.coalesce(F.max(F.when(F.col("s") == s, F.col("n"))), F.lit(0)).alias(f"n_{s}") for s in "ab"]
    return each.groupBy(*by, "prefix", F.col("h").alias("row_hash")).agg(*sides).where("n_a <> n_b")


def digest_sql(rows: str, by: str, leaf_rows: int = LEAF_ROWS, depth: int = 4) -> str:
    """``multiset_digest`` in SQL, for tables that ``depth`` suffices for; ``rows`` gives ``by`` and the row hash ``h``."""
    steps = [
        f"e AS (SELECT {by}, h, count(*) AS c FROM ({rows}) GROUP BY ALL)",
        f"l{depth} AS (SELECT {by}, substr(h, 1, {depth}) AS p, count(*) AS k, sum(c) AS n, string_agg(h || '*' || c, ',' ORDER BY h) AS r FROM e GROUP BY ALL)",
        f"n{depth} AS (SELECT *, sha256(r) AS d FROM l{depth})",
    ]
    for d in range(depth, 0, -1):
        steps.append(
            f"""l{d - 1} AS (SELECT {by}, substr(p, 1, {d - 1}) AS q, sum(k) AS k, sum(n) AS n, string_agg(r, ',' ORDER BY p) AS r,
            string_agg(substr(p, {d}, 1) || ':' || d, ',' ORDER BY p) AS kids FROM n{d} GROUP BY {by}, substr(p, 1, {d - 1}))"""
        )
        steps.append(f"n{d - 1} AS (SELECT {by}, q AS p, k, n, r, CASE WHEN k <= {leaf_rows} THEN sha256(r) ELSE sha256(kids) END AS d FROM l{d - 1})")
    return f"WITH {', '.join(steps)} SELECT {by}, n::BIGINT AS n, d AS digest FROM n0"
