"""Shards by a hierarchical weighted hash tree.

Shards hang under racks, racks under regions. A key starts at the root and at each level draws a number per
child from a hash of key and child, -ln(u) / weight, where a child's weight is that of the shards below it;
the smallest draw wins. Raising one child's weight only lowers that child's draws, so keys move into that
subtree and nowhere else. A shard that is added as a region of its own therefore takes rows only into itself.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

Tree = Mapping[str, Mapping[str, Mapping[int, float]]]  # region -> rack -> shard -> weight


def regular_tree(
    shards: int, shards_per_rack: int = 2, racks_per_region: int = 2, regions: int = 2
) -> dict[str, dict[str, dict[int, float]]]:
    """``regions`` regions of full racks, each shard with weight one; further shards stand alone.

    A shard outside these is a region of its own at any count, so that growing by one shard changes no other
    subtree's weight. Fewer shards than the regions hold fill those that they can and stand alone otherwise, so growth
    moves rows into the new shard only where it starts from full regions.
    """
    per_region = shards_per_rack * racks_per_region
    regular = min(shards // per_region, regions) * per_region
    tree: dict[str, dict[str, dict[int, float]]] = {}
    for shard in range(shards):
        if shard < regular:
            region, rack = f"region{shard // per_region}", f"rack{shard // shards_per_rack}"
        else:
            region, rack = f"single{shard}", f"single{shard}"
        tree.setdefault(region, {}).setdefault(rack, {})[shard] = 1.0
    return tree


def with_shard(tree: Tree, shard: int, weight: float = 1.0) -> dict[str, dict[str, dict[int, float]]]:
    """The tree and one more shard, as a region of its own."""
    grown = {region: {rack: dict(shards) for rack, shards in racks.items()} for region, racks in tree.items()}
    grown[f"single{shard}"] = {f"single{shard}": {shard: weight}}
    return grown


def _draw(key: Column, child: str, weight: float) -> Column:
    """-ln(u) / weight with u in (0, 1) from the first 52 bits of a digest of key and child."""
    digest = F.md5(F.concat(key, F.lit(f"|{child}")).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / F.lit(weight)


def _descend(key: Column, children: dict[str, tuple[float, Column]]) -> Column:
    """The result of the child with the smallest draw; equal draws go to the first child."""
    if len(children) == 1:
        return next(iter(children.values()))[1]
    drawn = [F.struct(_draw(key, name, w).alias("draw"), F.lit(n).alias("n")) for n, (name, (w, _)) in enumerate(children.items())]
    chosen = F.least(*drawn)["n"]
    parts = [(n, below) for n, (_, below) in enumerate(children.values())]
    return reduce(lambda rest, part: F.when(chosen == part[0], part[1]).otherwise(rest), reversed(parts[:-1]), parts[-1][1])


def shard_of(key: Column, tree: Tree) -> Column:
    """Shard number of a key (text; null counts as the text 'null'), built of Spark functions only."""
    key = F.coalesce(key.cast("string"), F.lit("null"))
    regions = {}
    for region, racks in tree.items():
        racked = {}
        for rack, shards in racks.items():
            leaves = {f"{region}/{rack}/{s}": (w, F.lit(s)) for s, w in shards.items()}
            racked[f"{region}/{rack}"] = (sum(shards.values()), _descend(key, leaves))
        regions[region] = (sum(w for w, _ in racked.values()), _descend(key, racked))
    return _descend(key, regions)


def numbered(rows: DataFrame, shard: str, keys: list[str], rows_per_bucket: int = 50_000) -> DataFrame:
    """``rows`` with ``slot``: gapless from 0 within each shard, by distributed counting.

    Rows fall into buckets by a hash of ``keys``; a bucket's first slot is the count of rows in the shard's
    earlier buckets, and rows are ordered within their bucket only. Rows equal in all keys are
    interchangeable. Neither a shard nor the table is ever in one task.
    """
    total = rows.count()
    buckets = max(1, -(-total // rows_per_bucket))
    placed = rows.withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    counts = placed.groupBy(shard, "__bucket").count()
    before = Window.partitionBy(shard).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(shard, "__bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__first"))
    within = Window.partitionBy(shard, "__bucket").orderBy(*keys)
    ranked = placed.withColumn("__n", F.row_number().over(within))
    return (
        ranked.join(first, [shard, "__bucket"])
        .withColumn("slot", (F.col("__first") + F.col("__n") - 1).cast("long"))
        .drop("__bucket", "__first", "__n")
    )


def sharded(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", tree: Tree | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row.

    The law is ``key``: id and shard count decide, and ``grown_shard`` is the shard with one more shard. A
    null text counts as empty (size 1, crc32 of nothing); all rows with a null id go to one shard. Repeated
    rows share a shard and get a slot each. An empty table gives an empty result; other columns are not read.
    """
    tree = tree or regular_tree(shards)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    key = F.col("doc_id")
    placed = rows.withColumns({"shard": shard_of(key, tree), "grown_shard": shard_of(key, with_shard(tree, shards))})
    slots = numbered(placed, "shard", ["doc_id", "text_crc32", "size"])
    return slots.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int"), "slot", F.col("grown_shard").cast("int")
    )
