"""Exact copies: rows grouped by a 128-bit hash of the normalised text, bytes compared inside the groups.

Only hashes and ids are shuffled to form the groups. Texts are fetched for groups of two rows or more, to see that
a group holds one text; a group that holds several is told apart by the texts themselves. Spark functions throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import cut, drop_cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Ids below and above all others, for rows without one.
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case and nothing else."""
    return F.translate(text, UPPER, LOWER)


def md5_bytes(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _groups(rows: DataFrame, key: list[str], keep: str) -> DataFrame:
    """Size and chosen row of each key with two rows or more; counted per task before anything moves."""
    if keep == "largest":
        chosen, named = F.max_by("__row", F.coalesce("__id", F.lit(LEAST))), F.max("__id")
    else:
        chosen, named = F.min_by("__row", F.coalesce("__id", F.lit(MOST))), F.min("__id")
    grouped = rows.groupBy(*key).agg(F.count("*").alias("__size"), chosen.alias("__chosen"), named.alias("__keep"))
    return grouped.where("__size > 1")


def _joined(rows: DataFrame, groups: DataFrame, key: list[str]) -> DataFrame:
    """Each row with size, chosen row and kept id of its group; a row that is in none of ``groups`` is alone."""
    return rows.join(groups, key, "left").withColumns(
        {
            "__keep": F.when(F.col("__size").isNull(), F.col("__id")).otherwise(F.col("__keep")),
            "__kept": F.coalesce(F.col("__chosen") == F.col("__row"), F.lit(True)),
            "__size": F.coalesce("__size", F.lit(1)),
        }
    )


def _labelled(rows: DataFrame, groups: DataFrame, total: int) -> DataFrame:
    """``_joined`` by hash; groups above a thousandth of the rows, 1000 at most, are broadcast."""
    busy = F.broadcast(groups.where(F.col("__size") > total / 1000))
    only = busy.select("__hash")
    rest = groups.where(F.col("__size") <= total / 1000)
    return _joined(rows.join(only, "__hash", "left_semi"), busy, ["__hash"]).unionByName(
        _joined(rows.join(only, "__hash", "left_anti"), rest, ["__hash"])
    )


def copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    normal: Callable[[Column], Column] = lower_ascii,
    carry: Mapping[str, Column] | None = None,
    digest: Callable[[Column], Column] = md5_bytes,
    broadcast_groups: int = 100_000,
) -> DataFrame:
    """(doc_id, carry..., keep_id, group_size, kept) for every row: equal texts are those with equal ``normal(text)``.

    Of equal texts the row with the ``keep`` ("smallest" or "largest") id stays; rows that also share the id are
    repeats of each other and exactly one of them stays. Rows without an id give way to those with one; a group in
    which no row has an id keeps one row and ``keep_id`` is null. A null text counts as empty, so null and empty texts
    are one group. Texts of any length are compared whole. ``carry`` names further expressions over ``docs`` to
    keep. An empty table gives an empty result; columns of ``docs`` that are not named are not read, so their names
    can't clash.

    A group above a thousandth of the rows is joined by broadcast (there can be at most 1000 of those), all others
    by their hash, so no task meets more than a thousandth of the rows under one key. The hashes of repeated groups
    are broadcast to filter the texts that are compared if there are ``broadcast_groups`` or fewer; beyond that all
    texts are grouped, pre-aggregated in each task. Rows of hashes that several texts share, if there are any, are
    grouped and joined by hash and text.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep must be smallest or largest, not {keep!r}")
    carry = dict(carry or {})
    text = normal(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    keyed = docs.select(
        F.col(id_col).cast("long").alias("__id"),
        digest(text).alias("__hash"),
        F.monotonically_increasing_id().alias("__row"),
        text.alias("__text"),
        *(c.alias(name) for name, c in carry.items()),
    )
    rows = cut(keyed.drop("__text"))
    groups = cut(_groups(rows, ["__hash"], keep))
    texts = keyed.select("__hash", "__text")
    if groups.count() <= broadcast_groups:
        texts = texts.join(F.broadcast(groups.select("__hash")), "__hash", "left_semi")
    several = cut(texts.groupBy("__hash").agg(F.count_distinct("__text").alias("n")).where("n > 1").select("__hash"))
    total = rows.count()
    if several.isEmpty():
        drop_cut(several)
        found = _labelled(rows, groups, total)
    else:
        shared = cut(keyed.join(several, "__hash", "left_semi"))
        key = ["__hash", "__text"]
        apart = _joined(shared, _groups(shared, key, keep), key)
        clear = [x.join(several, "__hash", "left_anti") for x in (rows, groups)]
        found = _labelled(*clear, total).unionByName(apart.drop("__text"))
    return found.select(
        F.col("__id").alias("doc_id"), *carry, F.col("__keep").alias("keep_id"), F.col("__size").alias("group_size"), F.col("__kept").alias("kept")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """``copies`` with ``text_sha256``, the digest of the normalised text, for every row."""
    text = lower_ascii(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    return copies(docs, id_col, text_col, keep, carry={"text_sha256": F.sha2(text.cast("binary"), 256)})


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows with equal id and equal text, one."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    hashed = docs.withColumns({"__id": F.col(id_col).cast("long"), "__sha": F.sha2(lower_ascii(text).cast("binary"), 256)})
    kept = exact_dedup(docs, id_col, text_col, keep).where("kept").select(F.col("doc_id").alias("__id2"), F.col("text_sha256").alias("__sha2"))
    same = F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__sha") == F.col("__sha2"))
    return hashed.join(kept, same, "left_semi").dropDuplicates(["__id", "__sha"]).drop("__id", "__sha")


ORACLE = f"""SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
    sha256(t) AS text_sha256 FROM (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents) WINDOW same AS (PARTITION BY t)"""
