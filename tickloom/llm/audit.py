"""How filters interact when they are applied in any order: a walk over the lattice of applied filters.

A state is the set of filters applied so far, an edge applies one more. All orders are the paths from the empty set to
the full one, so what an edge removes counts once for each path through it: the paths reaching its lower end times the
paths leaving its upper end. One grouping of the documents by which filters they fail feeds all edges; the steps of
every order are read from the same edges.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.exact import copies

WORD = r"[^\x20\x09-\x0D]+"


def path_counts(filters: int) -> tuple[list[int], list[int]]:
    """(paths from the empty set to each state, paths from each state to the full set), counted edge by edge."""
    states = 1 << filters
    reaching, leaving = [1] + [0] * (states - 1), [0] * (states - 1) + [1]
    for state in range(states):
        for f in range(filters):
            if not state >> f & 1:
                reaching[state | 1 << f] += reaching[state]
    for state in reversed(range(states)):
        for f in range(filters):
            if not state >> f & 1:
                leaving[state] += leaving[state | 1 << f]
    return reaching, leaving


def edges_of(cells: DataFrame, filters: int) -> DataFrame:
    """(part, state, filter, paths, and the counts) of every edge, zeros included.

    ``cells`` has part, mask (bit f: fails filter f), n, good and toxic. Each cell, at most 2^filters a part, goes to
    each of the filters * 2^(filters-1) edges, whatever the number of documents.
    """
    reaching, leaving = path_counts(filters)
    every = [(s, f, reaching[s] * leaving[s | 1 << f]) for s in range(1 << filters) for f in range(filters) if not s >> f & 1]
    listed = F.array(*(F.struct(F.lit(s).alias("state"), F.lit(f).alias("filter"), F.lit(p).cast("long").alias("paths")) for s, f, p in every))
    met = cells.select("*", F.inline(listed)).withColumn("bit", F.expr("shiftleft(1, filter)"))
    fails, early = F.expr("mask & bit <> 0"), F.expr("mask & state <> 0")
    total = lambda rows, c: F.sum(F.when(rows, F.col(c)).otherwise(0)).cast("long").alias
    return met.groupBy("part", "state", "filter", "paths").agg(
        total(~fails & ~early, "n")("kept"),
        total(fails & ~early, "n")("removed"),
        total(fails & early, "n")("redundant"),
        total(F.col("mask") == F.col("bit"), "n")("unique_fails"),
        total(fails & ~early, "good")("good_lost"),
        total(fails & ~early, "toxic")("toxic_lost"),
    )


def orders_of(names: Sequence[str]) -> list[tuple[str, int, int, int]]:
    """(order, step from 1, state before it, filter) of every step of every order."""
    return [
        ("".join(names[f] for f in order), step, sum(1 << f for f in order[: step - 1]), order[step - 1])
        for order in permutations(range(len(names)))
        for step in range(1, len(names) + 1)
    ]


def interaction_audit(cells: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per part, order and step with the counts at that step and the filter's Shapley sum over all orders.

    The table of orders has len(names)! * len(names) rows, so up to seven filters; its size hangs on nothing else.
    """
    if len(names) > 7:
        raise ValueError("more than seven filters have too many orders to list")
    edges = edges_of(cells, len(names))
    shapley = edges.groupBy("part", "filter").agg(F.sum(F.col("paths") * F.col("removed")).cast("long").alias("shapley"))
    steps = cells.sparkSession.createDataFrame(orders_of(names), "filter_order string, step int, state int, filter int")
    rows = edges.join(F.broadcast(steps), ["state", "filter"]).join(shapley, ["part", "filter"])
    return rows.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def own_faults(text: Column) -> dict[str, Column]:
    """The failure conditions that a text shows by itself; the text is not null."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": F.length(F.regexp_replace(text, "[^A-Z]", "")) * 100 > F.length(text) * 3,
        "D": text.rlike(r"[#$%&*|]"),
    }


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of five filters over whole ``documents``: A short, B repetitive, C upper case, D signs, E copies.

    A document fails E if a smaller doc_id has the same text, anywhere in the table. Part is ``lang`` (null: empty
    string). Null texts count as empty and are copies of empty ones; a row without an id has no labels and never fails
    E, nor makes others fail; rows that repeat an id don't fail E through each other. An id that several label rows
    name is good or toxic if one of them says so. Texts are read whole, whatever their length. Other columns are not
    read; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bits = [F.when(fails, F.lit(1 << n)).otherwise(0) for n, fails in enumerate(own_faults(text).values())]
    own = bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])
    carry = {"part": F.coalesce(F.col("lang").cast("string"), F.lit("")), "mask": own}
    found = copies(docs, keep="smallest", normal=lambda t: t, carry=carry)
    copied = F.coalesce(F.col("doc_id") > F.col("keep_id"), F.lit(False))
    flagged = found.withColumn("mask", F.col("mask").bitwiseOR(F.when(copied, 16).otherwise(0)))
    counted = flagged.groupBy("doc_id", "part", "mask").agg(F.count("*").alias("n"))
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.bool_or(F.col("quality") == 1).alias("good"), F.bool_or(F.col("toxic") == 1).alias("toxic")
    )
    marked = counted.join(marks.where("doc_id IS NOT NULL"), "doc_id", "left")
    times = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c)
    return interaction_audit(marked.groupBy("part", "mask").agg(F.sum("n").alias("n"), times("good"), times("toxic")), "ABCDE")


ORACLE = rf"""WITH RECURSIVE d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '{WORD}') AS ws FROM d),
m AS (SELECT doc_id, part, (len(ws) < 200)::INTEGER + 2 * (100 * len(list_distinct(ws)) < 50 * len(ws))::INTEGER
    + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INTEGER + 8 * regexp_matches(t, '[#$%&*|]')::INTEGER
    + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INTEGER AS mask FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
c AS (SELECT part, mask, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
p AS (SELECT '' AS o UNION ALL SELECT o || f FROM p, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(f) WHERE NOT contains(o, f)),
s AS (SELECT o, k, 1 << (ascii(o[k]) - 65) AS bit, list_sum([1 << (ascii(x) - 65) for x in string_split(o[1:k - 1], '') if x <> '']) AS before
    FROM p, range(1, 6) r(k) WHERE length(o) = 5),
j AS (SELECT part, o AS filter_order, k::INTEGER AS step, bit, sum(n) FILTER (mask & (bit | coalesce(before, 0)) = 0) AS kept,
    sum(n) FILTER (mask & bit <> 0 AND mask & coalesce(before, 0) = 0) AS removed,
    sum(n) FILTER (mask & bit <> 0 AND mask & coalesce(before, 0) <> 0) AS redundant, sum(n) FILTER (mask = bit) AS unique_fails,
    sum(good) FILTER (mask & bit <> 0 AND mask & coalesce(before, 0) = 0) AS good_lost,
    sum(toxic) FILTER (mask & bit <> 0 AND mask & coalesce(before, 0) = 0) AS toxic_lost FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, {", ".join(f"coalesce({x}, 0)::BIGINT AS {x}" for x in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
    coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley FROM j"""
