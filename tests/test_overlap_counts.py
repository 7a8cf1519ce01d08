"""Counts of overlapping intervals against all pairs; a gap's pairs are not joined one by one."""

import random

from tickloom.operators import joins


def test_counts_are_those_of_the_pairs(spark):
    rng = random.Random(5)

    def some(n):
        made = []
        for _ in range(n):
            a = rng.randrange(40)
            made.append((rng.choice(["x", "y", None]), a, None if rng.random() < 0.15 else a + rng.randrange(-1, 9)))
        return made

    lefts, rights = some(60), [(i, *r) for i, r in enumerate(some(60))]
    left = spark.createDataFrame(lefts, "k string, l_start long, l_end long")
    right = spark.createDataFrame(rights, "id long, k string, r_start long, r_end long")
    end = lambda e: float("inf") if e is None else e
    wanted = {}
    for i, k, a, b in rights:
        n = sum(k is not None and k == q and a < end(b) and c < end(e) and c < end(b) and a < end(e) for q, c, e in lefts)
        if n:
            wanted[i] = n
    found = joins.overlap_counts(left, right, ["k"], span=4)
    assert {r.id: r.n for r in found.collect()} == wanted
    pairs = joins.overlapping_pairs(left, right, ["k"]).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in pairs} == wanted
    out = joins.repeated(found.select("id", "n"), "n", block=3).groupBy("id").count().collect()
    assert {r.id: r["count"] for r in out} == wanted
