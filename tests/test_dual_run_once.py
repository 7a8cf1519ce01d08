"""Two runs share a pass over the events, and a comparison maps no message again."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import cutover, engine
from tickloom.plans import q_books
from tickloom.plans.catalogue import QUERIES

DATA = "/root/testdata/sf0.001"


def test_runs_of_one_pass_are_those_of_their_own_events(spark):
    events = q_books._single(spark, DATA).withColumns({"a": F.lit(True), "b": F.expr("event_id % 7 <> 0"), "c": F.expr("event_id % 3 = 0")})
    found = engine.reconstruct(events, "bridge", check_crossed=False, runs=["a", "b", "c"])
    for run in "abc":
        wanted = engine.reconstruct(events.where(run), "bridge", check_crossed=False)
        mine = found.where(F.col("run") == run).select(*wanted.columns)
        assert mine.count() == wanted.count() > 0
        assert mine.exceptAll(wanted).isEmpty()
    with pytest.raises(ValueError, match="polled"):
        engine.reconstruct(events, "reset", runs=["a"])


def test_nothing_is_mapped_or_rebuilt_again(spark):
    plan = QUERIES["t7_dual_run"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan and "event_type" not in plan and "MapInArrow" not in plan


def test_first_differences_are_those_of_plain_lists(spark):
    rng = random.Random(6)
    lists = {(s, side): [rng.choice([None, 1, 2]) if rng.random() < 0.1 else 5 for _ in range(rng.randrange(12))] for s in (None, "x", "y", "z", "u", "v") for side in "ab"}
    frame = lambda side: spark.createDataFrame([(s, n, v) for (s, k), of in lists.items() if k == side for n, v in enumerate(of)], "s string, index long, v long")
    wanted = set()
    for s in (None, "x", "y", "z", "u", "v"):
        a, b = lists[s, "a"], lists[s, "b"]
        for code, of in (("V", lambda x: x), ("W", lambda x: x == 1)):
            at = next((n for n in range(max(len(a), len(b))) if n >= min(len(a), len(b)) or of(a[n]) != of(b[n])), None)
            if at is not None:
                wanted.add((s, code, at))
    found = cutover.first_differences(frame("a"), frame("b"), ["s"], {"V": F.col("v"), "W": F.coalesce(F.col("v") == 1, F.lit(False))})
    assert {tuple(r) for r in found.collect()} == wanted
