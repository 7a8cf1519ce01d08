"""Keyed streams over several batches and a restart, each against its batch form."""

from __future__ import annotations

import random
from decimal import Decimal

from tickloom.operators import books, engine, quality
from tickloom.sources import tables
from tickloom.streaming import jobs, keyed

MINUTE = 60_000_000_000


def batches(spark, rows, schema, make, parts=3):
    """What a stream of ``rows`` gives: one file a batch, and the last one after a restart."""
    folder = tables.shared_folder(spark)
    cut = [rows[n * len(rows) // parts : (n + 1) * len(rows) // parts] for n in range(parts)]
    for n, part in enumerate(cut):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        if n >= parts - 2:  # the first call runs all batches but the last, the second one is a restart
            stream = jobs.stream_files(spark, f"{folder}/in", spark.createDataFrame([], schema).schema, 1)
            out = keyed.drained(make(stream), folder)
    return out


def same(found, wanted):
    pick = sorted(wanted.columns)
    table = lambda f: sorted(map(repr, map(tuple, f.select(*pick).collect())))
    assert table(found) == table(wanted) and wanted.count()


def test_ticker_clears_on_reconnect_and_refuses_old_times(spark):
    rng = random.Random(3)
    rows = []
    for n in range(240):
        kind = "snapshot" if rng.random() < 0.1 else "delta"
        time = n * 10 - rng.choice([0, 0, 0, 0, 35])
        mark = rng.choice([None, "", str(n)])
        rows.append((f"I{n % 3}", f"e{n // 50}", n, time, kind, rng.random() < 0.5, mark, rng.random() < 0.5, n))
    schema = "instrument_uid string, epoch_id string, ordinal long, time_ns long, kind string, has_mark boolean, mark string, has_rate boolean, rate long"
    how = (["instrument_uid"], ["ordinal"], "time_ns", ["mark", "rate"])
    found = batches(spark, rows, schema, lambda s: keyed.ticker(s, *how, ["epoch_id", "ordinal"]))
    wanted = books.ticker_state(spark.createDataFrame(rows, schema), *how)
    assert {r.refused for r in wanted.select("refused").distinct().collect()} == {None, "unseeded", "time_regressed"}
    same(found, wanted.select("instrument_uid", "epoch_id", "ordinal", "now_mark", "now_rate", "refused"))


def plain_ledger(rows):
    held, out = {}, {}
    for k, at, kind, gap, start, end in sorted(rows, key=lambda r: (r[1], r[2] != "gap", r[3] or "")):
        if kind == "gap" and k not in held:
            held[k] = gap
            out[k, gap] = (k, gap, start, end, None, "open")
        elif kind != "gap" and k in held:
            gap = held.pop(k)
            out[k, gap] = (*out[k, gap][:4], at, kind)
    return sorted(map(repr, out.values()))


def test_gap_ledger_opens_once_and_ends_once(spark):
    rng = random.Random(5)
    rows = []
    for n in range(300):
        kind = rng.choice(["gap", "gap", "recovered", "permanent"])
        k = rng.choice(["a", "b", None])
        rows.append((k, n * MINUTE, kind, f"g{n:03}" if kind == "gap" else None, n if kind == "gap" else None, n + 1 if kind == "gap" else None))
    rows += [("c", 5 * MINUTE, "gap", "gc", 0, 1), ("c", 5 * MINUTE, "gap", "gb", 0, 1), ("c", 5 * MINUTE, "recovered", None, None, None)]
    rows.sort(key=lambda r: r[1])
    schema = "k string, at_ns long, kind string, gap_id string, start_ns long, end_ns long"
    batch = quality.gap_lifecycle(spark.createDataFrame(rows, schema), ["k"], span_ns=10 * MINUTE)
    assert sorted(map(repr, map(tuple, batch.collect()))) == plain_ledger(rows)
    found = batches(spark, rows, schema, lambda s: keyed.gap_ledger(s, ["k"]))
    steps = [tuple(r) for r in found.collect()]
    opened = {r[1] for r in steps if r[5] == "open"}
    ended = {r[1]: r for r in steps if r[5] != "open"}
    assert len(steps) == len(opened) + len(ended) and opened == {r.gap_id for r in batch.collect()}
    assert sorted(map(repr, [ended.get(r[1], r) for r in steps if r[5] == "open"])) == plain_ledger(rows)


def test_silence_is_told_by_a_timer_or_by_the_next_row(spark):
    rng = random.Random(7)
    rows = sorted((rng.randrange(0, 600) * MINUTE + rng.randrange(1000), f"k{rng.randrange(6)}") for _ in range(150))
    rows = [(k, at) for at, k in rows] + [("k0", 900 * MINUTE), ("k0", 900 * MINUTE)]
    schema = "k string, at long"
    found = batches(spark, rows, schema, lambda s: keyed.silences(s, ["k"], "at", 40 * MINUTE), parts=5)
    wanted = quality.silent_since(spark.createDataFrame(rows, schema), ["k"], "at", 40 * MINUTE)
    same(found, wanted)
    assert wanted.count() > quality.silences(spark.createDataFrame(rows, schema), ["k"], "at", 40 * MINUTE).count()


def test_books_go_on_after_a_restart(spark):
    rng = random.Random(9)
    rows = []
    for n in range(90):
        key, snap = f"I{n % 2}", n < 2 or n in (40, 41, 61)
        level = ("buy" if rng.random() < 0.5 else "sell", Decimal(rng.randrange(1, 30)), Decimal(rng.randrange(3)))
        seq = n // 2 + (3 if n > 30 else 0)
        rows.append((key, "e", n, (n // 2 + 1) * MINUTE, "snapshot" if snap else "delta", seq, seq, [level] * (not snap)))
    rows.append(("I9", "e", 90, 5000 * MINUTE, "delta", 1, 1, []))
    schema = "instrument_uid string, epoch_id string, event_id long, received_time_ns long, update_kind string, first_sequence long, last_sequence long, levels array<struct<side:string,price:decimal(38,18),amount:decimal(38,18)>>"
    found = batches(spark, rows, schema, lambda s: keyed.sequential_books(s, "bridge", False, idle_ns=1000 * MINUTE))
    wanted = engine.reconstruct(spark.createDataFrame(rows, schema), "bridge", False).where("instrument_uid <> 'I9'")
    names = ["instrument_uid", "epoch_id", "kind", "epoch_no", "event_id", "state", "last_sequence", "best_bid", "best_ask", "bids", "asks", "applied", "gaps", "close_reason"]
    same(found, wanted.select(*names))
    assert {r.close_reason for r in found.where("kind = 'epoch'").collect()} == {engine.GAP, engine.EXPLICIT}


def test_every_request_meets_one_answer(spark):
    rng = random.Random(11)
    limit = 10 * MINUTE
    rows = [(rng.choice(["a", "b", None]), rng.randrange(0, 3000) * MINUTE // 5, n if rng.random() < 0.4 else None) for n in range(400)]
    rows = sorted([*rows, ("hot", 7 * MINUTE, 900), ("hot", 7 * MINUTE, None), ("hot", 8 * MINUTE, 901), ("end", 10_000 * MINUTE, None)], key=lambda r: r[1])
    schema = "k string, at_ns long, request_id long"
    frame = spark.createDataFrame(rows, schema)
    wanted = quality.deadlines(frame.where("request_id IS NOT NULL"), frame.where("request_id IS NULL").drop("request_id"), ["k"], limit)
    plain = {r: "acknowledged" if any(k2 == k and q is None and at <= t <= at + limit for k2, t, q in rows) else "missed" for k, at, r in rows if r is not None}
    assert {r.request_id: r.outcome for r in wanted.collect()} == plain and wanted.count() == len(plain)
    same(batches(spark, rows, schema, lambda s: keyed.deadlines(s, ["k"], limit), parts=4), wanted)


def test_a_busy_key_makes_no_pairs(spark):
    """The rows of the join are requests: a thousand of each kind in one span give a thousand."""
    half = 1000
    requests = spark.range(half).selectExpr("'k' AS k", "id AS request_id", "id AS at_ns")
    answers = spark.range(half).selectExpr("'k' AS k", "id AS at_ns")
    found = quality.next_answers(requests, answers, ["k"], span_ns=100)
    assert found.where("answered_ns = at_ns").count() == found.count() == half
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
