"""Sequential books: chains of ids, seeding, closing, checksums and price ladders; mapped messages to books."""

from __future__ import annotations

import json
import random
import time
import zlib
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.operators import engine as E
from tickloom.operators import normalize as N
from tickloom.operators import venues


def event(i, kind, first, last, levels, prev=None, **more):
    return {
        "event_id": i, "update_kind": kind, "first_sequence": first, "last_sequence": last, "previous_sequence": prev,
        "levels": [{"side": s, "price": Decimal(p), "amount": Decimal(a)} for s, p, a in levels], **more,
    }


def run(engine, *events):
    """(ids of events that changed the book, close reasons of the epochs that ended)."""
    rows = [row for e in events for row in engine.accept(e)]
    return [r["event_id"] for r in rows if r["kind"] == "book"], [r["close_reason"] for r in rows if r["kind"] == "epoch"]


def tagged(action, price, amount, side="buy"):
    return {"side": side, "price": Decimal(price), "amount": Decimal(amount), "action": action}


def test_bridge_buffers_seeds_and_reseeds_after_a_gap():
    e = E.Engine(E.Policy())
    seen, ended = run(
        e,
        event(1, "delta", 5, 6, [("buy", 9, 1)]),
        event(2, "delta", 7, 8, [("buy", 8, 1)]),
        event(3, "snapshot", 6, 6, [("buy", 9, 2), ("sell", 11, 1)]),
        event(4, "delta", 12, 13, []),
        event(5, "delta", 14, 15, []),
        event(6, "snapshot", 13, 13, [("buy", 7, 1)]),
    )
    assert (seen, ended) == ([3, 2, 6, 5], [E.GAP])
    assert (e.state, e.number, e.opened, e.counts["stale"], e.book.best()) == ("live", 2, E.GAP, 1, (Decimal(7), None))


def test_a_snapshot_behind_the_buffer_is_refused_and_a_live_book_takes_none():
    e = E.Engine(E.Policy())
    seen, _ = run(e, event(1, "delta", 20, 21, []), event(2, "snapshot", 10, 10, []), event(3, "snapshot", 19, 19, []), event(4, "snapshot", 30, 30, []))
    assert (seen, e.state, e.counts["refused"], e.last["last_sequence"]) == ([3, 1], "live", 2, 21)


def test_the_first_update_must_meet_the_snapshot():
    e = E.Engine(E.Policy())
    seen, ended = run(e, event(1, "snapshot", 10, 10, []), event(2, "delta", 12, 13, []), event(3, "snapshot", 12, 12, []))
    assert (seen, ended, e.opened) == ([1, 3, 2], [E.BOUNDARY], E.BOUNDARY)


def test_crossed_events_and_snapshots_close_the_epoch_until_the_connection_does():
    e = E.Engine(E.Policy())
    run(e, event(1, "snapshot", 1, 1, [("buy", 9, 1), ("sell", 10, 1)]), event(2, "delta", 2, 2, [("buy", 8, 1), ("buy", 10, 1)]))
    assert (e.state, e.closed, e.counts["refused"], e.book.best()) == ("closed", E.CROSSED, 1, (Decimal(9), Decimal(10)))
    assert run(e, event(3, "snapshot", 3, 3, []), event(4, "delta", 4, 4, [])) == ([], []) and e.counts["refused"] == 3
    assert run(e, event(5, "discontinuity", 0, 0, []), event(6, "snapshot", 3, 3, [])) == ([6], [E.CROSSED])
    e = E.Engine(E.Policy())
    assert run(e, event(1, "snapshot", 1, 1, [("buy", 9, 1), ("sell", 9, 1)])) == ([], []) and (e.state, e.closed) == ("closed", E.CROSSED)


@pytest.mark.parametrize(
    "bounds, events, reason",
    [
        ({"messages": 2}, [event(i, "delta", i, i, []) for i in range(1, 4)], E.OVERFLOW),
        ({"payload_bytes": 10}, [event(i, "delta", i, i, [], payload_bytes=6) for i in (1, 2)], E.OVERFLOW),
        ({"span_ns": 5}, [event(i, "delta", i, i, [], received_time_ns=i * 4) for i in (1, 2, 3)], E.OVERFLOW),
        ({"levels": 1}, [event(1, "snapshot", 1, 1, [("buy", 1, 1)]), event(2, "delta", 2, 2, [("buy", 2, 1)])], E.LEVEL_LIMIT),
        ({"levels": 1}, [event(1, "snapshot", 1, 1, [("buy", 1, 1), ("buy", 2, 1)])], E.LEVEL_LIMIT),
        ({"outputs": 1}, [event(1, "snapshot", 1, 1, []), event(2, "delta", 2, 2, [])], E.OUTPUT_LIMIT),
        ({}, [event(1, "snapshot", 1, 1, []), event(2, "delta", 2, 2, [("buy", -1, 1)])], E.MALFORMED),
        ({}, [event(1, "snapshot", 1, 1, []), event(2, "delta", 2, 2, [("buy", 1, -1)])], E.MALFORMED),
    ],
)
def test_bounds_and_bad_levels_close_for_good(bounds, events, reason):
    e = E.Engine(E.Policy(), E.Bounds(**bounds))
    run(e, *events)
    assert (e.state, e.evidence()["close_reason"], e.buffer) == ("closed", reason, [])
    assert run(e, event(9, "snapshot", 9, 9, [])) == ([], [])


def test_one_place_twice_is_a_discontinuity():
    e = E.Engine(E.Policy())
    at = lambda i, kind, seq, place: event(i, kind, seq, seq, [], coordinate=place)
    seen, ended = run(e, at(1, "snapshot", 1, (1, 0)), at(2, "delta", 2, (2, 0)), at(3, "delta", 3, (2, 0)), at(4, "snapshot", 2, (3, 0)))
    assert (seen, ended, e.opened) == ([1, 2, 4, 3], [E.DISCONTINUITY], E.DISCONTINUITY)


def test_chain_needs_the_previous_id():
    e = E.Engine(E.ChainPolicy())
    seen, ended = run(e, event(1, "snapshot", 10, 10, []), event(2, "delta", 9, 12, [], 8), event(3, "delta", 13, 14, [], 12), event(4, "delta", 15, 16, [], 13))
    assert (seen, ended, [u["event_id"] for u in e.buffer]) == ([1, 2, 3], [E.GAP], [4])


def test_reset_books_take_any_id_but_one():
    e = E.Engine(E.ResetPolicy())
    seen, ended = run(e, event(1, "delta", None, 5, []), event(2, "snapshot", None, 10, []), event(3, "delta", None, 30, []), event(4, "delta", None, 29, []),
                      event(5, "delta", None, 1, []), event(6, "delta", None, 31, []), event(7, "snapshot", None, 1, []), event(8, "snapshot", None, 2, []))
    assert (seen, ended, e.opened) == ([2, 3, 4, 7, 8], [E.GAP, E.RESEEDED], E.RESEEDED)


def full(i, kind, u, cross):
    return event(i, kind, None, u, [], cross_sequence=cross)


def test_contiguous_books_seed_by_cross_sequence():
    e = E.Engine(E.ContiguousPolicy())
    seen, _ = run(e, full(1, "snapshot", 10, 100), full(2, "delta", 10, 100), full(3, "delta", 11, 101), full(4, "snapshot", 9, 100), full(5, "snapshot", 10, 99))
    assert (seen, e.counts["refused"]) == ([], 3)
    assert run(e, full(6, "snapshot", 10, 100))[0] == [6, 3] and e.state == "live"
    assert run(e, full(7, "delta", 12, 90), full(8, "delta", 11, 101), full(9, "delta", 12, 102)) == ([9], [])
    assert (e.counts["refused"], e.counts["stale"]) == (4, 1)
    assert run(e, full(10, "delta", 15, 103)) == ([], [E.GAP]) and [u["event_id"] for u in e.buffer] == [10]
    assert run(e, full(11, "delta", 16, 102)) == ([], []) and e.counts["refused"] == 1  # the cross sequence falls
    assert run(e, full(12, "delta", 18, 105), full(13, "delta", 1, 106)) == ([], [E.GAP, E.GAP]) and [u["event_id"] for u in e.buffer] == [13]


def test_no_jump_right_after_a_contiguous_snapshot():
    e = E.Engine(E.ContiguousPolicy())
    run(e, full(1, "delta", 10, 100), full(2, "snapshot", 10, 100))
    assert run(e, full(3, "delta", 15, 101)) == ([], [E.GAP])


def test_previous_ids():
    e = E.Engine(E.PreviousPolicy())
    update = lambda i, prev, seq, levels=(): event(i, "update", None, seq, levels, prev)
    assert run(e, event(0, "snapshot", None, 10, [], 9)) == ([], [E.MALFORMED])
    assert run(e, event(1, "snapshot", None, 10, [], -1), update(2, 7, 12)) == ([1], [E.GAP])
    seen, ended = run(e, event(3, "snapshot", None, 10, [], -1), update(4, 10, 10), update(5, 10, 15, [("buy", 3, 1)]), update(6, 15, 3, [("buy", 4, 1)]), update(7, 3, 3, [("buy", 5, 1)]))
    assert (seen, ended) == ([3, 4, 5, 6], [E.GAP]) and e.state == "needs_snapshot"
    assert run(e, event(8, "snapshot", None, 1, [("buy", 3, 1), ("buy", 3, 2)], -1))[1] == [E.MALFORMED]


def plain_checksum(bids, asks):
    parts = []
    for n in range(25):
        parts += [x for side in (bids, asks) if n < len(side) for x in side[n]]
    code = zlib.crc32(":".join(parts).encode())
    return code - 2**32 if code >= 2**31 else code


def test_change_ids_and_actions_must_fit():
    e = E.Engine(E.ChangePolicy())
    seen, ended = run(
        e,
        event(1, "snapshot", None, 10, []) | {"levels": [tagged("new", 5, 1)]},
        event(2, "change", None, 13, [], 10) | {"levels": [tagged("change", 5, 2), tagged("new", 6, 1)]},
        event(3, "change", None, 14, [], 13) | {"levels": [tagged("delete", 6, 0)]},
    )
    assert (seen, ended, e.book.sides["buy"].get(Decimal(5))["amount"], len(e.book.sides["buy"])) == ([1, 2, 3], [], 2, 1)
    for wrong in (tagged("change", 7, 1), tagged("new", 5, 1), tagged("delete", 9, 0), tagged("change", 5, 0), tagged("other", 5, 1)):
        e = E.Engine(E.ChangePolicy())
        run(e, event(1, "snapshot", None, 10, []) | {"levels": [tagged("new", 5, 1)]})
        assert run(e, event(2, "change", None, 11, [], 10) | {"levels": [tagged("new", 6, 1), wrong]}) == ([], [E.MALFORMED])
    e = E.Engine(E.ChangePolicy())
    assert run(e, event(1, "snapshot", None, 10, []), event(2, "change", None, 10, [], 9))[1] == [E.GAP]
    assert run(e, event(3, "snapshot", None, 10, []) | {"levels": [tagged("delete", 5, 0)]})[1] == [E.MALFORMED]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.booleans()), max_size=300), st.booleans(), st.sampled_from([3, 512]))
def test_ladder_is_a_sorted_table(steps, descending, block):
    ladder, plain = E.Ladder(descending), {}
    ladder.BLOCK = block
    for price, there in steps:
        (ladder.put(Decimal(price), {"price": price}), plain.__setitem__(price, 1)) if there else (ladder.pop(Decimal(price)), plain.pop(price, None))
        want = sorted(plain, reverse=descending)
        assert (len(ladder), ladder.best(), [x["price"] for x in ladder.top(5)]) == (len(want), want[0] if want else None, want[:5])


def test_time_of_an_event_does_not_grow_with_depth():
    def seconds(depth):
        rng = random.Random(depth)
        book = E.Book()
        price = lambda: Decimal(rng.randrange(1, 10**7))
        level = lambda p: {"side": "buy", "price": p, "amount": Decimal(1), "price_text": str(p), "amount_text": "1"}
        book.change([level(price()) for _ in range(depth)])
        began = time.perf_counter()
        for _ in range(3000):
            book.change([level(price())])
            book.checksum()
        return time.perf_counter() - began

    seconds(100)
    assert seconds(100_000) < 5 * seconds(100) + 0.5


def test_output_digest_follows_the_book_and_not_its_history():
    one, two = E.Book(), E.Book()
    level = lambda p, n: {"side": "buy", "price": Decimal(p), "amount": Decimal(n)}
    one.change([level(1, 1), level(2, 5)])
    two.change([level(2, 1), level(3, 1)])
    two.change([level(2, 5), level(3, 0), level(1, "1.0")])
    assert one.held == two.held != E.Book().held
    assert one.change([level(4, 4), level(-1, 4)]) == E.MALFORMED and one.held == two.held


# ---- messages to books ----------------------------------------------------------------------------------------


def okx(seq, prev, action, bids=(), asks=(), checksum=0, ts=0):
    body = {"bids": [[*x, "0", "1"] for x in bids], "asks": [[*x, "0", "1"] for x in asks], "ts": str(ts), "checksum": checksum, "prevSeqId": prev, "seqId": seq}
    return json.dumps({"arg": {"channel": "books", "instId": "X"}, "action": action, "data": [body]})


def mapped(spark, payloads, mapping):
    rows = [("e1", n, p) for n, p in enumerate(payloads)]
    raw = spark.createDataFrame(rows, "epoch_id string, event_id long, payload string")
    return N.split(N.apply(raw, mapping, keep=["epoch_id", "event_id"]))[0]


def rebuilt(spark, payloads, mapping, policy, **more):
    return E.reconstruct(mapped(spark, payloads, mapping), policy, order=["event_id"], key=["symbol", "epoch_id"], **more)


def test_checksums_are_over_the_native_text(spark):
    big = 9_007_199_254_740_993  # one more than doubles can hold
    first = ([("8476.980", "415"), ("8475.55", "101")], [("8477", "7.0"), ("8477.34", "98")])
    second = ([("8476.980", "415"), ("8476.5", "1")], [("8477", "7.0"), ("8477.34", "98")])
    payloads = [
        okx(big, -1, "snapshot", *first, plain_checksum(*first)),
        okx(big + 2, big, "update", [("8475.55", "0"), ("8476.5", "1")], (), plain_checksum(*second)),
        okx(big + 3, big + 2, "update", [("8476.5", "2")], (), plain_checksum(*second)),  # wrong
        okx(big + 4, big + 3, "update"),
        okx(5, -1, "snapshot", *first, 0, E.CHECKSUM_CUTOVER_NS // 1_000_000),
        okx(6, 5, "update", [("8476.5", "2")], (), 0, E.CHECKSUM_CUTOVER_NS // 1_000_000),
        okx(7, 6, "update", [("8476.5", "3")], (), 9, E.CHECKSUM_CUTOVER_NS // 1_000_000),
    ]
    rows = rebuilt(spark, payloads, venues.OKX["book"], "previous").collect()
    books = sorted((r.event_id, r.last_sequence, r.best_bid, r.bids) for r in rows if r.kind == "book")
    assert books == [(0, big, Decimal("8476.980"), 2), (1, big + 2, Decimal("8476.980"), 2), (4, 5, Decimal("8476.980"), 2), (5, 6, Decimal("8476.980"), 3)]
    ends = E.linked_epochs(spark.createDataFrame(rows, rebuilt(spark, payloads, venues.OKX["book"], "previous").schema), ["symbol", "epoch_id"]).orderBy("number").collect()
    # the second epoch saw one refused update, and was cut by the next snapshot
    assert [(r.number, r.parent, r.opened_by, r.close_reason, r.applied, r.refused) for r in ends] == [
        (1, None, "initial", E.CHECKSUM, 1, 1), (2, 1, E.CHECKSUM, E.RESEEDED, 0, 1), (3, 2, E.RESEEDED, E.CHECKSUM, 1, 1),
    ]


def test_segments_give_what_one_sequence_gives(spark):
    """Cutting at snapshots changes neither books nor counts: against the engine run over the whole epoch."""
    rng = random.Random(4)
    payloads, last = [], 0
    for n in range(120):
        snap = n % 17 == 3
        prev, last = (-1 if snap else last + (rng.random() < 0.05)), last + 10
        payloads.append(okx(last, prev, "snapshot" if snap else "update", [(str(rng.randrange(1, 9)), str(rng.randrange(3)))], (), 0, E.CHECKSUM_CUTOVER_NS // 1_000_000))
    frame = mapped(spark, payloads, venues.OKX["book"])
    found = E.reconstruct(frame, "previous", order=["event_id"], key=["symbol", "epoch_id"], span=7).collect()
    whole = E.Engine(E.PreviousPolicy())
    rows = [r for e in frame.withColumn("levels", E.with_levels(frame)).orderBy("event_id").toArrow().to_pylist() for r in whole.accept(e)]
    want = [(r["event_id"], r["last_sequence"], r["bids"], r["best_bid"]) for r in rows if r["kind"] == "book"]
    assert sorted((r.event_id, r.last_sequence, r.bids, r.best_bid) for r in found if r.kind == "book") == want
    total = lambda c: sum(r[c] for r in rows if r["kind"] == "epoch") + whole.counts[c]
    for c in ("accepted", "applied", "gaps", "refused"):
        assert sum(r[c] for r in found if r.kind == "epoch") == total(c)
    assert len({r.segment for r in found}) == 8


def test_bounded_messages_go_from_the_mapping_to_books(spark):
    def message(u, kind, bids):
        return json.dumps({"topic": "orderbook.50.X", "type": kind, "ts": u, "data": {"s": "X", "b": bids, "a": [["9", "1"]], "u": u, "seq": u}, "cts": 1})

    payloads = [message(5, "snapshot", [["7", "1"]]), message(8, "delta", [["7", "0"], ["6", "2"]]), message(1, "delta", []), message(9, "delta", [])]
    rows = rebuilt(spark, payloads, venues.BYBIT["book"], "reset").collect()
    assert [(r.event_id, r.best_bid, r.best_ask) for r in rows if r.kind == "book"] == [(0, 7, 9), (1, 6, 9)]
    assert [(r.epoch_no, r.close_reason, r.gaps, r.refused) for r in rows if r.kind == "epoch"] == [(1, E.GAP, 1, 0), (2, E.EXPLICIT, 0, 1)]
    rpi = json.dumps({"topic": "orderbook.rpi.X", "type": "snapshot", "ts": 1, "data": {"s": "X", "b": [["7", "0", "3"], ["8", "0", "0"]], "a": [], "u": 3, "seq": 4}})
    assert [r.bids for r in rebuilt(spark, [rpi], venues.BYBIT["rpi_book"], "reset").where("kind = 'book'").collect()] == [1]


def test_connections_are_linked(spark):
    rows = [("X", c, n, "snapshot" if n == 0 else "delta", n, n, []) for c in ("c1", "c2", "c3") for n in range(3)]
    schema = "instrument_uid string, epoch_id string, event_id long, update_kind string, first_sequence long, last_sequence long, levels array<struct<side:string,price:decimal(38,18),amount:decimal(38,18)>>"
    found = E.linked_epochs(E.reconstruct(spark.createDataFrame(rows, schema), order=["event_id"])).orderBy("number").collect()
    assert [(r.epoch_id, r.opened_by, r.close_reason, r.first_observed, r.last_accepted) for r in found] == [
        ("c1", "initial", E.RECONNECT, 0, 2), ("c2", E.RECONNECT, E.RECONNECT, 0, 2), ("c3", E.RECONNECT, E.EXPLICIT, 0, 2),
    ]
    assert len({r.input_digest for r in found}) == 1 and E.reconstruct(spark.createDataFrame([], schema), order=["event_id"]).count() == 0
