"""Epochs alone: the same evidence as with a row per change, and events read by column."""

from decimal import Decimal

import pyarrow as pa

from tickloom.operators import engine


def _level(side, price, amount):
    return {"side": side, "price": Decimal(price), "amount": Decimal(amount), "action": None}


def test_events_are_those_of_to_pylist():
    level = pa.struct([("side", pa.string()), ("price", pa.decimal128(38, 18)), ("amount", pa.decimal128(38, 18)), ("action", pa.string())])
    rows = [
        {"event_id": 1, "levels": [_level("buy", 9, 1), _level("sell", 11, 2)], "checksum": None},
        {"event_id": None, "levels": [], "checksum": None},
        {"event_id": 3, "levels": None, "checksum": None},
        {"event_id": 4, "levels": [_level("buy", "8.5", 0)], "checksum": None},
    ]
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([("event_id", pa.int64()), ("levels", pa.list_(level)), ("checksum", pa.int64())]))
    for some in (batch, batch.slice(1), batch.slice(1, 2), batch.slice(0, 0)):
        assert list(engine._events(some)) == some.to_pylist()


def test_epochs_alone_are_the_same(spark):
    rows = [
        ("I1", str(n // 20), n, n, "snapshot" if n % 20 == 0 else "delta", n + 1 + (n == 31), n + 1, [("buy", Decimal(90 + n % 5), Decimal(n % 3)), ("sell", Decimal(100 + n % 7), Decimal(1))])
        for n in range(60)
    ]
    names = "instrument_uid string, epoch_id string, received_time_ns long, event_id long, update_kind string, first_sequence long, last_sequence long"
    events = spark.createDataFrame(rows, names + ", levels array<struct<side: string, price: decimal(38,18), amount: decimal(38,18)>>")
    whole, alone = (engine.reconstruct(events, "bridge", changes=c).collect() for c in (True, False))
    assert any(r.kind == "book" for r in whole)
    assert sorted(map(repr, alone)) == sorted(repr(r) for r in whole if r.kind == "epoch")
