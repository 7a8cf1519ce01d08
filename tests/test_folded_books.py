"""Streamed books wait as compressed tables, and a batch is one slice of time also where keys are few."""

import pickle
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickloom.operators import engine
from tickloom.plans import q_tables


@pytest.mark.parametrize("descending", [True, False])
def test_a_folded_ladder_is_the_same(descending):
    rng = random.Random(3)
    plain, folded = engine.Ladder(descending), engine.Ladder(descending)
    for step in range(30):
        prices = [Decimal(rng.randrange(1, 2000)) / 100 for _ in range(100)]
        folded.unfold(prices)
        for p in prices:
            if rng.random() < 0.4:
                plain.pop(p), folded.pop(p)
            else:
                level = {"price": p, "amount": Decimal(rng.randrange(9)), "price_text": str(p), "amount_text": "1"}
                plain.put(p, {**level}), folded.put(p, {**level})
            assert (len(plain), plain.best()) == (len(folded), folded.best())
        assert [x["price_text"] for x in plain.top(25)] == [x["price_text"] for x in folded.top(25)]
        if step % 3:
            folded = pickle.loads(pickle.dumps(folded))
    with pytest.raises(ValueError, match="unfolded"):
        folded.fold()
        folded.get(Decimal(3000))


def test_books_and_their_digests_go_on():
    rng = random.Random(4)
    plain, folded = engine.Book(), engine.Book()
    for _ in range(40):
        levels = [{"side": rng.choice(["buy", "sell"]), "price": Decimal(rng.randrange(1, 60)), "amount": Decimal(rng.randrange(3)), "rpi_amount": None} for _ in range(8)]
        crossed = rng.random() < 0.3
        folded = pickle.loads(pickle.dumps(folded))
        folded.unfold([{"levels": levels}])
        why = [b.change([{**x} for x in levels], crossed=crossed) for b in (plain, folded)]
        assert why[0] == why[1] and (plain.held, plain.best()) == (folded.held, folded.best())


def test_a_waiting_book_is_small():
    book = engine.Book()
    assert book.change([{"side": "buy", "price": Decimal(n) / 100, "amount": Decimal(n % 50)} for n in range(1, 20_001)]) is None
    assert len(pickle.dumps(book)) < 20_000 * 24


def test_a_batch_is_one_slice(spark, monkeypatch):
    monkeypatch.setattr(q_tables, "BATCH_ROWS", 300)
    rows = spark.range(1500).select(F.concat(F.lit("I"), F.col("id") % 2).alias("k"), F.col("id").alias("at"))
    folder, stream = q_tables._in_turn(spark, rows, "k", "at")
    sizes = []
    stream.writeStream.foreachBatch(lambda batch, _: sizes.append(batch.count())).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    assert sum(sizes) == 1500 and max(sizes) < 400
