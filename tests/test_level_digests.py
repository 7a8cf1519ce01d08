"""The sequential books digest a level once, and both kinds of message come from rows that are made once."""

from decimal import Decimal

from tickloom.operators import engine
from tickloom.plans.catalogue import QUERIES

DATA = "/root/testdata/sf0.001"


def test_a_level_is_digested_once(monkeypatch):
    made = []
    monkeypatch.setattr(engine, "_weight", lambda side, level, of=engine._weight: (made.append(side), of(side, level))[1])
    level = lambda price, amount: {"side": "buy", "price": Decimal(price), "amount": Decimal(amount), "action": None}
    book = engine.Book()
    for n in range(1, 6):
        assert book.change([level(7, n)]) is None
    held = book.held
    assert book.change([level(7, 9), level(-1, 1)]) == engine.MALFORMED and book.held == held
    assert len(made) == 6
    assert book.change([level(7, 0)]) is None and book.held == 0


def test_snapshots_and_updates_share_their_rows(spark):
    plan = QUERIES["r6_contiguous_books"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan
