"""Instrument pages and paged replay on small tables with known answers."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tickloom.operators import metadata, replay, venues
from tickloom.operators import normalize as N


@pytest.mark.parametrize(
    "symbol, want",
    [
        ("BTC-29FEB24-50000-C", ("BTC", date(2024, 2, 29), "50000", "call", None)),
        ("ETH-01JAN70-0.5-P-USDT", ("ETH", date(1970, 1, 1), "0.5", "put", "USDT")),
        *((s, None) for s in ("BTC-30FEB24-1-C", "BTC-1JAN24-1-C", "BTC-01Jan24-1-C", "btc-01JAN24-1-C", "BTC-01JAN24-1-X", "BTC-01JAN24--C", "BTC-01JAN24-1-C-", "BTC-01JAN24-1-C\n", "", None)),
        ("B-01JAN24-" + "1" * 60 + "-C", None),
    ],
)
def test_option_identity(spark, symbol, want):
    found = spark.createDataFrame([(symbol,)], "s string").select(metadata.option_identity(F.col("s")).alias("x")).first().x
    assert (found and tuple(found)) == want


def page(spark, pages):
    item = lambda s, quote="USDT": {"symbol": s, "status": "Trading", "baseCoin": "A", "quoteCoin": quote}
    rows = [
        (n, json.dumps({"retCode": code, "time": 5, "result": {"category": kind, "nextPageCursor": cursor, "list": [item(*x) for x in items]}}))
        for n, code, kind, cursor, items in pages
    ]
    return spark.createDataFrame(rows, "page long, payload string")


def test_a_page_stands_or_falls_as_a_whole(spark):
    many = [(f"S{i}",) for i in range(1001)]
    raw = page(
        spark,
        [
            (0, 0, "spot", "", [("A",), ("B",)]), (1, 0, "spot", "", [("A",), ("B", ""), ("A",)]), (2, 0, "spot", "", [("A",), ("B",), ("A",), ("C", "")]),
            (3, 0, "spot", "next", [("A",)]), (4, 10001, "spot", "", [("A",)]), (5, 0, "linear", "", [("A",)]), (6, 0, "spot", "", many), (7, 0, "spot", "", [("a b",)]), (None, 0, "spot", "", [("A", "")]),
        ],
    )
    rows, faults = metadata.whole_pages(N.apply(raw, venues.BYBIT_INSTRUMENTS["spot"], keep=["page"]), ["page"], cursor="next_cursor")
    assert {(r.page, r.symbol) for r in rows.collect()} == {(0, "A"), (0, "B")}
    assert {tuple(r) for r in faults.collect()} == {
        (1, "invalid_field", 1), (2, "repeated_symbol", 2), (3, "unexpected_cursor", None), (4, "invalid_field", 0), (5, "schema_unknown", 0), (6, "too_many", None), (7, "invalid_field", 0),
        (None, "invalid_field", 0),
    }


def served(records, gaps, size):
    """Record by record, as a reader of pages would: the page loaded last, gaps before records of the same time."""
    out, page, in_page, g = [], 0, 0, 0
    records, gaps = sorted(records), sorted(gaps)
    for n, r in enumerate(records):
        if in_page == size:
            page, in_page = page + 1, 0
        while g < len(gaps) and gaps[g][:3] <= r[:3]:
            out.append((page, "gap", *gaps[g]))
            g += 1
        out.append((page, "record", *r))
        in_page += 1
    return out + [(page, "gap", *x) for x in gaps[g:]]


@pytest.mark.parametrize("n, size", [(0, 3), (1, 3), (6, 3), (40, 7), (40, 1)])
def test_pages_hold_records_with_their_gaps(spark, n, size):
    records = [(f"s{i % 2}", f"i{i % 3}", i // 4, i) for i in range(n)]
    gaps = [(f"s{i % 3}", f"i{i % 3}", i, 100 + i) for i in range(9)]
    schema = "source_id string, instrument_uid string, at long, id long"
    found = replay.pages(spark.createDataFrame(records, schema), spark.createDataFrame(gaps, schema), ["source_id", "instrument_uid"], "at", ["id"], size, span=3)
    got = [(r.page, r.kind, r.source_id, r.instrument_uid, r["at"], r.id) for r in sorted(found.collect(), key=lambda r: r.place)]
    assert got == served(records, gaps, size)
    assert sorted(r.place for r in found.collect()) == list(range(1, len(got) + 1))


def test_summaries_and_faults_of_pages(spark):
    rows = [(0, 1, "record", "a", 1), (0, 2, "record", "a", 2), (1, 3, "gap", "a", 2), (1, 4, "record", "a", 2), (1, 5, "record", "a", 3), (2, 6, "record", "a", 9), (2, 7, "record", "a", 8), (2, 8, "record", "b", 1)]
    df = spark.createDataFrame(rows, "page long, place long, kind string, k string, v long")
    got = {r.page: (r.records, r.gaps, tuple(r.first_key), tuple(r.last_key), r.has_more, r.fault) for r in replay.checked(df, ["k", "v"], 2).collect()}
    assert got == {
        0: (2, 0, ("a", 1), ("a", 2), True, None), 1: (2, 1, ("a", 2), ("a", 3), True, "not_past_cursor"), 2: (3, 0, ("a", 9), ("b", 1), False, "too_many"),
    }
    assert {r.page: r.fault for r in replay.checked(df, ["k", "v"], 3).collect()} == {0: None, 1: "not_past_cursor", 2: "not_ascending"}
