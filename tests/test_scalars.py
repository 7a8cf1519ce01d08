"""Edges of the scalar functions."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickloom.functions import scalars as X
from tickloom.functions.shapes import shape, structural_fingerprint, wide_divide, wide_multiply


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize(
    ("text", "good"),
    [
        ("0", True), ("-0", True), ("1.5", True), ("-1.000000000000000001", True), ("99999999999999999999", True), ("00012.5", True),
        ("", False), ("+1", False), (".5", False), ("5.", False), ("1e3", False), ("1.0000000000000000001", False),
        ("100000000000000000000", False), (" 1", False), ("1 ", False), ("NaN", False), ("١", False), ("1,5", False),
    ],
)
def test_strict_decimal(spark, text, good):
    found = value(spark, X.strict_decimal(F.lit(text)))
    assert found == Decimal(text) if good else found is None


def test_decimal_text_is_plain(spark):
    assert value(spark, X.decimal_text(F.lit(Decimal(0)).cast("decimal(38,18)"))) == "0.000000000000000000"


@pytest.mark.parametrize(("payload", "state"), [('{"p":"1"}', "value"), ('{"p":""}', "empty"), ('{"p":null}', "null"), ("{}", "missing")])
def test_json_state(spark, payload, state):
    assert value(spark, X.json_state(F.lit(payload), "p")) == state


def test_digest_tells_null_from_empty_and_cuts_apart(spark):
    d = lambda *p: value(spark, X.digest(*p))
    assert d(F.lit("")) != d(F.lit(None).cast("string"))
    assert d(F.lit("a"), F.lit("bc")) != d(F.lit("ab"), F.lit("c"))


def test_native_time_overflow(spark):
    assert value(spark, X.native_to_ns(F.lit(9_223_372_036_854), "ms")) == 9_223_372_036_854_000_000
    assert value(spark, X.native_to_ns(F.lit(9_223_372_036_855), "ms")) is None
    assert value(spark, X.native_to_ns(F.lit(-1), "ms")) is None


def test_exact_arithmetic(spark):
    d = lambda x: F.lit(Decimal(x)).cast("decimal(18,6)")
    assert value(spark, X.exact_multiply(d("1.5"), d("2"))) == Decimal(3)
    assert value(spark, X.exact_multiply(d("0.000001"), d("0.1"))) is None
    assert value(spark, X.exact_divide(d("1"), d("3"))) is None
    assert value(spark, X.exact_divide(d("1"), d("0"))) is None
    wide = lambda x: F.lit(Decimal(x)).cast("decimal(38,18)")
    assert value(spark, wide_multiply(wide("12345678901.5"), wide("2"))) == Decimal("24691357803")
    assert value(spark, wide_divide(wide("1"), wide("8"))) == Decimal("0.125")
    assert value(spark, wide_divide(wide("1"), wide("3"))) is None


def test_checksum_is_signed(spark):
    import zlib

    bids, asks = F.array(F.lit("10:1"), F.lit("9:2")), F.array(F.lit("11:3"))
    crc = zlib.crc32(b"10:1:11:3:9:2")
    assert value(spark, X.book_checksum(bids, asks)) == (crc - (1 << 32) if crc >= 1 << 31 else crc)


def test_shapes_have_no_values(spark):
    assert shape({"b": 1, "a": [1, 2.5, "x", None]}) == shape({"a": ["y", None, 7, 0.5], "b": 2})
    assert shape({"a": 1}) != shape({"a": 1.5})
    assert value(spark, structural_fingerprint(F.lit("{not json"))) is None


def test_quality_flags(spark):
    assert value(spark, X.quality_flags(F.array(F.lit("source_duplicate_candidate"), F.lit("source_duplicate_candidate")))) == ["source_duplicate_candidate"]
    assert value(spark, X.quality_flags(F.array(F.lit("strange")))) is None


def test_dates_are_exact_around_midnight(spark):
    for ns, day in ((1704153599999999999, "2024-01-01"), (1704153600000000000, "2024-01-02"), (-1, "1969-12-31"), (0, "1970-01-01")):
        assert str(value(spark, X.ns_date(F.lit(ns)))) == day


def test_canonical_json_keeps_numbers_as_written(spark):
    from tickloom.functions.shapes import canonical_json

    given = ['{"b": [1.50, 1e3, -0], "a": "1.5"}', '{"a":1.5}', '{"a":"1.5"}', "NaN", "{", None]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "i int, t string").select("i", canonical_json("t").alias("c")).orderBy("i").collect()
    assert [r.c for r in found] == ['{"a":"1.5","b":[1.50,1e3,-0]}', '{"a":1.5}', '{"a":"1.5"}', None, None, None]
