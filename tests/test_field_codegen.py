"""Fields are read in arrays by kind: no operator's generated code is longer than the JVM compiles (8000 bytes a method)."""

import re

import pytest

from tickloom.operators import normalize as N
from tickloom.operators import venues

LIMIT = 8000


@pytest.mark.parametrize("mapping", [venues.SPOT["ticker"], venues.COINM["ticker"], venues.OKX["rpi_book"], venues.DERIBIT["option"]])
def test_methods_are_short_enough_to_be_compiled(spark, mapping):
    raw = spark.range(3).selectExpr("concat('{', id, '}') AS payload")
    rows = N.split(N.apply(raw, mapping))[0]
    text = rows._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < LIMIT


@pytest.mark.parametrize("venue", [venues.SPOT, venues.BYBIT])
def test_the_first_field_at_fault_is_named_with_its_state(spark, venue):
    """Of several fields at fault the first in the mapping's order is named, wherever its object lies."""
    if venue is venues.SPOT:
        texts = ['{"e":"trade","s":"A","t":1,"p":null,"q":"x","T":1,"E":1,"m":true,"M":true}', '{"e":"trade","s":"","t":1,"p":"1","q":"1"}', '{"e":"trade","s":"A"}']
        want = [("price", "null"), ("symbol", "empty"), ("native_trade_id", "missing")]
        mapping = venues.SPOT["trade"]
    else:
        body = '{"topic":"orderbook.50.X","type":"delta","ts":%s,"cts":1,"data":%s}'
        texts = [body % ("1", '{"s":"A","b":[["1","x"]],"a":[],"u":1,"seq":1}'), body % ('"-1"', '{"s":"A","b":[],"a":[],"u":1,"seq":1}'), body % ("1", "null")]
        want = [("bids", "value"), ("event_time_ns", "value"), ("symbol", "missing")]
        mapping = venues.BYBIT["book"]
    raw = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n long, payload string")
    found = N.apply(raw, mapping, keep=["n"]).orderBy("n").select("code", "bad_field", "bad_state").collect()
    assert [tuple(r) for r in found] == [("invalid_field", *w) for w in want]
