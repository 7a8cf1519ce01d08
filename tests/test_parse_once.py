"""Messages are parsed once: no field, state or filter parses its objects again."""

from tickloom.operators import normalize as N
from tickloom.operators import venues


def test_nested_objects_and_fields_are_read_once(spark):
    raw = spark.createDataFrame([("{}",)], "payload string")
    for mapping in (venues.HYPERLIQUID["book"], venues.SPOT["ticker"], venues.DERIBIT["book"], venues.BYBIT["book"], venues.OKX["book"]):
        rows = N.split(N.apply(raw, mapping))[0]
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        nested = {f.path.rpartition(".")[0] for f in (*mapping.fields, *mapping.header)}
        lists = sum(f.kind in ("levels", "texted", "rpi", "named", "tagged") for f in mapping.fields)
        # the message, its items and each nested object once, and an array of levels at most twice for its parts
        assert plan.count("from_json(") <= 4 + 2 * len(nested) + 2 * lists
        assert plan.count("(38,18)") <= 40
