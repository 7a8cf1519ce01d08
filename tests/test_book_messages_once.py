"""Book messages take levels and sequences from one pass over the lines."""

from tickloom.plans.catalogue import QUERIES

DATA = "/root/testdata/sf0.001"


def test_lines_are_read_once(spark):
    for name in ("n8_okx_rpi_books", "n1_spot_depth"):
        plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert sum("FileScan" in line and "l_orderkey" in line for line in plan.splitlines()) == 1
