"""The streamed books give the time of each event, so nobody joins the events to them again."""

from tickloom.plans.catalogue import QUERIES

DATA = "/root/testdata/sf0.001"


def test_events_are_not_made_again(spark):
    plan = QUERIES["r1_stream_books"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan
