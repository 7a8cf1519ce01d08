"""Venue messages as JSON text, made from the trades and book views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.plans import views as V

MS = "received_time_ns div 1000000"


def _short(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


def from_trades(spark, d: str, **fields: Column) -> DataFrame:
    """(native_trade_id, source_id, payload): one message with the given fields per trade."""
    t = V.trades(spark, d).withColumns({"ms": F.expr(MS), "p": _short("price"), "q": _short("amount"), "maker": F.col("buyer_is_maker")})
    t = t.withColumn("direction", F.when(F.col("maker"), "sell").otherwise("buy"))
    return t.select("native_trade_id", "source_id", "channel_id", F.to_json(F.struct(*(c.alias(k) for k, c in fields.items())), {"ignoreNullFields": "false"}).alias("payload"))


def from_books(spark, d: str, build) -> DataFrame:
    """(event_id, payload): one message per book event; ``build`` makes named columns from bids, asks and sequences."""
    level = F.struct("level_ordinal", "side", F.col("price").cast("decimal(18,2)").alias("p"), F.col("amount").cast("decimal(18,2)").alias("q"))
    rows = V.book_events(spark, d, F.collect_list(level).alias("all"))
    # events are numbered by instrument, of which there are few; their messages are dealt anew
    rows = rows.repartition("event_id").withColumn("all", F.array_sort("all"))
    text = lambda x: F.array(x["p"].cast("string"), x["q"].cast("string"))
    pick = lambda s: F.transform(F.filter("all", lambda x: x["side"] == s), text)
    rows = rows.withColumns({"bids": pick("buy"), "asks": pick("sell"), "ms": F.expr(MS)})
    return rows.select("event_id", F.to_json(F.struct(*(c.alias(k) for k, c in build().items()))).alias("payload"))
