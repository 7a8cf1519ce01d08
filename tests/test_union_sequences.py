"""Snapshots from a frame of their own meet their updates also where the sides' shuffles are coalesced apart."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators import books, engine


def test_sides_of_a_union_meet_in_one_task(spark):
    names = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        rows = spark.range(20_000).select(F.concat(F.lit("I"), F.col("id") % 40).alias("instrument_uid"), F.expr("cast(id div 10000 AS string)").alias("epoch_id"), F.col("id").alias("event_id"), F.col("id").alias("received_time_ns"))
        n = F.row_number().over(Window.partitionBy("instrument_uid", "epoch_id").orderBy("event_id"))
        level = F.struct(F.lit("buy").alias("side"), F.lit(1).cast("decimal(38,18)").alias("price"), F.col("event_id").cast("decimal(38,18)").alias("amount"))
        rows = rows.withColumns({"n": n, "levels": F.array(level)}).withColumns({"first_sequence": F.col("n").cast("long"), "last_sequence": F.col("n").cast("long")})
        events = books.with_snapshots(rows.where("n > 1"), rows.where("n = 1"))
        plan = engine.reconstruct(events)._jdf.queryExecution().executedPlan().toString()
        found = engine.reconstruct(events).where("kind = 'epoch'").select("applied", "gaps", "refused").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [tuple(r) for r in found] == [(249, 0, 0)] * 80
    assert "Exchange" in plan.split("Union")[0]
