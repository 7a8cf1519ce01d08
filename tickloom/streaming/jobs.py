"""Structured Streaming forms: raw source, hour completeness, deadlines, cutover, books, replay-safe hour files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from tickloom.plans.views import NS_PER_HOUR


def stream_files(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 16) -> DataFrame:
    """A folder of Parquet files as an unbounded table."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def drain(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there into Parquet under ``folder`` and read the result."""
    spark = stream.sparkSession
    writer = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/out")
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def closed_hours(stream: DataFrame, time: str, by: str, late: str = "0 seconds") -> DataFrame:
    """(by, hour, n): tumbling UTC hours, given once the watermark has passed their end."""
    at = F.timestamp_micros(F.call_function("div", F.col(time), F.lit(1000)))
    rows = stream.withColumn("__at", at).withWatermark("__at", late)
    counted = rows.groupBy(F.window("__at", "1 hour").alias("w"), by).agg(F.count("*").alias("n"))
    hour = F.call_function("div", F.unix_micros("w.start") * 1000, F.lit(NS_PER_HOUR))
    return counted.select(by, hour.alias("hour"), "n")


def cutover(stream: DataFrame, bindings: DataFrame, time: str = "received_time_ns") -> DataFrame:
    """Rows of a stream with the mapper version that holds at their receive time; bindings are a static side."""
    from tickloom.operators.joins import active_at

    return active_at(stream, bindings, ["channel_id"], time, "valid_from_ns", "valid_to_ns", "inner")


LEVEL = ("instrument_uid", "side", "price")


def books(stream: DataFrame, folder: str) -> DataFrame:
    """(instrument_uid, received_time_ns, event_id, bids, asks): book sizes after each event of a stream of levels.

    Each batch compares every action with the one before it at the same price, in sorted partitions that can spill,
    and leaves the levels that are held to the next batch. Both go to Parquet under the batch's id, so a replayed
    batch replaces itself. Sizes are running sums of the changes: over an hour, then over hours.
    """
    spark, order = stream.sparkSession, ("received_time_ns", "event_id", "level_ordinal")

    def step(batch: DataFrame, batch_id: int) -> None:
        held = (F.col("action") != "delete").alias("held")
        rows = batch.select(*LEVEL, *order, held, "amount")
        if batch_id:  # levels from before come first at their price: they have no time
            before = batch.sparkSession.read.parquet(f"{folder}/levels/{batch_id - 1}")
            rows = rows.unionByName(before.withColumn("held", F.lit(True)), allowMissingColumns=True)
        last = F.lag("held", 1, False).over(Window.partitionBy(*LEVEL).orderBy(*order))
        change = F.col("held").cast("long") - last.cast("long")
        sums = [F.sum(F.when(F.col("side") == s, F.col("change")).otherwise(0)).alias(n) for s, n in (("buy", "bids"), ("sell", "asks"))]
        changes = rows.withColumn("change", change).where("event_id IS NOT NULL")
        changes.groupBy("instrument_uid", "received_time_ns", "event_id").agg(*sums).write.mode("overwrite").parquet(f"{folder}/changes/batch_id={batch_id}")
        left = rows.groupBy(*LEVEL).agg(F.max_by(F.struct("held", "amount"), F.struct(*order)).alias("l"))
        left.where("l.held").select(*LEVEL, "l.amount").write.mode("overwrite").parquet(f"{folder}/levels/{batch_id}")

    stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start().awaitTermination()
    schema = "instrument_uid string, received_time_ns long, event_id long, bids long, asks long, batch_id long"
    rows = spark.read.schema(schema).parquet(f"{folder}/changes")
    rows = rows.withColumn("hour", F.call_function("div", F.col("received_time_ns"), F.lit(NS_PER_HOUR)))
    span = ["instrument_uid", "batch_id", "hour"]
    earlier = Window.partitionBy("instrument_uid").orderBy("batch_id", "hour").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*span).orderBy("received_time_ns", "event_id")
    hours = rows.groupBy(*span).agg(F.sum("bids").alias("b"), F.sum("asks").alias("a"))
    hours = hours.select(*span, *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("b", "a")))
    size = lambda n, c: (F.sum(n).over(within) + F.col(c)).alias(n)
    return rows.join(hours, span).select("instrument_uid", "received_time_ns", "event_id", size("bids", "b"), size("asks", "a"))


def hour_files(stream: DataFrame, staging: str, published: str, time: str, checkpoint: str) -> None:
    """Batches are staged under their id, so a replayed batch replaces itself; closed hours are published once.

    An hour is closed when the high-water mark of all rows so far has passed its end. ``<staging>_hours`` holds the hours
    published and, for each call, the last batch it saw and the mark. Rows of later batches for a published hour never
    enter it but stand in ``<staging>_late``. What stays open goes to ``<staging>_open`` and the batches are deleted, so a
    call reads open hours and new batches only, whatever came before. A call that ends before its record does its work
    again into the same places; one that ends after it leaves files that nobody reads. Rows without a time stay open.
    """
    spark = stream.sparkSession

    def stage(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{staging}/{batch_id}")

    stream.writeStream.foreachBatch(stage).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(staging).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    listed = lambda folder: [int(f.getPath().getName()) for f in files.listStatus(path(folder))] if files.exists(path(folder)) else []
    record = "hour long, upto long, high long"
    known = spark.read.schema(record).parquet(f"{staging}_hours") if files.exists(path(f"{staging}_hours")) else spark.createDataFrame([], record)
    before, mark = known.agg(F.max("upto"), F.max("high")).first()
    new = sorted(n for n in listed(staging) if before is None or n > before)
    if not new:
        return
    columns = stream.schema.names
    rows = spark.read.schema(stream.schema).parquet(*(f"{staging}/{n}" for n in new))
    if before is not None:
        rows = rows.unionByName(spark.read.schema(stream.schema).parquet(f"{staging}_open/{before}"))
    high = max((m for m in (rows.agg(F.max(time)).first()[0], mark) if m is not None), default=None)
    hours = known.select(F.col("hour").alias("__published")).where("hour IS NOT NULL")
    hour = F.call_function("div", F.col(time), F.lit(NS_PER_HOUR))
    rows = rows.withColumn("hour", hour).join(hours, F.col("hour") == F.col("__published"), "left")
    closes = F.coalesce((F.col("hour") + 1) * NS_PER_HOUR <= F.lit(high).cast("long"), F.lit(False))
    is_late, is_open = F.col("__published").isNotNull(), F.col("__published").isNull() & ~closes
    closed = rows.where(~is_late & closes).select(*columns, "hour")
    write = lambda out: out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    write(closed.hint("rebalance", "hour")).partitionBy("hour").parquet(published)
    write(rows.where(is_late).select(*columns, "hour", F.lit(new[-1]).alias("batch_id"))).partitionBy("batch_id").parquet(f"{staging}_late")
    rows.where(is_open).select(*columns).write.mode("overwrite").parquet(f"{staging}_open/{new[-1]}")
    done = closed.select("hour").distinct().unionByName(spark.createDataFrame([(None,)], "hour long"))
    done = done.select("hour", F.lit(new[-1]).cast("long").alias("upto"), F.lit(high).cast("long").alias("high"))
    done.coalesce(1).write.mode("append").parquet(f"{staging}_hours")
    old = [f"{staging}/{n}" for n in listed(staging) if n <= new[-1]] + [f"{staging}_open/{n}" for n in listed(f"{staging}_open") if n != new[-1]]
    for folder in old:
        files.delete(path(folder), True)
