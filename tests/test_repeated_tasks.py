"""Rows that are written many times are dealt by what they write, not by what is read."""

from pyspark.sql import functions as F

from tickloom.operators import joins


def test_one_row_is_written_by_many_tasks(spark):
    rows = spark.createDataFrame([("a", 1000), ("b", 7), ("c", 1)], "id string, n long")
    found = joins.repeated(rows, "n", block=10, task_rows=100)
    assert {r.id: r["count"] for r in found.groupBy("id").count().collect()} == {"a": 1000, "b": 7, "c": 1}
    tasks = found.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) > 5 and max(r["count"] for r in tasks) < 400
    assert joins.repeated(rows.where("n > 2000"), "n").isEmpty()
