"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

ROOT = str(Path(__file__).resolve().parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

#: Coverage, ordered replay, research, window annotation, declarative books, paging, versions, normalisation and ingest.
HEADLINE = (
    "g1_extent", "w8_observed_order", "g2_research", "j6_window_annotation", "r3_book_at_time", "w10_keyset_page", "w13_versions",
    "n1_spot_trades", "g10_evidence", "t4_set_equality", "s5_ingest",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from tickloom.plans.catalogue import QUERIES

    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
    }
    spark = SparkSession.builder.master(f"local[{cpus}]").config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    run = lambda name: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    run("g1_extent")  # the first query also pays for the start of the session
    seconds = {}
    for name in HEADLINE:
        began = time.perf_counter()
        run(name)
        seconds[name] = round(time.perf_counter() - began, 3)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count() + spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    ingested = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf_dir.rsplit("sf", 1)[-1], "input_rows": rows, "ingest_rows_per_sec": round(ingested / seconds["s5_ingest"])}))
    spark.stop()


if __name__ == "__main__":
    main()
