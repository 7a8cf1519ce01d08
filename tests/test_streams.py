"""Streams over several files and batches, and evidence of rebuilt partitions."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tickloom.plans import q_tables
from tickloom.plans import views as V
from tickloom.sources import tables
from tickloom.streaming import jobs

DATA = "/root/testdata/sf0.001"
LEVELS = "instrument_uid string, event_id long, received_time_ns long, side string, level_ordinal long, price decimal(38,18), amount decimal(38,18), action string"


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables here")
def test_trade_stream_is_one_batch_of_many_files(spark):
    folder, stream = q_tables._trade_stream(spark, DATA)
    assert len(list(Path(f"{folder}/in").glob("*.parquet"))) > 1
    assert jobs.drain(stream, folder).count() == V.trades(spark, DATA).count()
    assert len(list(Path(f"{folder}/state/commits").glob("[0-9]*"))) == 1


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables here")
def test_book_stream_reads_many_files(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(jobs, "stream_files", lambda s, folder, *a, of=jobs.stream_files: (seen.append(folder), of(s, folder, *a))[1])
    q_tables.r1_stream_books(spark, DATA)
    assert len(list(Path(seen[0]).glob("*.parquet"))) > 1


def test_book_sizes_after_each_event_over_batches(spark):
    from decimal import Decimal

    held, want, rows = set(), {}, []
    for event in range(60):
        at = event * 1_200_000_000_000
        for n in range(4):
            side, price = ("buy", "sell")[n % 2], (event * 7 + n * 3) % 11
            action = "delete" if (event + n) % 3 == 0 else "upsert"
            rows.append(("I1", event, at, side, n, Decimal(price), Decimal(1), action))
            (held.discard if action == "delete" else held.add)((side, price))
        want[event] = tuple(sum(s == side for s, _ in held) for side in ("buy", "sell"))
    folder = tables.shared_folder(spark)
    for part in (rows[:100], rows[100:]):  # the second file is a batch of its own, and cuts no event
        spark.createDataFrame(part, LEVELS).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        out = jobs.books(jobs.stream_files(spark, f"{folder}/in", spark.createDataFrame([], LEVELS).schema, 1), folder)
    assert {r.event_id: (r.bids, r.asks) for r in out.collect()} == want


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables here")
def test_rebuild_keeps_old_evidence_in_files(spark, monkeypatch):
    folder = tables.shared_folder(spark)
    rows = spark.createDataFrame(q_tables._one_venue(spark, DATA).limit(20).collect(), q_tables._one_venue(spark, DATA).schema)
    tables.write_partitions(rows, "trade", folder)
    new = rows.withColumn("price", (F.col("price") + 1).cast("decimal(38,18)"))
    held = []
    monkeypatch.setattr(tables, "write_partitions", lambda *a, of=tables.write_partitions: (held.append(Path(kept[0]).exists()), of(*a))[1])
    kept = []
    monkeypatch.setattr(tables, "shared_folder", lambda s, of=tables.shared_folder: (kept.append(of(s)), kept[-1])[1])
    out = tables.rebuild_partition(new, "trade", folder)
    assert held == [True]
    assert not out.where("same").count() and out.count() == rows.select("received_time_ns").withColumn("h", F.expr("received_time_ns div 3600000000000")).select("h").distinct().count()


def test_late_rows_stay_out_of_published_hours(spark, tmp_path):
    hour = 3_600_000_000_000
    given, schema = str(tmp_path / "in"), "id long, t long"
    paths = [str(tmp_path / n) for n in ("staging", "published")]

    def call(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(given)
        jobs.hour_files(spark.readStream.schema(schema).parquet(given), *paths, "t", str(tmp_path / "state"))

    published = lambda: sorted((r.id, r.hour) for r in spark.read.parquet(paths[1]).collect())
    call([(1, 5), (2, hour + 5)])
    assert published() == [(1, 0)]
    call([(3, 7), (4, 2 * hour + 5)])
    assert published() == [(1, 0), (2, 1)]
    late = lambda: sorted((r.id, r.hour) for r in spark.read.parquet(f"{paths[0]}_late").collect())
    assert late() == [(3, 0)]
    # the mark outlives the rows that set it, late rows pile up, and only open hours stay staged
    call([(5, 9), (6, hour + 9), (7, 2 * hour + 9)])
    assert published() == [(1, 0), (2, 1)] and late() == [(3, 0), (5, 0), (6, 1)]
    staged = [str(f) for folder in ("staging", "staging_open") for f in (tmp_path / folder).glob("*")]
    assert len(staged) == 1 and sorted(r.id for r in spark.read.parquet(*staged).collect()) == [4, 7]
    call([(8, 3 * hour)])
    assert published() == [(1, 0), (2, 1), (4, 2), (7, 2)] and late() == [(3, 0), (5, 0), (6, 1)]
    call([])
    assert published() == [(1, 0), (2, 1), (4, 2), (7, 2)]
