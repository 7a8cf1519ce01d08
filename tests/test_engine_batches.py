"""The streamed engine takes its input in bounded batches, in order of time, and gives the same books."""

from pathlib import Path

import duckdb

from tickloom.plans import q_tables
from tickloom.plans.catalogue import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


def test_batches_are_bounded(spark, monkeypatch):
    seen = []
    given = q_tables._in_turn

    def watched(*args):
        folder, stream = given(*args)
        seen.append(folder)
        return folder, stream

    monkeypatch.setattr(q_tables, "BATCH_ROWS", 500)
    monkeypatch.setattr(q_tables, "_in_turn", watched)
    frame = QUERIES["r1_stream_engine"](spark, DATA)
    duck = duckdb.connect()
    for t in ("orders", "lineitem"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    cursor = duck.execute(ORACLES["r1_stream_engine"])
    names = [c[0] for c in cursor.description]
    assert sorted(tuple(map(str, (r[n] for n in names))) for r in frame.collect()) == sorted(tuple(map(str, r)) for r in cursor.fetchall())
    commits = [f for f in Path(seen[0], "state", "commits").iterdir() if f.name.isdigit()]
    assert len(commits) >= 3
