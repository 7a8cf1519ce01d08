"""Every market-data query against its DuckDB text on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from tickloom.plans.catalogue import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def rows(names, found):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple("" if r[i] is None else str(r[i]) for i in order) for r in found)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, DATA)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(names)
    assert rows(frame.columns, frame.collect()) == rows(names, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, DATA).limit(3).collect() is not None
