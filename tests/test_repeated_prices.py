"""A message that names a price twice is refused by the previous-id books, in the query and in its SQL."""

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from tickloom.plans.catalogue import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


def test_price_named_twice(spark, tmp_path):
    lines = pq.read_table(f"{DATA}/lineitem.parquet").to_pandas()
    # every level of a side of every seventh order gets one price
    some = lines["l_orderkey"] % 7 == 0
    lines.loc[some, "l_extendedprice"] = 5000.0 + lines.loc[some, "l_orderkey"] % 100
    pq.write_table(pa.Table.from_pandas(lines, preserve_index=False), tmp_path / "lineitem.parquet", coerce_timestamps="us")
    pq.write_table(pq.read_table(f"{DATA}/orders.parquet"), tmp_path / "orders.parquet", coerce_timestamps="us")
    duck = duckdb.connect()
    for t in ("orders", "lineitem"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    frame = QUERIES["r7_previous_id_books"](spark, str(tmp_path))
    cursor = duck.execute(ORACLES["r7_previous_id_books"])
    names = [c[0] for c in cursor.description]
    found = sorted(tuple(str(r[n]) for n in names) for r in frame.collect())
    assert found == sorted(tuple(map(str, r)) for r in cursor.fetchall())
