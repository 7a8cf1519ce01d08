"""Operators on small tables with known answers."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickloom.operators import books, digests, filters, joins, quality, sets, windows
from tickloom.operators import normalize as N
from tickloom.operators.venues import DERIBIT, HYPERLIQUID, SPOT
from tickloom.sources import tables


def test_spec_limits():
    assert filters.QuerySpec(0, 10).problems() == []
    bad = filters.QuerySpec(0, filters.MOST_NS + 1, sources=("b", "a"), instruments=[f"{i:03}" for i in range(257)], limit=0)
    assert len(bad.problems()) == 4
    with pytest.raises(ValueError):
        filters.bounded_query(None, bad)


def test_keyset_pages_cover_all_rows_once(spark):
    df = spark.createDataFrame([(i % 3, i) for i in range(25)], "a int, b int")
    seen, cursor = [], None
    while True:
        page = windows.page(df, ["a", "b"], 7, cursor).collect()
        seen += [tuple(r) for r in page[:7]]
        if len(page) <= 7:
            break
        cursor = page[6].asDict()
    assert seen == sorted((i % 3, i) for i in range(25))


def test_gap_before_the_first_row(spark):
    df = spark.createDataFrame([("e", 3), ("e", 4), ("e", 7)], "epoch string, arrival_ordinal long")
    assert [tuple(r) for r in windows.ordinal_gaps(df, ["epoch"]).orderBy("first_missing").collect()] == [("e", 1, 2), ("e", 5, 6)]


def test_digest_ignores_order_and_partitions_but_not_repeats(spark):
    df = spark.createDataFrame([(i, f"x{i}", None if i % 3 else 1.5) for i in range(50)], "a int, b string, c double")
    d = lambda x: digests.multiset_digest(x).first().digest
    assert d(df) == d(df.orderBy(F.desc("a")).repartition(7))
    assert d(df) != d(df.union(df.limit(1)))


def test_versions_close_and_relist(spark):
    rows = [("i", 1, "a"), ("i", 2, "a"), ("i", 3, "b"), ("i", 4, "closed"), ("i", 5, "b")]
    df = spark.createDataFrame(rows, "k string, t long, s string")
    found = windows.versions(df, "k", "t", ["s"], F.col("s") == "closed").orderBy("valid_from_ns").collect()
    assert [tuple(r)[1:] for r in found] == [(1, "a", 1, 3), (1, "b", 3, 4), (2, "b", 5, None)]


def test_windows_across_buckets_join_once(spark):
    events = spark.createDataFrame([(1, "k", 5), (2, "k", 250), (3, "k", 999)], "id long, k string, t long")
    w = spark.createDataFrame([("k", 0, 300, "w1"), ("k", 200, 260, "w2")], "k string, start_ns long, end_ns long, wid string")
    found = joins.containing_windows(events, w, ["k"], "t", "wid", "ids", narrowest=5, row_keys=["id"]).orderBy("id").collect()
    assert [tuple(r) for r in found] == [(1, ["w1"]), (2, ["w1", "w2"]), (3, [])]


def test_merge_outcomes(spark):
    ledger = spark.createDataFrame([(1, None), (2, "seen"), (3, "seen"), (4, None)], "id int, outcome string")
    changes = spark.createDataFrame([(1, "seen"), (2, "seen"), (3, "missed"), (5, "seen")], "id int, outcome string")
    found = {r.id: (r.outcome, r.what) for r in quality.merge_outcomes(ledger, changes, "id").collect()}
    assert found == {
        1: ("seen", "terminalised"), 2: ("seen", "replayed"), 3: ("seen", "conflict"), 4: (None, "kept"), 5: ("seen", "inserted"),
    }


def test_set_difference_counts_repeats(spark):
    a, b = (spark.createDataFrame(x, "v int") for x in ([(1,), (1,), (2,)], [(1,), (2,), (3,)]))
    assert sorted(tuple(r) for r in sets.set_difference(a, b).collect()) == [(1, "missing"), (3, "extra")]


MESSAGES = [
    ('{"e":"trade","E":1,"s":"X","t":1,"p":"1.5","q":"2","T":1,"m":true,"M":true}', None, None),
    ('{"e":"trade","E":1,"s":"X","t":1,"q":"2","T":1,"m":true,"M":true}', "price", "missing"),
    ('{"e":"trade","E":1,"s":"X","t":1,"p":null,"q":"2","T":1,"m":true,"M":true}', "price", "null"),
    ('{"e":"trade","E":1,"s":"X","t":1,"p":"","q":"2","T":1,"m":true,"M":true}', "price", "empty"),
    ('{"e":"trade","E":1,"s":"X","t":-1,"p":"1","q":"2","T":1,"m":true,"M":true}', "native_trade_id", "value"),
    ("not json", None, None),
]


def test_spot_trade_states(spark):
    raw = spark.createDataFrame([(i, m) for i, (m, _, _) in enumerate(MESSAGES)], "n int, payload string")
    rows, bad = N.split(N.apply(raw, SPOT["trade"], keep=["n"]))
    assert [(r.n, r.price, r.side) for r in rows.collect()] == [(0, Decimal("1.5"), "sell")]
    found = {r.n: (r.bad_field, r.bad_state) for r in bad.collect()}
    assert set(found) == {1, 2, 3, 4, 5}
    assert all(found[i] == MESSAGES[i][1:] for i in (1, 2, 3, 4))
    assert N.accounting(raw, rows, bad, ["n"]).count() == 0


def test_numbers_keep_their_digits(spark):
    book = '{"params":{"channel":"book.X","data":{"type":"change","timestamp":5,"instrument_name":"X","change_id":2,"prev_change_id":1,"bids":[["new",0.1234567890123456,10.10]],"asks":[]}}}'
    row = N.split(N.apply(spark.createDataFrame([(book,)], "payload string"), DERIBIT["book"]))[0].first()
    assert row.bids[0].price == Decimal("0.1234567890123456")
    assert (row.last_sequence, row.previous_sequence, row.asks) == (2, 1, [])


def test_duplicate_trades_stay(spark):
    one = '{"coin":"X","side":"B","px":"1","sz":"2","hash":"h","time":1,"tid":9}'
    raw = spark.createDataFrame([(f'{{"channel":"trades","data":[{one},{one}]}}',)], "payload string")
    rows = N.split(N.apply(raw, HYPERLIQUID["trade"]))[0]
    assert rows.count() == 2
    assert [r.f for r in rows.select(quality.duplicate_flags(rows, ["symbol", "native_trade_id"]).alias("f")).collect()] == [True, True]


def test_load_is_idempotent_and_refuses_other_rows(spark, tmp_path):
    rows = spark.createDataFrame([(i, "S") for i in range(20)], "native_trade_id long, source_id string")
    load = lambda r: tables.load_generation(r, rows, str(tmp_path), "g")
    assert [load(rows.limit(3)), load(rows), load(rows), load(rows.union(rows))] == ["refused", "loaded", "already_loaded", "already_loaded"]


def test_registry_sends_unknown_versions_to_quarantine(spark):
    r = N.Registry()
    r.register("s", "c", "v1", lambda raw: (raw.select("n"), raw.limit(0).withColumn("code", F.lit("x"))))
    with pytest.raises(ValueError):
        r.register("s", "c", "v1", None)
    raw = spark.createDataFrame([(1, "s", "c", "v1"), (2, "s", "c", "v2")], "n int, source_id string, channel_id string, mapper_version string")
    rows, bad = r.run(raw)
    assert [x.n for x in rows.collect()] == [1] and [(x.n, x.code) for x in bad.collect()] == [(2, "mapper_binding_unavailable")]


def test_load_leaves_the_old_generation_until_the_new_one_is_whole(spark, tmp_path):
    rows = spark.createDataFrame([(i, "S") for i in range(20)], "native_trade_id long, source_id string")
    fewer = rows.where("native_trade_id < 9")
    assert tables.load_generation(fewer, fewer, str(tmp_path), "g") == "loaded"
    assert tables.load_generation(rows.limit(3), rows, str(tmp_path), "g") == "refused"
    assert spark.read.parquet(str(tmp_path)).count() == 9
    assert tables.load_generation(rows, rows, str(tmp_path), "g") == "loaded"
    assert spark.read.parquet(str(tmp_path)).count() == 20


def test_equal_events_are_annotated_each(spark):
    events = spark.createDataFrame([(1, "k", 5)] * 3 + [(2, "k", 999)] * 2, "id long, k string, t long")
    w = spark.createDataFrame([("k", 0, 300, "w1"), ("k", 0, 300, "w1"), ("k", 1, 9, "w2")], "k string, start_ns long, end_ns long, wid string")
    found = joins.containing_windows(events, w, ["k"], "t", "wid", "ids", narrowest=5, row_keys=["id"]).orderBy("id").collect()
    assert [tuple(r) for r in found] == [(1, ["w1", "w2"])] * 3 + [(2, [])] * 2


def test_messages_of_another_role_are_refused(spark):
    m = N.Mapping_("trade", [N.Field("native_id", "t", "uint")], when=("e", "trade|aggTrade"))
    raw = spark.createDataFrame([('{"e":"trade","t":9223372036854775807}',), ('{"e":"trades","t":1}',), ('{"t":1}',), ('{"e":"trade","t":9223372036854775808}',)], "payload string")
    found = N.apply(raw, m).collect()
    assert [(r.native_id, r.code, r.bad_field) for r in found] == [
        (9223372036854775807, None, None), (1, "schema_unknown", "e"), (1, "schema_unknown", "e"), (None, "invalid_field", "native_id"),
    ]


def test_next_time_over_span_borders(spark):
    """Ties, empty spans between rows, null keys and single rows, against a sort in Python."""
    from tickloom.operators.windows import next_time

    rows = [("a", t) for t in (1, 1, 9, 10, 35, 71)] + [(None, 5), (None, 40), ("b", 3)]
    frame = spark.createDataFrame(rows, "k string, t long")
    for backwards in (False, True):
        want = []
        for key in ("a", None, "b"):
            times = sorted(t for k, t in rows if k == key)
            beside = [None, *times[:-1]] if backwards else [*times[1:], None]
            want += [(key, t, n) for t, n in zip(times, beside, strict=True)]
        found = next_time(frame, ["k"], "t", "n", backwards, span_ns=10).select("k", "t", "n").collect()
        assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want))


def test_gaps_resolve_in_later_spans(spark):
    from tickloom.operators.quality import gap_ledger

    hour = 3_600_000_000_000
    gaps = spark.createDataFrame([("x", "g1", 0, 5), ("x", "g2", 0, hour + 5), ("x", "g3", 0, 9 * hour), (None, "g4", 0, 7)], "k string, gap_id string, start_ns long, end_ns long")
    seen = spark.createDataFrame([("x", 4), ("x", 5), ("x", 3 * hour), (None, 2 * hour)], "k string, at long")
    found = {r.gap_id: r.resolved_ns for r in gap_ledger(gaps, seen, ["k"], "at").collect()}
    assert found == {"g1": 5, "g2": 3 * hour, "g3": None, "g4": 2 * hour}


def test_liquidation_window_claims(spark):
    from pyspark.sql import functions as F

    from tickloom.functions.scalars import liquidation_window_fits

    rows = [
        ("complete", "all_observed", None, None, 0, False, True),
        ("complete", "largest_per_symbol", None, None, 0, False, False),
        ("largest_in_window", "largest_per_symbol", 0, 10, 10, True, True),
        ("largest_in_window", "largest_per_symbol", 0, 10, 9, True, False),
        ("trade_flag_only", "unknown", None, 4, 0, False, False),
        ("trade_flag_only", "unknown", None, None, 0, False, True),
        ("other", "unknown", None, None, 0, False, False),
    ]
    names = ["c", "s", "a", "b", "d", "p"]
    frame = spark.createDataFrame(rows, "c string, s string, a long, b long, d long, p boolean, want boolean")
    assert frame.where(liquidation_window_fits(*(F.col(n) for n in names)) != F.col("want")).count() == 0


def test_intervals_of_mixed_lengths(spark):
    """Points and pairs against plain comparison: short, long, empty, inverted, negative and open intervals, ties, null keys."""
    import random

    rng = random.Random(2)

    def intervals(n, tag):
        out = []
        for i in range(n):
            start = rng.randrange(-500, 5000)
            end = rng.choice([None, start, start - 3, start + 1, start + rng.randrange(1, 20), start + rng.randrange(1, 4000), start + 64])
            out.append((rng.choice(["k", "m", None]), start, end, f"{tag}{i}"))
        return out

    left, right = intervals(120, "l"), intervals(120, "r")
    ends = lambda x: float("inf") if x is None else x
    frame = lambda rows, s: spark.createDataFrame(rows, f"k string, {s}_start long, {s}_end long, {s}_id string")
    found = [(r.l_id, r.r_id) for r in joins.overlapping_pairs(frame(left, "l"), frame(right, "r"), ["k"], narrowest=4).collect()]
    want = [(a[3], b[3]) for a in left for b in right if a[0] and a[0] == b[0] and max(a[1], b[1]) < min(ends(a[2]), ends(b[2]))]
    assert sorted(found) == sorted(want) and len(want) > 100
    events = [(i, rng.choice(["k", "m", None]), rng.randrange(-600, 6000)) for i in range(200)]
    windows = spark.createDataFrame(left, "k string, start_ns long, end_ns long, wid string")
    rows = joins.containing_windows(spark.createDataFrame(events, "id long, k string, t long"), windows, ["k"], "t", "wid", "ids", ["id"], narrowest=4).collect()
    assert {r.id: r.ids for r in rows} == {i: sorted(w[3] for w in left if k and w[0] == k and w[1] <= t < ends(w[2])) for i, k, t in events}
    pieces = joins.in_buckets(windows, narrowest=4).groupBy("wid").count()
    assert pieces.agg(F.max("count")).first()[0] <= 2


@pytest.mark.parametrize("rows", [0, 3, 200, 3000])
def test_digest_trees_are_canonical(spark, rows):
    """Whatever the depth and the other groups, and by the rule written out in Python."""
    import hashlib

    df = spark.range(rows).selectExpr("id % 2 AS g", "id div 2 AS v").unionByName(spark.range(rows // 3).selectExpr("0L AS g", "id div 2 AS v"))
    found = {r.g: (r.n, r.digest) for r in digests.multiset_digest(df, ["g"], leaf_rows=32).collect()}
    assert {r.g: (r.n, r.digest) for r in digests.multiset_digest(df, ["g"], leaf_rows=32, depth=5).collect()} == found
    one = digests.multiset_digest(df.where("g = 1"), ["g"], leaf_rows=32).collect()
    assert {r.g: (r.n, r.digest) for r in one} == {g: x for g, x in found.items() if g == 1}
    hashes = {}
    for r in df.select("g", digests.row_hash(df, ["g"]).alias("h")).collect():
        hashes.setdefault(r.g, []).append(r.h)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()

    def node(hs, prefix):
        different = sorted(set(hs))
        if len(different) <= 32:
            return sha(",".join(f"{h}*{hs.count(h)}" for h in different))
        kids = [(c, [h for h in hs if h[len(prefix)] == c]) for c in "0123456789abcdef"]
        return sha(",".join(f"{c}:{node(k, prefix + c)}" for c, k in kids if k))

    assert found == {g: (len(hs), node(hs, "")) for g, hs in hashes.items()}


def test_differences_open_only_unequal_branches(spark):
    a = spark.range(4000).selectExpr("if(id % 2 = 0, 'x', null) AS g", "id AS v")
    b = a.where("v <> 17").unionByName(spark.createDataFrame([("x", 18), ("y", 1), (None, 9001)], "g string, v long"))
    hashes = {r.h: (r.g, r.v) for r in a.union(b).select("g", "v", digests.row_hash(a, ["g"]).alias("h")).collect()}
    found = digests.differences(a, b, ["g"], leaf_rows=32).collect()
    assert sorted((repr(r.g), hashes[r.row_hash][1], r.n_a, r.n_b) for r in found) == [("'x'", 18, 1, 2), ("'y'", 1, 0, 1), ("None", 17, 1, 0), ("None", 9001, 0, 1)]
    assert all(r.row_hash.startswith(r.prefix) for r in found)
    assert digests.differences(a, a.repartition(3), ["g"], leaf_rows=32).count() == 0


def test_ordered_digest_binds_places(spark):
    rows = [("g", n, v) for n, v in enumerate("abcab")]
    frame = spark.createDataFrame(rows, "g string, n long, v string")
    moved = frame.withColumn("n", F.when(F.col("n") == 1, 2).when(F.col("n") == 2, 1).otherwise(F.col("n")))
    of = lambda f, span: digests.ordered_digest(f, ["n"], ["g"], span=span).first().digest
    assert of(frame, 2) == of(frame.repartition(3), 8) != of(moved, 2)


def test_running_values_over_chunks(spark):
    import random

    rng = random.Random(1)
    rows = [(rng.choice(["a", "a", "a", None, "b"]), rng.randrange(100), i, rng.choice([None, rng.randrange(50)])) for i in range(400)]
    frame = spark.createDataFrame(rows, "k string, t long, i long, v long")
    for inclusive in (True, False):
        got = windows.carried(frame, ["k"], windows.spans("t", 7), ["t", "i"], {"s": F.col("v"), "c": F.lit(1).cast("long")}, {"m": F.col("v")}, inclusive).collect()
        for r in got:
            seen = [x for x in rows if x[0] == r.k and ((x[1], x[2]) < (r.t, r.i) or (inclusive and x[2] == r.i))]
            values = [x[3] for x in seen if x[3] is not None]
            assert (r.s, r.c, r.m) == (sum(values), len(seen), max(values, default=None))
        assert len(got) == len(rows)
    plan = windows.ordinal_gaps(frame, ["k"], "t")._jdf.queryExecution().optimizedPlan().toString()
    assert "__chunk" in plan


def test_only_committed_partitions_are_read(spark, tmp_path):
    rows = spark.range(4000).selectExpr("concat('I', id % 5) AS instrument_uid", "id * 100000000000 AS received_time_ns", "'s' AS source_id", "id AS native_trade_id")
    tables.write_partitions(rows, "trade", f"{tmp_path}/family")
    all_ = tables.read_family(spark, f"{tmp_path}/family").select(*tables.PARTITION).distinct()
    total = all_.count()
    all_.withColumn("state", F.when(F.col("hour") == 3, "committed").otherwise("open")).write.parquet(f"{tmp_path}/manifests")
    found = tables.read_committed(spark, f"{tmp_path}/family", spark.read.parquet(f"{tmp_path}/manifests"))
    assert {r.h for r in found.selectExpr("received_time_ns div 3600000000000 % 24 AS h").collect()} == {3} and total > 100
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
    scanned = read_partitions(found)
    assert scanned == found.select(*tables.PARTITION).distinct().count() < total / 20


def read_partitions(df):
    """How many partitions the scan of a family read, by the plan's own metrics."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, seen = [plan], []
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        elif name.startswith("Scan parquet"):
            metric = node.metrics().get("numPartitions")
            seen += [metric.get().value()] if metric.isDefined() else []
        children = node.children()
        todo += [children.apply(i) for i in range(children.length())]
    return max(seen)


def test_busy_hours_are_many_files(spark, tmp_path):
    rows = spark.range(900).selectExpr("'hot' AS instrument_uid", "id * 3000000000 AS received_time_ns", "'s' AS source_id", "id AS native_trade_id")
    rows = rows.unionByName(spark.range(5).selectExpr("'I' AS instrument_uid", "(id + 2) * 3600000000000 AS received_time_ns", "'s' AS source_id", "id + 1000 AS native_trade_id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the rows are few
    tables.write_partitions(rows, "trade", str(tmp_path), rows_per_file=90)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    found = tables.read_family(spark, str(tmp_path)).withColumn("file", F.input_file_name())
    files = {r.hour: (r.n, r.files) for r in found.groupBy("hour").agg(F.count("*").alias("n"), F.count_distinct("file").alias("files")).collect()}
    assert files[0][0] == 900 and 2 <= files[0][1] <= 4 and files[3] == (1, 1) and found.count() == 905
    for part in found.select("file", "native_trade_id").toPandas().groupby("file"):
        assert part[1].native_trade_id.is_monotonic_increasing


def test_an_export_is_the_same_whatever_the_order(spark, tmp_path):
    from tickloom.operators import venues

    def message(n):
        price = '"1e3"' if n % 10 == 3 else f'"{n}.5"'
        return (n, "s", "c" if n % 10 else "unbound", "e", n * 10**12, f'{{"e":"trade","E":1,"s":"X","t":{n},"p":{price},"q":"1","T":1,"m":true,"M":true}}')

    raw = spark.createDataFrame([message(n) for n in range(60)], "record_id long, source_id string, channel_id string, epoch_id string, received_time_ns long, payload string")
    bindings = spark.createDataFrame([("c", "v1", 0, None)], "channel_id string, mapper_version string, valid_from_ns long, valid_to_ns long")
    registry = N.Registry()

    def mapper(rows):
        good, bad = N.split(N.apply(rows, venues.SPOT["trade"], keep=["record_id", "source_id", "epoch_id", "received_time_ns"]))
        return good.withColumnRenamed("symbol", "instrument_uid"), bad.select("record_id", "code")

    registry.register("s", "c", "v1", mapper)
    made = [tables.export(r, bindings, registry, "trade", f"{tmp_path}/{n}") for n, r in enumerate((raw, raw.orderBy(F.desc("record_id")).repartition(5)))]
    codes = {(r.record_id, r.code) for r in made[0]["quarantine"].collect()}
    assert codes == {(n, "mapper_binding_unavailable") for n in range(0, 60, 10)} | {(n, "invalid_field") for n in range(3, 60, 10)}
    listed = [sorted(map(tuple, m["manifests"].collect())) for m in made]
    assert listed[0] == listed[1] and {r.state for r in made[0]["manifests"].collect()} == {"committed"} and made[0]["rows"].count() == 48
    assert made[0]["accounting"].count() == 0


def test_runs_that_agree_differ_in_nothing(spark):
    from tickloom.operators import cutover

    rows = spark.createDataFrame([("s", n, n * 5, str(n)) for n in range(20)], "scope string, record_id long, t long, value string").withColumn("mapper_version", F.lit("v1"))
    bad = spark.createDataFrame([("s", 30, 7, "x"), ("s", 31, 8, "y"), ("z", 32, 9, "y")], "scope string, record_id long, t long, code string")
    how = (["scope"], ["t", "record_id"], ["record_id"])
    report = lambda a, b: sorted(tuple(r) for r in cutover.compare_runs(a, b, *how, span=8).collect())
    old = cutover.Run(rows, bad)
    assert report(old, cutover.Run(rows.repartition(3).withColumn("mapper_version", F.lit("v2")), bad)) == []
    value = F.when(F.col("record_id") == 11, None).otherwise(F.col("value"))
    assert report(old, cutover.Run(rows.withColumn("value", value), bad)) == [("s", cutover.ROWS, 11)]
    assert report(old, cutover.Run(rows.where("record_id < 18"), bad)) == [("s", cutover.ACCEPTED, 18), ("s", cutover.ROWS, 18)]
    other = bad.withColumn("code", F.when(F.col("record_id") == 31, "x").otherwise(F.col("code")))
    assert report(old, cutover.Run(rows, other)) == [("s", cutover.COUNTS, 0), ("s", cutover.REJECTED, 1)]
    assert report(old, cutover.Run(rows, bad.where("scope = 's'"))) == [("z", cutover.COUNTS, 0), ("z", cutover.REJECTED, 0)]
