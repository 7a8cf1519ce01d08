"""Filter audit, periodic runs and exact copies against brute force, and on awkward rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.llm import audit, exact, periodic
from tickloom.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, n long"
LONG = "a b c " * 4000 + "Z" * 30_000
ODD = [
    (1, "the cat sat", "en", 1), (1, "the cat sat", "en", 1), (1, "another text, same id", None, 2), (2, "The CAT sat", "en", 1), (3, None, "en", None),
    (4, "", "", 0), (5, " \t\n ", "de", 0), (None, "a text without an id", "x", 1), (None, "a text without an id", "x", 1), (None, None, None, None),
    (6, LONG, "en", 1), (7, LONG.lower(), "en", 1), (8, "ÀÉ ünïcödé 漢字 😀 \x00 nul", "en", 1), (9, "àé ünïcödé 漢字 😀 \x00 nul", "en", 1), (10, "go go go go go go #go", None, 1),
]
CLASHING = ("__id", "__hash", "__row", "__text", "__size", "keep_id", "kept", "group_size", "part", "mask", "state", "good", "t", "start", "period", "n_runs")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).withColumns({c: F.lit(1) for c in CLASHING})


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- exact copies --------------------------------------------------------------------------------------------


def plain_copies(rows, keep):
    groups: dict[str, list] = {}
    for i, text, *_ in rows:
        groups.setdefault(lower(text), []).append(i)
    pick = max if keep == "largest" else min
    kept = {t: pick([i for i in ids if i is not None], default=None) for t, ids in groups.items()}
    return sorted((repr(i), repr(kept[lower(t)]), len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest()) for i, t, *_ in rows)


@pytest.mark.parametrize("keep", ["largest", "smallest"])
@pytest.mark.parametrize("bits", [128, 4, 0])
@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_copies(spark, odd, keep, bits, broadcast):
    """With a digest of few bits most groups hold several texts, and with none all rows are one group."""
    digest = {128: exact.md5_bytes, 4: lambda t: F.substring(F.md5(t.cast("binary")), 1, 1), 0: lambda t: F.lit("")}[bits]
    sha = {"text_sha256": F.sha2(exact.lower_ascii(F.coalesce("text", F.lit(""))).cast("binary"), 256)}
    found = exact.copies(odd, keep=keep, digest=digest, broadcast_groups=broadcast, carry=sha).collect()
    assert sorted((repr(r.doc_id), repr(r.keep_id), r.group_size, r.text_sha256) for r in found) == plain_copies(ODD, keep)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)
    assert sum(r.kept for r in found) == len({lower(t) for _, t, *_ in ODD})


def test_copies_of_many_rows_stay_whole(spark):
    """A third of the rows are one text: above the thousandth that goes by broadcast, as is the pair of each other text."""
    docs = spark.range(0, 3000, 1, 7).selectExpr("id AS doc_id", "if(id % 3 = 0, 'Hot', concat('t', id % 1000)) AS text")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = exact.exact_dedup(docs, keep="largest").collect()
    assert sorted((repr(r.doc_id), repr(r.keep_id), r.group_size, r.text_sha256) for r in found) == plain_copies(rows, "largest")
    assert sum(r.kept for r in found) == len({t for _, t in rows})


def test_survivors_keep_their_columns(spark, odd):
    left = exact.survivors(odd.select("doc_id", "text", "lang", "n", "kept"), keep="largest").collect()
    assert len(left) == len({lower(t) for _, t, *_ in ODD}) and set(left[0].asDict()) == {"doc_id", "text", "lang", "n", "kept"}
    assert exact.exact_dedup(odd.limit(0)).count() == 0 and exact.survivors(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        exact.copies(odd, keep="any")


def test_exact_dedup_runs_no_python(spark, odd):
    plan = exact.exact_dedup(odd, keep="largest")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---- filter audit --------------------------------------------------------------------------------------------


def plain_audit(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    first = {}
    for i, t, *_ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    rows = []
    for i, t, lang, *_ in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {f for f, is_so in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            bool(re.search(r"[#$%&*|]", t)), i is not None and i > first[t]), strict=True) if is_so}
        rows.append((lang or "", fails, i in good, i in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                removed = [r for r in mine if f in r[1] and not before & r[1]]
                total[f] += len(removed)
                out[part, "".join(order), step] = [
                    sum(not (before | {f}) & r[1] for r in mine), len(removed), sum(f in r[1] and bool(before & r[1]) for r in mine),
                    sum(r[1] == {f} for r in mine), sum(r[2] for r in removed), sum(r[3] for r in removed),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_filter_audit(spark, odd):
    text = lambda n, words, extra="": " ".join(f"w{i % words}" for i in range(n)) + extra
    more = [(20 + n, text(*x), lang, 0) for n, (x, lang) in enumerate(((x, lang) for lang in ("en", "de") for x in (
        (250, 250), (250, 250), (250, 40), (250, 200, " A" * 60), (199, 199), (200, 100), (200, 99), (220, 220, " #"), (10, 3, " $ QQ"), (10, 3, " $ QQ"))))]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(40)] + [(1, 1, 0), (1, 0, 1), (None, 1, 1), (20, None, None), (999, 1, 1)]
    docs = odd.select(*odd.columns).unionByName(spark.createDataFrame(more, SCHEMA), allowMissingColumns=True)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("part", F.lit("x"))
    found = audit.filter_audit(docs, marks).collect()
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in found}
    want = plain_audit(ODD + more, labels)
    assert len(found) == len(got) == 600 * len({(r[2] or "") for r in ODD + more}) and got == want
    assert audit.filter_audit(docs.limit(0), marks).count() == 0
    assert {r.good_lost + r.toxic_lost for r in audit.filter_audit(docs, marks.limit(0)).collect()} == {0}


@pytest.mark.parametrize("filters", [1, 2, 3, 5, 6])
def test_paths_are_orders(filters):
    reaching, leaving = audit.path_counts(filters)
    for state in range(1 << filters):
        chosen = {f for f in range(filters) if state >> f & 1}
        through = [p for p in permutations(range(filters)) if set(p[: len(chosen)]) == chosen]
        assert reaching[state] * leaving[state] == len(through)
    assert reaching[-1] == leaving[0] == len(list(permutations(range(filters))))


def test_audit_of_other_filters(spark):
    cells = spark.createDataFrame([("p", 0, 5, 1, 0), ("p", 1, 3, 1, 0), ("p", 3, 2, 0, 2)], "part string, mask int, n long, good long, toxic long")
    rows = {(r.filter_order, r.step): r for r in audit.interaction_audit(cells, "XY").collect()}
    assert (rows["XY", 1].removed, rows["XY", 2].removed, rows["YX", 1].removed, rows["YX", 2].removed) == (5, 0, 2, 3)
    assert rows["XY", 1].shapley == 8 and rows["XY", 2].shapley == 2 and rows["YX", 2].kept == 5 and rows["XY", 2].redundant == 2
    with pytest.raises(ValueError):
        audit.interaction_audit(cells, "ABCDEFGH")


# ---- periodic runs -------------------------------------------------------------------------------------------


def plain_runs(words, least=6, times=4):
    """By comparing all words at each distance."""
    out = []
    for q in range(1, len(words) // times + 1):
        start = 0
        for i in range(len(words) - q + 1):
            if i == len(words) - q or words[i] != words[i + q]:
                length = i - start + q
                part = words[start : start + length]
                if length >= max(least, times * q) and not any(all(part[j] == part[j + p] for j in range(length - p)) for p in range(1, q)):
                    out.append((start, length, q))
                start = i + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(text, least=6, times=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = plain_runs(words, least, times)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    collapsed = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(listed), sha(collapsed))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=6), st.sampled_from([(6, 4), (3, 3), (1, 5)]))
def test_runs_of_small_alphabets(texts, rule):
    sizes = [len(t) for t in texts]
    ends = np.repeat(np.cumsum(sizes), sizes).astype(np.int64)
    found = periodic.runs_of(np.array([w for t in texts for w in t], np.int64), ends, *rule)
    want = [(s + sum(sizes[:n]), k, q) for n, t in enumerate(texts) for s, k, q in plain_runs(t, *rule)]
    assert [tuple(r) for r in found] == sorted(want, key=lambda r: (r[0], r[2]))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 7), st.integers(0, 8)), max_size=6))
def test_runs_of_planted_periods(parts):
    words = [w for root, times, more in parts for w in root * times + root[: more % len(root)]]
    found = periodic.runs_of(np.array(words, np.int64), np.full(len(words), len(words), np.int64))
    assert [tuple(r) for r in found] == plain_runs(words)


def test_periodic_runs_on_awkward_rows(spark, odd):
    found = periodic.periodic_runs(odd, chunk_bytes=100, with_texts=True).collect()
    got = sorted((repr(r.doc_id), *map(repr, tuple(r)[1:8])) for r in found)
    rows = [(i, t if len(t or "") < 1000 else "a b c " * 4000 + t[-30_000:]) for i, t, *_ in ODD]
    brief = lambda t: plain_row(t) if len(t or "") < 1000 else None
    assert len(got) == len(rows)
    want = sorted((repr(i), *map(repr, x)) for i, t in rows if (x := brief(t)))
    assert [g for g in got if g[0] not in ("6", "7")] == want
    for r in found:
        if r.doc_id in (6, 7):
            assert (r.n_runs, r.start, r.length, r.period, r.runs) == (1, 0, 12_000, 3, "0,12000,3\n")
            assert r.collapsed == "a b c " + ("Z" if r.doc_id == 6 else "z") * 30_000
    assert periodic.periodic_runs(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.runs_of(np.zeros(4, np.int64), np.full(4, 4), times=2)


def test_the_query_plants_and_finds_periods(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(int(i), " ".join(f"w{x}" for x in rng.integers(0, 4, int(n))) + " \t") for i, n in enumerate(rng.integers(0, 70, 500))]
    rows += [(None, "x " * 9), (501, None), (505, ""), (512, "  ")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")

    def planted(i, text):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h = zlib.crc32(str(i).encode())
        if i is None or h % 10 or not words:
            return text
        a = h // 10 % len(words)
        p = 1 + (len(words) - a) // (3 + h // 10 % 8)
        return " ".join(words[:a] + [words[a + j % p] for j in range(len(words) - a)])

    found = QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()
    want = [(i, *plain_row(planted(i, t))) for i, t in rows]
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, want)) and sum(r.n_runs > 0 for r in found) > 25
