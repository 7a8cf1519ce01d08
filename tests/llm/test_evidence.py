"""Personal data and shards against brute force, added spans on planted forms, page labels under lost tags and names."""

import hashlib
import math
import random
import time
from itertools import product
from pathlib import Path

import numpy as np
import pytest

from tickloom.llm import ann, html_text, pii, secrets, sharding

SCHEMA = "doc_id long, text string, source string"


def test_marginals_are_those_of_all_paths():
    rng = np.random.default_rng(3)
    lengths, top, labels = [1, 3, 4], 4, 3
    e, move = rng.normal(size=(3, top, labels)), rng.normal(size=(labels, labels))
    inside = np.arange(top) < np.array(lengths)[:, None]
    log_z, node, pairs = pii.marginals(e * inside[:, :, None], move, inside)
    want_pairs = np.zeros_like(move)
    for c, n in enumerate(lengths):
        paths = list(product(range(labels), repeat=n))
        scores = np.array([sum(e[c, t, x] for t, x in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:], strict=False)) for p in paths])
        z = np.log(np.exp(scores).sum())
        assert log_z[c] == pytest.approx(z)
        share = np.exp(scores - z)
        want = np.zeros((top, labels))
        for p, s in zip(paths, share, strict=True):
            for t, x in enumerate(p):
                want[t, x] += s
            for a, b in zip(p, p[1:], strict=False):
                want_pairs[a, b] += s
        assert np.allclose(node[c], want)
    assert np.allclose(pairs, want_pairs)


def test_the_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(4)
    e, move = rng.normal(size=(2, 3, 4)), rng.normal(size=(4, 4))
    inside = np.ones((2, 3), bool)
    _, node, pairs = pii.marginals(e, move, inside)
    total = lambda e, m: pii.marginals(e, m, inside)[0].sum()
    for at in ((0, 1, 2), (1, 2, 0)):
        up, down = e.copy(), e.copy()
        up[at] += 1e-5
        down[at] -= 1e-5
        assert (total(up, move) - total(down, move)) / 2e-5 == pytest.approx(node[at], rel=1e-4)
    up, down = move.copy(), move.copy()
    up[1, 3] += 1e-5
    down[1, 3] -= 1e-5
    assert (total(e, up) - total(e, down)) / 2e-5 == pytest.approx(pairs[1, 3], rel=1e-4)


def plain_chains(text):
    words, at = [], 0
    for w in text.split(" "):
        if w:
            words.append((w, at))
        at += len(w) + 1
    marked = [i for i, (w, _) in enumerate(words) if any(c in "0123456789@" for c in w)]
    out = []
    for i in marked:
        a, b = max(0, i - 2), min(len(words) - 1, i + 2)
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [words[a : b + 1] for a, b in out]


def test_chains_hold_whole_words_however_long():
    rng = random.Random(6)
    for _ in range(300):
        text = " ".join(rng.choice(["a", "bc", "x" * rng.randint(1, 500), "7", "q@r", "y" * 130 + "5", " " * rng.randint(0, 200)]) for _ in range(rng.randint(0, 30)))
        assert pii.chains(text) == plain_chains(text)


def test_spans_near_a_place():
    rng = random.Random(7)
    spans = [(k, *x) for k in pii.KINDS for x in sorted({(10 * n, 10 * n + rng.randint(1, 10)) for n in rng.sample(range(40), 12)})]
    near = pii.Near(spans)
    for _ in range(500):
        a = rng.randint(0, 400)
        b = a + rng.randint(1, 40)
        assert near.spans(a, b) == [s for s in spans if s[1] < b and s[2] > a]


def trained():
    rng = random.Random(2)
    chains, marks = [], []
    for i in range(400):
        digits = f"4{rng.randint(10**14, 10**15 - 1)}"
        card = next(digits[:15] + str(c) for c in range(10) if pii.luhn(digits[:15] + str(c)))
        say = [f"call +1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)} soon", f"mail bob{i}@mail.example.com now", f"at 10.0.{i % 200}.7 it is", f"pay {card} today", f"in {rng.randint(1900, 2030)} there were {rng.randint(1, 99)} of them", f"order {rng.randint(10**8, 10**9)} was sent"]
        text = "words go here and " + rng.choice(say) + " and end here"
        near = pii.Near(pii.base_spans(text))
        for chain in pii.chains(text):
            chains.append([w for w, _ in chain])
            marks.append(pii._labels(chain, near.spans(0, len(text))))
    pairs = [p for c, m in zip(chains, marks, strict=True) for p in pii.rewritten(c, m)]
    return pii.fit_crf([a for a, _ in pairs], [b for _, b in pairs])


def test_added_personal_data_on_forms_that_the_patterns_miss():
    """Precision and recall of 0.9 at least over planted forms and hard negatives."""
    rng = random.Random(8)
    crf, hits, wanted, wrong = trained(), 0, 0, 0
    for i in range(400):
        digits = f"5{rng.randint(10**14, 10**15 - 1)}"
        card = next(digits[:15] + str(c) for c in range(10) if pii.luhn(digits[:15] + str(c)))
        kind, piece = [
            ("phone", f"({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"), ("email", f"ann{i} @ post.example.org"), ("card", ".".join(card[n : n + 4] for n in range(0, 16, 4))),
            (None, f"{rng.randint(1900, 2030)}"), (None, f"{rng.randint(10**8, 10**9)}"), (None, f"chapter {i % 9}.{i % 7}.{i % 5}"),
        ][i % 6]
        text = f"we saw this {piece} in the text and left"
        ((base, every),) = pii.find([text], crf)
        added = [s for s in every if s not in base]
        want = (kind, 12, 12 + len(piece))
        if kind:
            wanted += 1
            hits += want in added
        wrong += sum(s != want for s in added) if kind else len(added)
    assert hits / wanted >= 0.9 and hits / max(1, hits + wrong) >= 0.9, (hits, wanted, wrong)


def test_time_grows_with_the_text_not_with_its_square():
    crf = trained()
    spent = []
    for n in (1500, 6000):
        text = " ".join(f"+1 (555) 01{i % 10}-{i:04d} w" for i in range(n))
        start = time.process_time()
        pii.find([text], crf)
        spent.append(time.process_time() - start)
    assert spent[1] < 9 * spent[0] + 0.5


def test_added_secrets_on_planted_runs():
    """Random keys are found, words, digests, numbers and names are not: precision and recall of 0.9 at least."""
    import public_tokenizers

    encoding = secrets.vocabulary(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rng = random.Random(9)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    found = sum(bool(secrets.random_spans(f"so {''.join(rng.choices(alphabet, k=32))} is", encoding, 2.2)) for _ in range(200))
    clean = [hashlib.sha256(bytes([n])).hexdigest() for n in range(50)] + ["getUserAccountSettings", "internationalization", "the_quick_brown_fox_jumps", "123456789012345678901234"]
    wrong = sum(bool(secrets.random_spans(f"so {w} is", encoding, 2.2)) for w in clean)
    assert found >= 180 and wrong <= 5, (found, wrong)


def plain_shard(key, tree):
    """Walks the tree level by level, with draws recomputed from the digest."""

    def draw(child, weight):
        u = (int(hashlib.md5(f"{key}|{child}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
        return -math.log(u) / weight

    weight = lambda node: sum(map(weight, node.values())) if isinstance(node, dict) else node
    region = min(tree, key=lambda r: draw(r, weight(tree[r])))
    rack = min(tree[region], key=lambda k: draw(f"{region}/{k}", weight(tree[region][k])))
    return min(tree[region][rack], key=lambda s: draw(f"{region}/{rack}/{s}", tree[region][rack][s]))


def test_shards_are_those_of_a_walk_through_the_tree(spark):
    from pyspark.sql import functions as F

    odd = {"a": {"x": {0: 0.5, 1: 3.0}, "y": {2: 1.0}}, "b": {"z": {3: 2.0, 4: 0.1, 5: 1.0}}}
    for tree in (sharding.regular_tree(8), sharding.with_shard(sharding.regular_tree(8), 8), odd):
        rows = spark.range(1500).select("id", sharding.shard_of(F.col("id"), tree).alias("s")).collect()
        assert [r.s for r in rows] == [plain_shard(r.id, tree) for r in rows]


# ---- 4 -------------------------------------------------------------------------------------------------------


@pytest.mark.skipif(not Path("/root/testdata/sf0.1").exists(), reason="no test tables here")
def test_the_cut_helps_where_tags_and_names_are_lost(spark):
    """Trained on one half of the pages and held against forgetful copies of all pages of the other half: 98.46 % right alone, 98.81 % by the cut."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    model = html_text.train(pages.where("page_id % 2 = 0"))
    unseen = html_text.sample(pages.where("page_id % 2 = 1"), "page_id", "html", 2000)
    by = html_text.agreement(unseen, model.weights, (0.0, model.smooth))
    (n, alone, none), (_, cut, moved) = by[0.0], by[model.smooth]
    print(f"{n} blocks, right alone {alone}, right by the cut {cut}, moved by the cut {moved}")
    assert none == 0 and moved > n / 500
    assert alone < cut and cut / n > 0.975


def test_comments_within_an_article_stay_out_and_trust_is_bounded():
    page = """<body><div class="content"><main><article class="entry"><h1>Title of it</h1><p>A paragraph of some length, which says a thing or two.</p>
    <section id="comments"><div><p>Reader one: a long remark, which is as much like text as the paragraphs are, in every way.</p></div></section>
    <p>Another paragraph, of about the same length as the first one.</p></article></main></div></body>"""
    rng, whole = np.random.default_rng(3), html_text.blocks(page)
    assert [b.odds > 0 for b in whole] == [True, True, False, True]
    features = np.repeat(html_text.features(whole), 5, 0)
    weights = html_text.fit(features, rng.integers(0, 2, len(features)), np.ones(len(features)))
    tree = weights[html_text.TEXT :]
    assert (tree >= html_text.TRUST[0]).all() and (tree <= html_text.TRUST[1]).all()
    likes_text = np.concatenate([np.full(html_text.TEXT, 9.0), html_text.TRUST[1]])
    likes_text[html_text.TEXT + 1 : html_text.TEXT + 3] = html_text.TRUST[0, 1:3]
    assert html_text.costs(whole, likes_text)[2] < 0
    assert "remark" not in html_text.main_text(page, html_text.PRIOR)


def test_forgetful_copies_keep_blocks_and_fit_recovers_a_rule():
    page = "".join(f'<{t} class="{c}"><p>Block {i} of text.</p></{t}>' for i, (t, c) in enumerate([("nav", "menu"), ("article", "post"), ("div", "ad"), ("aside", "")] * 8))
    for n, (found, labels) in enumerate(html_text.examples(page, -5, 3)):
        assert [b.text for b in found] == [f"Block {i} of text." for i in range(32)] and labels == [0, 1, 0, 0] * 8
        assert n == 0 or any(b.tree != w.tree for b, w in zip(found, html_text.blocks(page), strict=True))
    rng = np.random.default_rng(5)
    x = np.hstack([rng.normal(size=(400, html_text.TEXT)), np.zeros((400, html_text.TREE))])
    y = (x[:, 2] > x[:, 0]).astype(int)
    once, twice = html_text.fit(x, y, np.full(400, 2.0)), html_text.fit(np.repeat(x, 2, 0), np.repeat(y, 2), np.ones(800))
    assert np.allclose(once, twice) and ((x @ once > 0) == y).mean() > 0.98


# ---- 6 -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("k", [1, 5, 12])
def test_a_slot_abandons_much_where_bounds_help_and_little_is_lost(k):
    rng = np.random.default_rng(k)
    centres = rng.normal(size=(30, 64)) * 2
    vectors = centres[rng.integers(0, 30, 3000)] + rng.normal(size=(3000, 64)) * 0.4
    rotation, _ = np.linalg.qr(rng.normal(size=(64, 64)))
    slot, hits, shares = ann.Slot(vectors, rotation), 0, []
    for bounded in (False, True):
        slot.read = slot.whole = 0
        for q in vectors[:60]:
            apart = ann.lengths(vectors - q)
            bound = np.sort(apart[::7])[k - 1] ** 2 * (1 + 1e-9) if bounded else np.inf
            places = slot.scan(q @ rotation, k, bound)
            assert len(set(places.tolist())) == len(places)
            hits += len(set(places.tolist()) & set(apart.argsort()[:k].tolist()))
        shares.append(slot.read / slot.whole)
    assert hits / (2 * 60 * k) > 0.95 and shares[1] < 0.5 and shares[1] < shares[0]


def test_first_finds_leave_out_the_own_row_and_bound_the_search():
    rng = np.random.default_rng(2)
    sample, ids = rng.normal(size=(50, 8)), np.arange(50) * 100
    index = ann.Index(sample[:2], np.eye(8), 1, ids, sample)
    for own in (0, 4900, 7):
        near, score = index.first(own, sample[0], 10)
        apart = ann.lengths(sample - sample[0])
        apart[ids == own] = np.inf
        assert set(near.tolist()) == set(ids[apart.argsort()[:10]].tolist()) and own not in near
        assert score.max() == np.sort(apart)[9]
    assert len(ann.Index(sample[:2], np.eye(8), 1, ids[:3], sample[:3]).first(0, sample[0], 10)[0]) == 2
    assert len(ann.Index(sample[:2], np.eye(8), 1, ids[:0], sample[:0]).first(0, sample[0], 10)[0]) == 0
