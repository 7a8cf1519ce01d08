"""Tiles of the near-duplicate stage: SimHash radius, and pairs that share many shingles."""

import numpy as np
import pyarrow as pa

from tickloom.llm import near_copies


def _tile_rows(sets, tokens):
    """Rows of one cell a token, as the tiles of near copies take them; every set is a node of its own."""
    rows = []
    early = sorted(tokens)[: near_copies.EARLY]
    for cell, token in enumerate(tokens):
        for key, s in enumerate(sets):
            bits = near_copies.parities(s)[0]
            prints = np.array(near_copies.majority(s, near_copies.WORDS), np.uint64).view(np.int64)
            padded = [*early, *[2**63 - 1] * (near_copies.EARLY - len(early))]
            rows.append([cell, 0, key, key, len(s), token, *bits.tolist(), *prints.tolist(), *padded])
    columns = np.array(rows, np.int64).T
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [f"c{i}" for i in range(len(columns))])


def test_tiles_give_a_pair_once():
    """Eight near copies that share forty shingles are 28 pairs, not 28 for each shingle."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 200, dtype=np.uint64)
    sets = [np.unique(np.r_[base, rng.integers(0, 2**63, 5, dtype=np.uint64)]) for _ in range(8)]
    found = list(near_copies._pairs(0.8)(iter([_tile_rows(sets, base[:40].view(np.int64).tolist())])))
    pairs = [(u, v) for b in found for u, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
    assert sorted(pairs) == [(u, v) for u in range(8) for v in range(u + 1, 8)]


def test_tiles_compare_simhashes():
    """Long sets whose parities are all noise are told apart by their SimHash, and links lie within its radius."""
    rng = np.random.default_rng(6)
    far = [np.unique(rng.integers(0, 2**63, 8000, dtype=np.uint64)) for _ in range(4)]
    assert not sum(b.num_rows for b in near_copies._pairs(0.8)(iter([_tile_rows(far, [7])])))
    most, worst = near_copies.radius(0.8), 0
    assert near_copies.bit_differs(0.8) == near_copies.bit_differs(0.8, 40) == 0.1875
    for shared, a, b in [(4, 1, 0), (8, 1, 1), (80, 10, 10), (4000, 500, 500)] * 20:
        x = rng.integers(0, 2**63, shared + a + b, dtype=np.uint64)
        prints = (near_copies.majority(y, near_copies.WORDS) for y in (x[: shared + a], np.r_[x[:shared], x[shared + a :]]))
        worst = max(worst, sum((p ^ q).bit_count() for p, q in zip(*prints, strict=True)))
    assert worst <= most < 64 * near_copies.WORDS // 3
