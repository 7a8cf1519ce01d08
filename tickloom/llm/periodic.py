"""Periodic runs of words: stretches that repeat with a smallest period, found by a dictionary of basic factors.

Level k names every factor of 2^k words, so that equal factors of a text share a name; the names of level k + 1 are pairs
of names of level k. The next occurrence of a factor, if it starts within twice the factor's length, proposes the
distance as a period. Inside a run of period q a factor of q words or more recurs at distance q and at no smaller one, so
positions whose next occurrence is at one and the same distance follow each other: an arithmetic progression per
residue, and together one stretch that extends to the whole run.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def runs_of(words: np.ndarray, ends: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start, then period, in texts laid end to end.

    ``words`` are the word numbers of all texts, ``ends[i]`` is where the text of position i ends; positions are those
    of ``words``. A run has a smallest period q, max(least, times * q) words or more, and no neighbour in its text that
    continues it. ``times`` is 3 or more, which makes sure that a factor of q to 2q - 1 words recurs in the run.

    A period q belongs to the level whose factors have q to 2q - 1 words. There its stretch is exactly the starts of
    the run's factors that recur inside it, so the run ends where the last recurring factor ends: nothing is compared
    word by word and no run is found twice. Positions whose factor occurs once in the text take no part in higher
    levels. Time is the number of repeated factors times the sort; memory is a few arrays as long as ``words``.
    """
    if times < 3:
        raise ValueError("runs must hold their period three times at least")
    total = len(words)
    at = np.arange(total)
    names = np.full(total, -1, np.int64)
    # a word's first name is its number within its text, so that no factor is shared between texts
    keys = ends * (int(words.max(initial=0)) + 1) + words
    found, size = [], 1
    while len(at):
        order = np.argsort(keys, kind="stable")
        new = np.ones(len(at), bool)
        new[1:] = keys[order[1:]] != keys[order[:-1]]
        sorted_at = at[order]
        follows = ~new[1:]
        gap = np.zeros(total, np.int64)
        gap[sorted_at[:-1][follows]] = (sorted_at[1:] - sorted_at[:-1])[follows]
        starts = np.flatnonzero((gap > size // 2) & (gap <= size))
        if len(starts):
            gaps = gap[starts]
            head = np.ones(len(starts), bool)
            head[1:] = (starts[1:] != starts[:-1] + 1) | (gaps[1:] != gaps[:-1])
            first = np.flatnonzero(head)
            many = np.diff(np.append(first, len(starts)))
            period = gaps[first]
            length = many - 1 + size + period
            long = length >= np.maximum(least, times * period)
            found.append(np.stack([starts[first][long], length[long], period[long]], axis=1))
        again = np.zeros(len(at), bool)  # in sorted order: factors that occur more than once
        again[1:] |= follows
        again[:-1] |= follows
        names[:] = -1
        names[sorted_at[again]] = np.cumsum(new)[again]
        repeated = np.sort(sorted_at[again])
        repeated = repeated[repeated + 2 * size <= ends[repeated]]
        second = names[repeated + size]
        at = repeated[second >= 0]
        keys = names[at] * (total + 1) + second[second >= 0]
        size *= 2
    every = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def _row(words: list[bytes], runs: list[tuple[int, int, int]], dropped: np.ndarray | None) -> tuple:
    best = None
    for start, length, period in runs:
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    text = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = words if dropped is None else [w for w, gone in zip(words, dropped, strict=True) if not gone]
    collapsed = b" ".join(kept)
    digests = [hashlib.sha256(x).hexdigest() for x in (text.encode(), collapsed)]
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *digests, text, collapsed.decode())


def _rows(texts: list[bytes], least: int, times: int) -> list[tuple]:
    """One row per text; the runs of all of them are looked for together."""
    split = [t.split() for t in texts]  # bytes split at the six ASCII white-space characters, and no others
    numbers: dict[bytes, int] = {}
    words = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in split for w in ws), np.int64)
    sizes = np.array([len(ws) for ws in split], np.int64)
    to = np.cumsum(sizes)
    runs = runs_of(words, np.repeat(to, sizes), least, times)
    owner = np.searchsorted(to, runs[:, 0], side="right")
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
    np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
    dropped = np.cumsum(cover) > 0
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    for n, ws in enumerate(split):
        base, mine = int(to[n] - sizes[n]), runs[bounds[n] : bounds[n + 1]]
        listed = [(int(s) - base, int(k), int(q)) for s, k, q in mine]
        out.append(_row(ws, listed, dropped[base : base + len(ws)] if listed else None))
    return out


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, times: int = 4, with_texts: bool = False, chunk_bytes: int = 1 << 20
) -> DataFrame:
    """Runs of every whole text, and the text without the repetitions, as counts and digests.

    Returns doc_id, n_runs, the run of greatest length / period (ties: smallest start, then period; none: nulls) as
    start, length, period and exponent_milli, and digests of all runs and of the collapsed text: each run keeps its
    first period, words that any run covers beyond it go, words are joined by one space. With ``with_texts`` the runs
    (lines ``start,length,period``) and the collapsed text follow.

    A null text counts as empty: no runs, digests of the empty string. Words are what lies between the six ASCII
    white-space characters. Repeated rows come back as often as they went in, null ids stay null, other columns are
    not read, an empty table gives an empty result. Texts are taken together up to ``chunk_bytes``; a longer one is
    taken alone and whole, so memory is a few arrays over the longest text.
    """
    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    schema += ", runs string, collapsed string" if with_texts else ""
    kinds = [pa.int64()] * 5 + [pa.string()] * (4 if with_texts else 2)
    names = [c.split()[0] for c in schema.split(", ")]

    def emit(ids: list, texts: list[bytes]) -> pa.RecordBatch:
        columns = list(zip(*_rows(texts, least, times), strict=True))[: len(kinds)]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, waiting = [], [], 0
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                ids.append(key.as_py())
                texts.append((text.as_py() or "").encode())
                waiting += len(texts[-1])
                if waiting >= chunk_bytes:
                    yield emit(ids, texts)
                    ids, texts, waiting = [], [], 0
            if ids:
                yield emit(ids, texts)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return picked.mapInArrow(run, schema)


def with_planted_periods(text: Column, doc_id: Column) -> Column:
    """The text in which, for a tenth of the ids, all words from one on repeat periodically.

    With h = crc32 of the decimal id and g = h div 10, a text with h % 10 = 0 and n > 0 words takes its words from
    a = g % n on with period 1 + (n - a) div (3 + g % 8). A null text stays null, as does the text of a null id.
    """
    h = F.crc32(doc_id.cast("long").cast("string").cast("binary"))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    made = F.transform(F.array(F.struct(words.alias("w"), F.floor(h / 10).alias("g"))), _repeated)[0]
    return F.when((h % 10 == 0) & (F.size(words) > 0), made).otherwise(text)


def _repeated(x: Column) -> Column:
    words, g, n = x["w"], x["g"], F.size(x["w"])
    a = g % n
    p = F.floor((n - a) / (3 + g % 8)) + 1
    picked = F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int"))))
    return F.array_join(picked, " ")
