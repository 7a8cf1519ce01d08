"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may differ from a passage by k edits, k = error_rate * m. Cut into k + 1 pieces, at
least one piece of it must occur unchanged in any such passage. An Aho-Corasick automaton finds the pieces in
the whole text of every document; around each hit Myers' bit-parallel algorithm finds the smallest edit
distance of the item to any stretch of the document, and distances within the budget are reported.

Items and documents are compared lower-cased, with each run of white space as one space.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "doc_id long, item_id long, distance int, start int, end int"


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(length: int, error_rate: float, least_piece: int) -> int:
    """Edits allowed for an item: a share of its length, but no more than leaves pieces of ``least_piece``."""
    return max(0, min(int(length * error_rate), length // least_piece - 1))


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """(offset, piece): the item cut into k + 1 pieces of near equal length."""
    edges = [round(i * len(item) / (k + 1)) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:], strict=False)]


def myers(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(smallest distance, end): the pattern of m characters against every stretch of the text.

    One bit per pattern character in Python's whole numbers; ``end`` is the first place with the smallest
    distance. ``masks`` has the positions of each character in the pattern.
    """
    last, full = 1 << (m - 1), (1 << m) - 1
    plus, minus, score = full, 0, m
    best, end = m, 0
    for i, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        x = (((eq & plus) + plus) ^ plus) | eq | minus
        ph = minus | ~(x | plus) & full
        mh = plus & x
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
        ph = ph << 1 & full  # a match may start anywhere, so row zero stays zero
        mh = mh << 1 & full
        keep = eq | minus
        plus = mh | ~(keep | ph) & full
        minus = ph & keep
        if score < best:
            best, end = score, i
    return best, end


def positions(item: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


class Matcher:
    """Pieces of a block of items in one automaton, and what verifying their hits needs."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float, least_piece: int):
        import ahocorasick

        self.items, at = [], {}
        for item_id, text in items:
            if not text:
                continue
            k = budget(len(text), error_rate, least_piece)
            n = len(self.items)
            self.items.append((item_id, text, k, positions(text), positions(text[::-1])))
            for offset, piece in pieces(text, k):
                at.setdefault(piece, []).append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in at.items():
            self.automaton.add_word(piece, (len(piece), places))
        if at:
            self.automaton.make_automaton()
        self.empty = not at

    def matches(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) of the best passage for each item that the text contains."""
        if self.empty:
            return []
        starts: dict[int, list[int]] = {}
        for end, (length, places) in self.automaton.iter(text):
            for n, offset in places:
                starts.setdefault(n, []).append(end + 1 - length - offset)
        found = []
        for n, begun in starts.items():
            item_id, item, k, masks, backward = self.items[n]
            best, checked = None, -1
            for begin in sorted(set(begun)):
                if begin <= checked:  # that window was compared already
                    continue
                if not k and not whole_words(text, begin, begin + len(item)):
                    continue
                low, high = max(0, begin - k), begin + len(item) + 2 * k
                checked = begin + k
                distance, end = myers(masks, len(item), text[low:high])
                if distance <= k and (best is None or distance < best[0]):
                    _, back = myers(backward, len(item), text[low : low + end][::-1])
                    best = (distance, low + end - back, low + end)
                    if distance == 0:
                        break
            if best is not None:
                found.append((item_id, *best))
        return found


def whole_words(text: str, start: int, end: int) -> bool:
    """Whether the stretch neither starts nor ends inside a word."""
    return not (start and text[start - 1].isalnum()) and not (end < len(text) and text[end].isalnum())


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    error_rate: float = 0.08,
    least_piece: int = 12,
    block_chars: int = 4_000_000,
) -> DataFrame:
    """(doc_id, item_id, distance, start, end): items that a document holds within their error budget.

    One row per row of ``docs`` and item, with the best passage as [start, end) in the normalised text.
    Null and empty texts hold nothing; null and empty items are held by nothing; items too short for two
    pieces have no budget and must stand between words. Items with equal normalised texts each report.
    Repeated rows report as often as they occur; null ids stay null. Other columns are not read.

    The benchmark is taken in blocks of about ``block_chars`` characters; one block's items are a bounded
    broadcast, and every block is a scan of the documents. Repeated rows of the benchmark are one item.
    """
    blocks = _blocks(benchmark, item_col, item_text_col, block_chars)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t")).where("t IS NOT NULL")

    def block(items: list[tuple[int, str]]) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shared.value, error_rate, least_piece)
            for batch in batches:
                out = [
                    (doc_id, *match)
                    for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                    for match in matcher.matches(normalise(text))
                ]
                columns = list(zip(*out, strict=True)) or [()] * 5
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", "item_id", "distance", "start", "end"],
                )

        return picked.mapInArrow(run, SCHEMA)

    return reduce(DataFrame.unionByName, map(block, blocks))


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The items with their normalised texts in lists of about ``block_chars`` characters, at least one list."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where(
        "text IS NOT NULL"
    )
    items = items.distinct()  # a repeated row is one item
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_chars))
    for number in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).collect()
        yield sorted(((r.item_id, normalise(r.text)) for r in rows), key=lambda r: (r[0] is None, r))


def without_items(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    error_rate: float = 0.08,
    least_piece: int = 12,
    block_chars: int = 4_000_000,
) -> DataFrame:
    """The rows of ``docs`` whose text holds no item within its budget, all columns as they were.

    Rows are judged one by one, so nothing is shuffled. Rows with a null or empty text stay.
    """
    for items in _blocks(benchmark, item_col, item_text_col, block_chars):
        shared = docs.sparkSession.sparkContext.broadcast(items)
        docs = docs.where(_free_of(shared, error_rate, least_piece)(F.col(text_col)))
    return docs


def _free_of(shared, error_rate: float, least_piece: int):
    """A function from a text column to whether the text holds none of the broadcast items."""

    @F.pandas_udf("boolean")
    def free(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(shared.value, error_rate, least_piece)
        for part in parts:
            yield pd.Series([not matcher.matches(normalise(t)) for t in part], dtype=bool)

    return free
