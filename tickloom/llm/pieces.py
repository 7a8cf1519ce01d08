"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

The encoder keeps an agenda of adjacent symbol pairs ordered by piece score, then by position, merges the
best pair, and enters the two pairs that the merge creates. The vocabulary comes from a model file; nothing
is trained. No merge can cross two neighbouring characters that no piece has side by side, so a text is cut
there (before each run of white-space marks, and between words and signs where the vocabulary allows it) into
units that are encoded apart. Units recur, so each Python worker keeps the encodings of those it met lately.
The agendas of all short units that are new in a batch are the rows of one matrix, and each round takes the best
pair of every row; a long unit has a heap of its own. What is new in an Arrow batch goes to the sentencepiece
library in one call, which must give the same ids: the new units, or with ``check="texts"`` all whole texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
_CACHE_UNITS = 100_000
_CACHE_CHARS = _MATRIX_CHARS = 40
_NO_PAIR = np.iinfo(np.int32).max


class BpePieces:
    """Encoder and decoder over the vocabulary of one model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        every = range(sp.get_piece_size())
        self.pieces = [sp.id_to_piece(i) for i in every]
        self.bytes_of = {i: int(self.pieces[i][3:5], 16) for i in every if sp.is_byte(i)}
        self.id_of_byte = {b: i for i, b in self.bytes_of.items()}
        self.silent = {i for i in every if sp.is_control(i)}
        self.unknown = sp.unk_id()
        special = self.silent | set(self.bytes_of) | {self.unknown}
        self.odd = special
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in special}
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("a piece goes on over white space; units can't be cut before it")
        best_first = sorted({sp.get_score(i) for i in self.ids.values()}, reverse=True)
        order = {score: n for n, score in enumerate(best_first)}
        self.rank = {p: order[sp.get_score(i)] for p, i in self.ids.items()}
        self.joined = {pair for p in self.ids for pair in map(str.__add__, p, p[1:])}
        bridges = "".join(sorted({a for a, b in self.joined if a != SPACE and a.isalnum() != b.isalnum()}))
        beyond = f"(?:(?<=[{re.escape(bridges)}])[^{SPACE}]+)?" if bridges else ""
        self.units_of = re.compile(rf"{SPACE}*(?:[^\W_]+|(?:[^\w{SPACE}]+|_+)+){beyond}|{SPACE}+").findall
        self._number_pairs()
        # ids by unit, joined by commas: of the batches since the last change, and of those before it
        self.recent: dict[str, str] = {}
        self.former: dict[str, str] = {}
        self.watched = False  # whether new units are kept for a comparison
        self.unchecked: list[tuple[str, str]] = []
        self.wrong: set[str] = set()  # units that the library encodes otherwise, for as long as the worker lives
        self.guards: dict[str, tuple[str, str] | None] = {}

    def _number_pairs(self) -> None:
        """Symbols as numbers (a piece's is its id) and the pairs of symbols that are pieces, as a sorted table."""
        symbols = dict(self.ids)
        for c in sorted({c for p in self.ids for c in p}):
            symbols.setdefault(c, len(self.pieces) + len(symbols))
        self.other = len(self.pieces) + len(symbols)  # any other character
        chars = [c for c in symbols if len(c) == 1]
        self.symbol_of = np.full(max(map(ord, chars), default=0) + 2, self.other, np.int64)
        self.symbol_of[[ord(c) for c in chars]] = [symbols[c] for c in chars]
        found = [
            (symbols[p[:i]] * (self.other + 1) + symbols[p[i:]], self.rank[p], n)
            for p, n in self.ids.items()
            for i in range(1, len(p))
            if p[:i] in symbols and p[i:] in symbols
        ]
        self.pair_keys, ranks, self.pair_ids = np.array(sorted(found) or [(-1, _NO_PAIR, 0)], np.int64).T.copy()
        self.pair_ranks = ranks.astype(np.int32)

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank or _NO_PAIR, id) of the piece that each pair of symbols makes."""
        key = a * (self.other + 1) + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NO_PAIR), self.pair_ids[at]

    def short_ids(self, units: list[str]) -> list[list[int]]:
        """Ids of short units, whose agendas are rows of a matrix by the position of the left symbol."""
        lengths = np.array(list(map(len, units)))
        top, every = int(lengths.max()), np.arange(len(units))
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        inside = np.arange(top + 1) < lengths[:, None]
        symbols = np.full(inside.shape, self.other)
        symbols[inside] = self.symbol_of[np.minimum(codes, len(self.symbol_of) - 1)]
        rank, makes = self._pair(symbols, np.roll(symbols, -1, 1))  # no piece has the empty last symbol
        after = np.tile(np.arange(1, top + 2), (len(units), 1))
        before = after - 2
        while True:
            i = rank.argmin(1)
            live = np.nonzero(np.take_along_axis(rank, i[:, None], 1)[:, 0] < _NO_PAIR)[0]
            if len(live) < len(every):
                every, i, rank = every[live], i[live], rank[live]
            if not len(every):
                break
            rows = np.arange(len(every))
            j = after[every, i]
            k = after[every, j]
            piece = makes[every, i]
            symbols[every, i], symbols[every, j] = piece, -1
            after[every, i], before[every, k] = k, i
            rank[rows, j] = _NO_PAIR
            rank[rows, i], makes[every, i] = self._pair(piece, symbols[every, k])
            h = before[every, i]
            has = h >= 0
            r, x, h = rows[has], every[has], h[has]
            rank[r, h], makes[x, h] = self._pair(symbols[x, h], piece[has])
        there = inside & (symbols >= 0)
        flat, ends = symbols[there], np.cumsum(there.sum(1)).tolist()
        ids = flat.tolist()
        out = [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        if (flat >= len(self.pieces)).any():  # characters that are no piece
            for n in np.nonzero((there & (symbols >= len(self.pieces))).any(1))[0].tolist():
                at = np.nonzero(there[n])[0].tolist()
                out[n] = [x for i, c in zip(out[n], at, strict=True) for x in ([i] if i < len(self.pieces) else self._no_piece(units[n][c]))]
        return out

    def _no_piece(self, char: str) -> list[int]:
        return [self.id_of_byte[b] for b in char.encode()] if self.id_of_byte else [self.unknown]

    def parts(self, unit: str) -> list[str]:
        """The unit cut between characters that no piece has side by side."""
        joined = self.joined
        cuts = [i for i, pair in enumerate(map(str.__add__, unit, unit[1:]), 1) if pair not in joined]
        return [unit[i:j] for i, j in zip([0, *cuts], [*cuts, len(unit)], strict=True)]

    def unit_ids(self, unit: str) -> list[int]:
        """Ids of one unit: merge the adjacent pair with the best score, leftmost first, until none is left.

        An agenda entry is rank * n + position of the left symbol; it is stale when the pair that now
        starts there has another rank.
        """
        rank, n = self.rank.get, len(unit)
        symbols: list[str | None] = list(unit)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [r * n + i for i, p in enumerate(map(str.__add__, unit, unit[1:])) if (r := rank(p)) is not None]
        heapify(agenda)
        while agenda:
            r, i = divmod(heappop(agenda), n)
            left = symbols[i]
            if left is None or (j := after[i]) == n:
                continue
            piece = left + symbols[j]
            if rank(piece) != r:
                continue
            symbols[i], symbols[j] = piece, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := rank(piece + symbols[k])) is not None:
                    heappush(agenda, r * n + i)
            h = before[i]
            if h >= 0 and (r := rank(symbols[h] + piece)) is not None:
                heappush(agenda, r * n + h)
        out: list[int] = []
        for s in symbols:
            if s is None:
                continue
            if (found := self.ids.get(s)) is not None:
                out.append(found)
            else:
                out += self._no_piece(s)
        return out

    def piece_text(self, ids: list[int]) -> str:
        """Text of ids with white-space marks as spaces; runs of byte pieces are read as UTF-8."""
        if self.odd.isdisjoint(ids):
            return "".join(map(self.pieces.__getitem__, ids)).replace(SPACE, " ")
        out: list[str] = []
        run = bytearray()
        for i in ids:
            if i in self.bytes_of:
                run.append(self.bytes_of[i])
                continue
            if run:
                out.append(run.decode(errors="replace"))
                run.clear()
            if i not in self.silent:
                out.append(" ⁇ " if i == self.unknown else self.pieces[i].replace(SPACE, " "))
        if run:
            out.append(run.decode(errors="replace"))
        return "".join(out)

    def units(self, text: str) -> list[str]:
        """The text with its leading space, cut where no merge can cross."""
        return self.units_of(SPACE + text.replace(" ", SPACE)) if text else []

    def _of_units(self, units: set[str]) -> tuple[dict[str, str], dict[str, str]]:
        """(unit to ids, unit to the text that these decode to, if it is another)."""
        found = {u: ids for u in units if (ids := self.recent.get(u) or self.former.get(u))}
        odd: dict[str, str] = {}
        new = sorted(units - found.keys(), key=len)
        short = [u for u in new if len(u) <= _MATRIX_CHARS]
        coded = [ids for a in range(0, len(short), 4096) for ids in self.short_ids(short[a : a + 4096])]
        coded += [[i for part in self.parts(u) for i in self.unit_ids(part)] for u in new[len(short) :]]
        for unit, ids in zip(new, coded, strict=True):
            found[unit] = ",".join(map(str, ids))
            if (text := self.piece_text(ids)) != unit.replace(SPACE, " "):
                odd[unit] = text
        if self.watched:
            self.unchecked += [(u, found[u]) for u in new]
        if len(self.recent) > _CACHE_UNITS:
            self.recent, self.former = {}, self.recent
        self.recent |= {u: ids for u, ids in found.items() if len(u) <= _CACHE_CHARS and u not in odd}
        return found, odd

    def encoded(self, texts: list[str]) -> list[tuple[str, str]]:
        """(ids joined by commas, what they decode to) of whole texts, without begin and end ids.

        The ids of every unit are decoded when they are found; where each gives the unit back, the text is whole.
        """
        out, cut_up = [], list(map(self.units, texts))
        known, odd = self._of_units(set().union(*cut_up))
        for units in cut_up:
            decoded = "".join([odd.get(u, u) for u in units] if odd else units).replace(SPACE, " ")
            out.append((",".join(map(known.__getitem__, units)), decoded.removeprefix(" ")))
        return out

    def guard(self, first: str) -> tuple[str, str] | None:
        """A character that no piece has before ``first``, and its ids behind a mark; None if there is none."""
        if first not in self.guards:
            free = (c for c in self.ids if len(c) == 1 and c != SPACE and c + first not in self.joined and SPACE + c not in self.ids)
            found = next(free, None)
            self.guards[first] = found and (found, "".join(f"{i}," for i in self.library.encode(found)))
        return self.guards[first]

    def refused(self) -> set[str]:
        """All units met so far that the library encodes otherwise; those that are new since the last call are compared.

        The library puts a mark before a text, so a unit that has none, and a mark alone, is compared behind a guard, a
        character that can't merge with it. A unit without guard counts as refused: its texts are compared whole.
        """
        texts, wanted, units = [], [], []
        for unit, ids in self.unchecked:
            bare = unit == SPACE or unit[0] != SPACE
            guard = self.guard(unit[0]) if bare else ("", "")
            if guard is None:
                self.wrong.add(unit)
                continue
            texts.append(guard[0] + (unit if bare else unit.removeprefix(SPACE)).replace(SPACE, " "))
            wanted.append(guard[1] + ids)
            units.append(unit)
        self.unchecked = []
        theirs = self.library.encode(texts, num_threads=1)
        self.wrong |= {u for u, ids, other in zip(units, wanted, theirs, strict=True) if ",".join(map(str, other)) != ids}
        return self.wrong

    def agree(self, texts: list[str], ids: list[str]) -> list[bool]:
        """Whether the library encodes each text alike: by its units, or whole if one of them is refused."""
        refused = self.refused()
        doubtful = [n for n, t in enumerate(texts) if refused and not refused.isdisjoint(self.units(t))]
        whole = self.library.encode([texts[n] for n in doubtful], num_threads=1)
        out = [True] * len(texts)
        for n, other in zip(doubtful, whole, strict=True):
            out[n] = ",".join(map(str, other)) == ids[n]
        return out

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, without begin and end ids."""
        return [int(i) for i in self.encoded([text])[0][0].split(",") if i]

    def decode(self, ids: list[int]) -> str:
        """Text of ids; the space that encoding puts before a text goes."""
        return self.piece_text(ids).removeprefix(" ")


@lru_cache(maxsize=2)
def load(model_file: str) -> BpePieces:
    return BpePieces(model_file)


def encode_decode(
    docs: DataFrame,
    model_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    check: str = "units",
    with_ids: bool = False,
) -> DataFrame:
    """Encode every whole text, decode its ids, and return counts and digests of both.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256, round_trip (the decoded text is the text) and
    library_agrees, with ``ids`` as an array if ``with_ids``. With ``check="texts"`` the library has encoded every
    whole text and given the same ids or not; with ``"units"`` it has done so for each unit when the worker met it first
    (or again, after it was forgotten), and for whole texts that hold a unit it encodes otherwise; with ``""`` the
    column is null. A null text counts as empty: no ids, both digests of the empty string. Row order, ties
    and repeated rows don't matter; ids may be null; other columns are not read. The model file is read on each
    executor, so its path must be one that executors have.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean, library_agrees boolean"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model_file)
        pieces.watched = check == "units"
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                rows = []
                for text, (ids, decoded) in zip(texts, pieces.encoded(texts), strict=True):
                    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (ids, decoded)]
                    row = [ids.count(",") + 1 if ids else 0, *sha, decoded == text, ids]
                    rows.append([*row, list(map(int, ids.split(","))) if ids else []] if with_ids else row)
                if check == "texts":
                    agrees = [",".join(map(str, x)) == row[4] for x, row in zip(pieces.library.encode(texts, num_threads=1), rows, strict=True)]
                elif check == "units":
                    agrees = pieces.agree(texts, [row[4] for row in rows])
                else:
                    agrees = [None] * len(rows)
                for row, same in zip(rows, agrees, strict=True):
                    row[4] = same
                kinds = [pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.bool_()] + [pa.list_(pa.int32())] * with_ids
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *columns],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip", "library_agrees"] + ["ids"] * with_ids,
                )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return picked.mapInArrow(run, schema)
