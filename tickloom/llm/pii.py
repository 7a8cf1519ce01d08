"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes.

The patterns give the base spans. The field reads the words around every digit and '@' and marks further
spans whose shapes look like those of its training table: a bounded table of word chains that is labelled
by the base spans of a sample of the documents, with some spans rewritten (no country code, other
separators, spaces around '@') so that their shapes are learnt beyond the patterns. Marked spans must also
hold what their kind needs (digits, a check sum, an '@') and never replace or overlap a base span.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: O, then B- and I- of each kind.
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
# A match can only begin where a run of digits begins, as the runs are taken whole.
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_SET:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            done = match.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; leftmost, non-overlapping within a kind."""
    out = [("email", s, e) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.groups()):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0]) if m.end() - m.start() >= 16 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


# ---- word chains ------------------------------------------------------------------------------------

_MARKED = re.compile(r"[0-9@]\S*")
_WORD = re.compile(r"\S+")
_REACH, _CONTEXT = 96, 2


def _words_before(text: str, at: int) -> list[re.Match]:
    """The word that reaches ``at``, cut behind it, and the two whole words before it."""
    reach = _REACH
    while True:
        low = max(0, at - reach)
        words = list(_WORD.finditer(text, low, at + 1))
        spare = len(words) - 1 - _CONTEXT
        if low == 0 or spare > 0 or (spare == 0 and (words[0].start() > low or text[low - 1].isspace())):
            return words[-1 - _CONTEXT :]
        reach *= 4


def chains(text: str) -> list[list[tuple[str, int]]]:
    """Lists of (word, start): the words with a digit or '@', with two words around; near ones in one chain.

    Words are whole, however long. A word is looked at by the few chains next to it, so the cost is that of the text.
    """
    windows: list[list[int]] = []
    for m in _MARKED.finditer(text):
        start = _words_before(text, m.start())[0].start()
        end = m.end()
        for after in islice(_WORD.finditer(text, m.end()), _CONTEXT):
            end = after.end()
        if windows and start <= windows[-1][1]:
            windows[-1][1] = max(end, windows[-1][1])
        else:
            windows.append([start, end])
    return [[(m[0], m.start()) for m in _WORD.finditer(text, a, b)] for a, b in windows]


def _shape(word: str) -> str:
    """Runs of letters as a or A, digits as 9 with the run's length up to 6, other signs as they are."""
    out, i = [], 0
    while i < len(word):
        c = word[i]
        kind = "9" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        j = i + 1
        while j < len(word) and (kind == ("9" if word[j].isdigit() else "A" if word[j].isupper() else "a" if word[j].isalpha() else word[j])):
            j += 1
        out.append(kind + (str(min(j - i, 6)) if kind == "9" else ""))
        i = j
    return "".join(out)


def word_features(word: str) -> list[str]:
    whole = _shape(word)
    core = whole.strip(",;:!?#$%&*|\"'")
    digits = sum(c.isdigit() for c in word)
    return [
        f"w{whole}",
        f"c{core}",
        f"d{min(digits, 8)}",
        f"@{'@' in word}",
        f".{min(word.count('.'), 4)}",
        f"+{word[:1] in '+('}",
        "letters" if core.strip("Aa") == "" else "mixed" if digits and any(c.isalpha() for c in word) else "signs",
    ]


@dataclass
class Crf:
    """Weights: per feature and offset (word before, word, word after) and label; and between labels."""

    index: dict[str, int]
    emit: np.ndarray  # (3, features, labels)
    move: np.ndarray  # (labels, labels)

    def __post_init__(self) -> None:
        self._rows: dict[str, np.ndarray] = {}

    def row(self, word: str) -> np.ndarray:
        """(3, labels): what a word adds to the scores of the word after it, of itself and of the one before."""
        if (found := self._rows.get(word)) is None:
            ids = [self.index[f] for f in word_features(word) if f in self.index]
            found = self.emit[:, ids].sum(1)
            if len(self._rows) > 20_000:
                self._rows.clear()
            if len(word) <= 64:
                self._rows[word] = found
        return found

    def scores(self, words: list[str]) -> np.ndarray:
        own = np.stack([self.row(w) for w in words])
        out = own[:, 1].copy()
        out[1:] += own[:-1, 0]
        out[:-1] += own[1:, 2]
        return out

    def decode(self, many: list[list[str]], batch: int = 256, cells: int = 100_000) -> list[np.ndarray]:
        """Best label numbers of each chain, by Viterbi over padded batches of chains of similar length.

        A batch has at most ``cells`` words with its padding, or is one chain.
        """
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(many)
        order = sorted(range(len(many)), key=lambda i: len(many[i]))
        begin = 0
        while begin < len(order):
            size = batch
            while size > 1 and size * len(many[order[min(begin + size, len(order)) - 1]]) > cells:
                size //= 2
            chosen = order[begin : begin + size]
            begin += size
            lengths = np.array([len(many[i]) for i in chosen])
            top = lengths.max()
            e = np.zeros((len(chosen), top, len(LABELS)))
            for n, i in enumerate(chosen):
                e[n, : lengths[n]] = self.scores(many[i])
            best = e[:, 0]
            back = np.zeros((top, len(chosen), len(LABELS)), np.int8)
            stay = np.arange(len(LABELS))
            for t in range(1, top):
                step = best[:, :, None] + self.move
                arg = step.argmax(1)
                going = (t < lengths)[:, None]
                back[t] = np.where(going, arg, stay)
                best = np.where(going, np.take_along_axis(step, arg[:, None], 1)[:, 0] + e[:, t], best)
            path = np.empty((len(chosen), top), np.int64)
            path[:, -1] = best.argmax(1)
            for t in range(top - 1, 0, -1):
                path[:, t - 1] = back[t][np.arange(len(chosen)), path[:, t]]
            for n, i in enumerate(chosen):
                out[i] = path[n, : lengths[n]]
        return out


def marginals(e: np.ndarray, move: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log partition sums, label probabilities, expected moves of all chains) of (chains, words, labels) scores.

    Forward and backward sums run over all chains at once; ``inside`` tells words from padding.
    """
    top = e.shape[1]
    a, z = np.zeros_like(e), np.zeros_like(e)
    peak = move.max()
    expm = np.exp(move - peak)

    def through(x: np.ndarray, m: np.ndarray) -> np.ndarray:
        high = x.max(1, keepdims=True)
        return np.log(np.exp(x - high) @ m + 1e-300) + high + peak

    a[:, 0] = e[:, 0]
    for t in range(1, top):
        a[:, t] = np.where(inside[:, t, None], through(a[:, t - 1], expm) + e[:, t], a[:, t - 1])
    for t in range(top - 2, -1, -1):
        z[:, t] = np.where(inside[:, t + 1, None], through(z[:, t + 1] + e[:, t + 1], expm.T), 0)
    whole = a[:, -1]
    log_z = np.log(np.exp(whole - whole.max(1, keepdims=True)).sum(1)) + whole.max(1)
    node = np.exp(a + z - log_z[:, None, None]) * inside[:, :, None]
    pairs = np.zeros_like(move)
    for t in range(1, top):
        pair = a[:, t - 1, :, None] + move + (e[:, t] + z[:, t])[:, None, :] - log_z[:, None, None]
        pairs += (np.exp(pair) * inside[:, t, None, None]).sum(0)
    return log_z, node, pairs


def fit_crf(words: list[list[str]], labels: list[list[int]], steps: int = 120, rate: float = 0.15, decay: float = 1e-3) -> Crf:
    """Maximum likelihood by Adam."""
    counts: dict[str, int] = {}
    for chain in words:
        for w in chain:
            for f in word_features(w):
                counts[f] = counts.get(f, 0) + 1
    index = {f: i for i, f in enumerate(sorted(f for f, c in counts.items() if c >= 2))}
    n_f, n_l = len(index), len(LABELS)
    emit, move = np.zeros((3, n_f, n_l)), np.zeros((n_l, n_l))
    if not words:
        emit = np.zeros((3, 0, n_l))
        move[:, 1:] = -5.0
        return Crf({}, emit, move)
    top = max(map(len, words))
    lengths = np.array(list(map(len, words)))
    inside = np.arange(top) < lengths[:, None]
    gold = np.zeros((len(words), top), np.int64)
    spots: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    rows, cols, ids = [], [], []
    for n, (chain, marks) in enumerate(zip(words, labels, strict=True)):
        gold[n, : len(chain)] = marks
        for t, w in enumerate(chain):
            found = [index[f] for f in word_features(w) if f in index]
            ids += found
            rows += [n] * len(found)
            cols += [t] * len(found)
    rows, cols, ids = (np.array(x, np.int64) for x in (rows, cols, ids))
    for shift in (1, 0, -1):  # a word speaks for the word after it, itself, and the word before
        fits = (cols + shift >= 0) & (cols + shift < lengths[rows])
        spots.append((rows[fits] * top + cols[fits] + shift, ids[fits]))
    one_hot = np.eye(n_l)[gold] * inside[:, :, None]
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (emit, move)]
    for step in range(1, steps + 1):
        e = np.zeros((len(words) * top, n_l))
        for o, (where, which) in enumerate(spots):
            np.add.at(e, where, emit[o, which])
        e = e.reshape(len(words), top, n_l)
        _, node, pairs = marginals(e, move, inside)
        g_move = pairs - sum(one_hot[:, t - 1].T @ one_hot[:, t] for t in range(1, top))
        apart = (node - one_hot).reshape(-1, n_l)
        g_emit = np.zeros_like(emit)
        for o, (where, which) in enumerate(spots):
            np.add.at(g_emit[o], which, apart[where])
        for x, g, (m, v) in zip((emit, move), (g_emit, g_move), moments, strict=True):
            g = g / len(words) + decay * x
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x -= rate * (1 - step / (steps + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Crf(index, emit, move)


# ---- labelled table -----------------------------------------------------------------------------------


class Near:
    """Looks up the spans of a text by place; spans of one kind don't overlap each other."""

    def __init__(self, spans: list[tuple[str, int, int]]) -> None:
        self.kinds = [(k, [(s, e) for kind, s, e in spans if kind == k]) for k in KINDS]

    def spans(self, start: int, end: int) -> list[tuple[str, int, int]]:
        """Those that overlap a stretch, by kind as listed, then start."""
        out = []
        for kind, placed in self.kinds:
            n = bisect_right(placed, start, key=lambda p: p[1])
            while n < len(placed) and placed[n][0] < end:
                out.append((kind, *placed[n]))
                n += 1
        return out


def _labels(chain: list[tuple[str, int]], spans: list[tuple[str, int, int]]) -> list[int]:
    out = [0] * len(chain)
    for kind, start, end in spans:
        first = True
        for n, (word, at) in enumerate(chain):
            if at < end and at + len(word) > start and out[n] == 0:
                out[n] = LABELS.index(("B-" if first else "I-") + kind)
                first = False
    return out


def rewritten(words: list[str], labels: list[int]) -> Iterator[tuple[list[str], list[int]]]:
    """The labelled chain, and forms of it whose spans the patterns would miss."""
    yield words, labels
    b_phone, i_phone = LABELS.index("B-phone"), LABELS.index("I-phone")
    b_email, i_email = LABELS.index("B-email"), LABELS.index("I-email")
    b_card, i_card = LABELS.index("B-card"), LABELS.index("I-card")
    for n, (word, label) in enumerate(zip(words, labels, strict=True)):
        if label == b_phone and n + 1 < len(words) and labels[n + 1] == i_phone:
            yield words[:n] + words[n + 1 :], labels[:n] + [b_phone] + labels[n + 2 :]
        if label == b_email and word.count("@") == 1:
            name, host = word.split("@")
            if name and host:
                yield words[:n] + [name, "@", host] + words[n + 1 :], labels[:n] + [b_email, i_email, i_email] + labels[n + 1 :]
        if label == b_card and (digits := _NOT_DIGIT.sub("", word)) and len(digits) == 16:
            four = [digits[i : i + 4] for i in range(0, 16, 4)]
            yield words[:n] + [".".join(four)] + words[n + 1 :], labels
            yield words[:n] + four + words[n + 1 :], labels[:n] + [b_card] + [i_card] * 3 + labels[n + 1 :]


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = 6000, max_chains: int = 3000
) -> Crf:
    """Label the chains of about ``max_docs`` documents, chosen by a hash of their id, and fit on ``max_chains``.

    The sample is of chains of up to 40 words, those with a label and the first two of a text without one; this
    bounds the labelled table only, ``find`` decodes every chain of every text.
    """
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t")).where("doc_id IS NOT NULL AND t IS NOT NULL")
    share = max_docs / max(1, picked.count())
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                near = Near(base_spans(text))
                for n, chain in enumerate(chains(text)):
                    if len(chain) > 40:
                        continue
                    marks = _labels(chain, near.spans(chain[0][1], chain[-1][1] + len(chain[-1][0])))
                    if any(marks) or n < 2:
                        rows.append((" ".join(w for w, _ in chain), marks))
            texts, marks = zip(*rows, strict=True) if rows else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), pa.array(marks, pa.list_(pa.int32()))], ["words", "labels"]
            )

    table = picked.where(draw < share).select("t").mapInArrow(run, "words string, labels array<int>").distinct()
    rows = table.orderBy(F.exists("labels", lambda x: x > 0).desc(), F.xxhash64("words"), "words").limit(max_chains).collect()
    pairs = [pair for r in rows for pair in rewritten(r.words.split(), list(r.labels))]
    pairs = [p for p in pairs if len(p[0]) == len(p[1])]
    return fit_crf([p[0] for p in pairs], [p[1] for p in pairs])


# ---- finding ------------------------------------------------------------------------------------------


def _fits(kind: str, piece: str) -> bool:
    digits = _NOT_DIGIT.sub("", piece)
    if kind == "email":
        return bool(re.fullmatch(r"\S+\s?@\s?\S+\.\S+", piece))
    if kind == "ip":
        parts = re.findall(r"[0-9]+", piece)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts)
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and not re.search(r"[A-Za-z]", piece)


def added_spans(texts: list[str], base: list[list[tuple[str, int, int]]], crf: Crf) -> list[list[tuple[str, int, int]]]:
    """Spans that the field marks in each text beyond its base spans."""
    found = [chains(t) for t in texts]
    flat = [(n, chain) for n, some in enumerate(found) for chain in some]
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    near = [Near(b) for b in base]
    for (n, chain), path in zip(flat, crf.decode([[w for w, _ in c] for _, c in flat]), strict=True):
        t = 0
        while t < len(chain):
            label = int(path[t])
            if label % 2 == 0:
                t += 1
                continue
            end = t + 1
            while end < len(chain) and path[end] == label + 1:
                end += 1
            start_at, end_at = chain[t][1], chain[end - 1][1] + len(chain[end - 1][0])
            text = texts[n]
            while start_at < end_at and not (text[start_at].isalnum() or text[start_at] in "+("):
                start_at += 1
            while end_at > start_at and not text[end_at - 1].isalnum():
                end_at -= 1
            kind = KINDS[(label - 1) // 2]
            if _fits(kind, text[start_at:end_at]) and not near[n].spans(start_at, end_at):
                out[n].append((kind, start_at, end_at))
            t = end
    return out


def find(texts: list[str], crf: Crf) -> list[tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]]:
    """(base spans, all spans) of each text, both by kind as listed, then start."""
    base = [base_spans(t) for t in texts]
    added = added_spans(texts, base, crf)
    rank = {k: i for i, k in enumerate(KINDS)}
    return [(b, sorted(b + a, key=lambda s: (rank[s[0]], s[1])) if a else b) for b, a in zip(base, added, strict=True)]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", crf: Crf | None = None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for every row.

    Counts and the digest are of the base spans, ``spans`` has all of them as kind:start:end in code points.
    A null text counts as empty and holds nothing; a very long one is read whole, at a cost that grows with its length.
    Repeated rows come back as often as they went in, null
    ids stay null, other columns are not read, an empty table gives an empty result. ``crf`` is trained on
    ``docs`` if it is not given; it is bounded by its training sample and broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(crf or train(docs, id_col, text_col))
    names = [f"n_{k}" for k in KINDS]
    schema = "doc_id long, " + ", ".join(f"{n} long" for n in names) + ", base_sha256 string, spans string, n_added long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                found = find([t or "" for t in batch.column(1).to_pylist()], shared.value)
                columns = [pa.array([sum(s[0] == k for s in b) for b, _ in found], pa.int64()) for k in KINDS]
                columns.append(pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b, _ in found]))
                columns.append(pa.array([joined(every) for _, every in found]))
                columns.append(pa.array([len(every) - len(b) for b, every in found], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *columns], ["doc_id", *names, "base_sha256", "spans", "n_added"]
                )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return picked.mapInArrow(run, schema)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; overlapping spans become one."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def mask_column(spark, crf: Crf):
    """A function from a text column to the text with personal data masked; null stays null."""
    shared = spark.sparkContext.broadcast(crf)

    @F.pandas_udf("string")
    def mask(texts: pd.Series) -> pd.Series:
        given = [t if isinstance(t, str) else "" for t in texts]
        new = [masked(t, every) for t, (_, every) in zip(given, find(given, shared.value), strict=True)]
        return pd.Series([n if isinstance(t, str) else None for n, t in zip(new, texts, strict=True)], dtype=object)

    return mask
