"""Secrets in texts: fixed patterns, and a token-efficiency test for random strings.

A byte-pair vocabulary spells ordinary words with few tokens and random strings with many. A run of key
characters that takes about as many tokens as half its characters is therefore random, unless it is a known
kind of digest or identifier. The patterns give the base spans; the test adds spans, and never replaces one.
"""

from __future__ import annotations

import base64
import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")

_ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

#: Forms of digests and identifiers that are no secrets: hexadecimal digests of the usual lengths, UUIDs,
#: plain numbers, words joined by signs, and names in camel case.
_DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
_NUMBERS = re.compile(r"[0-9+/_=-]+")
_WORDS = re.compile(r"[+/_=-]*([A-Z]?[a-z]+|[A-Z]+)([+/_=-]+([A-Z]?[a-z]+|[A-Z]+|[0-9]{1,4}))*[+/_=-]*")
_CAMEL = re.compile(r"([A-Z]?[a-z]{2,}|[A-Z]{2,})([A-Z][a-z]+|[0-9]{1,4}(?![0-9]))*")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed; leftmost, non-overlapping within a kind."""
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def known_form(run: str) -> bool:
    """Whether a run is a digest, a UUID, a number, or made of words."""
    if len(run) in _DIGEST_LENGTHS and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", run):
        return True
    return any(p.fullmatch(run) for p in (_UUID, _NUMBERS, _WORDS, _CAMEL))


@lru_cache(maxsize=2)
def vocabulary(ranks_file: str, pattern: str):
    """The tiktoken encoding of a ranks file; nothing is trained."""
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def random_spans(text: str, encoding, most_chars_per_token: float, kinds_needed: int = 2) -> list[tuple[str, int, int]]:
    """Runs of 16 or more key characters, of two kinds of characters at least, with few characters per token."""
    out = []
    for m in _RUN.finditer(text):
        run = m[0]
        mixed = any(c.isdigit() for c in run) + any(c.islower() for c in run) + any(c.isupper() for c in run)
        if mixed < kinds_needed or known_form(run):
            continue
        if len(run) / len(encoding.encode_ordinary(run)) <= most_chars_per_token:
            out.append(("random", m.start(), m.end()))
    return out


def apart(spans: list[tuple[str, int, int]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """The spans that overlap none of ``base``; both come by start, and ``spans`` don't overlap each other."""
    if not base or not spans:
        return spans
    starts = [s for _, s, _ in base]
    ends = list(accumulate((e for *_, e in base), max))
    return [r for r in spans if not (n := bisect_left(starts, r[2])) or ends[n - 1] <= r[1]]


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def secrets(
    docs: DataFrame,
    ranks_file: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    most_chars_per_token: float = 2.2,
) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random) for every row.

    Counts and the digest are of the base spans; ``spans`` also has the random strings that no base span
    overlaps. A null text counts as empty and holds nothing. Repeated rows come back as often as they went
    in, null ids stay null, other columns are not read, an empty table gives an empty result. The ranks file
    is read on each executor.
    """
    names = ["n_assign", "n_access", "n_hex"]
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary(ranks_file, pattern)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text or "")
                more = apart(random_spans(text or "", encoding, most_chars_per_token), base)
                every = sorted(base + more, key=lambda s: (s[1], KINDS.index(s[0]))) if more else base
                counts = [sum(k == kind for k, _, _ in base) for kind in KINDS[:3]]
                rows.append((*counts, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every), len(more)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["doc_id", *names, "base_sha256", "spans", "n_random"],
            )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return picked.mapInArrow(run, schema)
