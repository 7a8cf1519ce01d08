"""Repeated passages by suffix automata over shards of the corpus.

A window of 50 words that starts in a document with a smaller id too is a repeat, and its words go. Corpus and
reference are the same and have no size bound, so the reference is cut into shards by content, and each
document's text streams only against the shards that could hold its windows:

* Every window has an anchor, the ten-word stretch in it with the smallest hash. Equal windows have equal
  anchors. Neighbouring windows mostly share theirs and form one segment, about one for 21 words.
* Segments are grouped by anchor, and equal segments are one from the start: the first document's stands for
  all. Anchors of one document only are dropped; nothing there repeats.
* The remaining segments are dealt by anchor to tasks, which build a generalised suffix automaton for each
  shard of a bounded number of words, with the smallest document id of every state. All segments stream
  through it; where the matching statistic reaches the window length, the state of that length gives the
  smallest id that holds the window.
* An anchor whose segments exceed a shard (a phrase of everyday words) is lengthened: each of its windows goes
  with the longer stretch that it holds to the left of the anchor or, failing that, to the right. Equal windows
  stay together. The pieces are grouped by the longer anchors and go through automata in turn, lengthened again
  where they must be; an anchor as long as the window has one piece only.

A shard's automaton is not sent to every executor, as a broadcast would: all shards together grow with the
corpus, so each is built in the task that streams through it.

Words are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import cut, drop_cut

GRAM = 10
LOWS = "array<struct<i:int,lowest:bigint>>"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


class _WordIds(dict):
    """Word to 64-bit number, kept while a worker runs."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) > 400_000:
            self.clear()
        if len(word) < 48:
            self[word] = found
        return found


def word_ids(words: list[bytes], known: _WordIds) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def gram_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """A hash of every stretch of ``length`` ids, by doubling."""
    if len(ids) < length:
        return np.empty(0, np.uint64)
    out: np.ndarray | None = None
    power, scale, covered, span = ids, np.full(1, _BASE), 0, 1  # arrays wrap around silently
    while True:
        if length & span:
            n = len(ids) - covered - span + 1
            out = power[:n].copy() if out is None else out[:n] * scale + power[covered : covered + n]
            covered += span
        if covered == length:
            return _mix(out)
        power = power[:-span] * scale + power[span:]
        scale, span = scale * scale, span * 2


def _powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


def segments(ids: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, content hash, first window, windows) of the runs of windows with one anchor."""
    grams = gram_hashes(ids, GRAM)
    reach = window - GRAM + 1
    if len(grams) < reach:
        return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
    anchor = np.lib.stride_tricks.sliding_window_view(grams, reach).argmin(1)
    anchor = anchor + np.arange(len(anchor))
    first = np.concatenate([[0], np.nonzero(np.diff(anchor))[0] + 1])
    count = np.diff(np.append(first, len(anchor)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mix(ids) * _powers(len(ids), _BASE), dtype=np.uint64)])
    end = first + count + window - 1
    content = (sums[end] - sums[first]) * _powers(len(ids), _BASE_INVERSE)[first]
    return grams[anchor[first]], _mix(content + count.astype(np.uint64)), first, count


class SuffixAutomaton:
    """Generalised suffix automaton of sequences; each state knows the smallest owner of its occurrences."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.owner = [-1], [0], [1 << 63]

    def add(self, sequence: list[int], owner: int) -> None:
        step, link, length, owners = self.next, self.link, self.length, self.owner
        last = 0
        for x in sequence:
            q = step[last].get(x)
            if q is not None and length[q] == length[last] + 1:
                last = q
            else:
                if q is None:
                    current = len(step)
                    step.append({})
                    length.append(length[last] + 1)
                    owners.append(1 << 63)
                    link.append(0)
                    p = last
                    while p >= 0 and x not in step[p]:
                        step[p][x] = current
                        p = link[p]
                    last = current
                    if p < 0:
                        if owner < owners[last]:
                            owners[last] = owner
                        continue
                    q = step[p][x]
                    if length[p] + 1 == length[q]:
                        link[current] = q
                        if owner < owners[last]:
                            owners[last] = owner
                        continue
                else:
                    current, p = -1, last
                clone = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                owners.append(1 << 63)
                link.append(link[q])
                while p >= 0 and step[p].get(x) == q:
                    step[p][x] = clone
                    p = link[p]
                link[q] = clone
                if current >= 0:
                    link[current] = clone
                else:
                    last = clone
            if owner < owners[last]:
                owners[last] = owner

    def settle(self) -> None:
        """Hand smallest owners down to the states of shorter suffixes."""
        for s in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            if self.owner[s] < self.owner[self.link[s]]:
                self.owner[self.link[s]] = self.owner[s]

    def smallest_owners(self, sequence: list[int], window: int) -> list[int]:
        """For each window of the sequence the smallest owner of its occurrences (1 << 63 if there is none)."""
        step, link, length = self.next, self.link, self.length
        state, matched, out = 0, 0, []
        for n, x in enumerate(sequence, 1):
            while state and x not in step[state]:
                state = link[state]
                matched = length[state]
            if x in step[state]:
                state = step[state][x]
                matched += 1
            while length[link[state]] >= window:
                state = link[state]
                matched = length[state]
            if n >= window:
                out.append(self.owner[state] if matched >= window else 1 << 63)
        return out


def _split(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text_key, t): the text in UTF-8, and a number for it, as ids may repeat."""
    t = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(t).alias("text_key"), t.alias("t"))


def _segment_rows(docs: DataFrame, window: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordIds()
        for batch in batches:
            out, owner = [], []
            for n, t in enumerate(batch.column(2)):
                found = segments(word_ids(t.as_py().split(), known), window)
                if len(found[0]):
                    out.append(found)
                    owner.append(np.full(len(found[0]), n))
            if not out:
                continue
            rows = pa.array(np.concatenate(owner))
            anchor, content, first, count = (np.concatenate(c) for c in zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor.view(np.int64)),
                    pa.array(content.view(np.int64)),
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(first, pa.int32()),
                    pa.array(count, pa.int32()),
                ],
                ["anchor", "content", "doc_id", "text_key", "first", "n"],
            )

    schema = "anchor long, content long, doc_id long, text_key long, first int, n int"
    return docs.where("doc_id IS NOT NULL").mapInArrow(run, schema)


def _packed(docs: DataFrame) -> DataFrame:
    """The texts compressed, to move them in a third of the bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = pa.array([packer.compress(t.as_py()) for t in batch.column(2)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], packed], ["doc_id", "text_key", "z"])

    return docs.mapInArrow(run, "doc_id long, text_key long, z binary")


def _contents(window: int):
    """Words of the segments that a document stands for, and where the anchors to be lengthened begin in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, unpacker = _WordIds(), zstandard.ZstdDecompressor()
        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                out = []
                for doc_id, z, wanted in zip(*(c.to_pylist() for c in whole.slice(start, 64).columns), strict=True):
                    ids = word_ids(unpacker.decompress(z).split(), known)
                    grams = None
                    for s in wanted:
                        a, n, at = s["first"], s["n"], 0
                        if s["busy"]:
                            grams = gram_hashes(ids, GRAM).view(np.int64) if grams is None else grams
                            at = int((grams[a : a + window - GRAM + 1] == s["anchor"]).argmax())
                        values = ids[a : a + n + window - 1].view(np.int64)
                        out.append((s["anchor"], s["content"], doc_id, s["high"], at, n, values, s["busy"]))
                columns = list(zip(*out, strict=True)) or [()] * 8
                kinds = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.list_(pa.int64()), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["anchor", "content", "low", "high", "at", "n", "values", "busy"],
                )

    return run


def _number(words: np.ndarray, salt: int = 0) -> int:
    """A signed 64-bit hash of words."""
    found = xxhash.xxh64_intdigest(words.tobytes(), salt)
    return found - (1 << 64) if found >> 63 else found


def _longer(window: int, length: int):
    """Segments about an anchor of ``length`` words in at most two pieces, each about a longer anchor."""
    more = (window - length + 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(6).values.to_numpy(zero_copy_only=False)
            offsets = batch.column(6).offsets.to_pylist()
            out = []
            for r, (anchor, content, low, high, at, n) in enumerate(zip(*(c.to_pylist() for c in batch.columns[:6]), strict=True)):
                values = flat[offsets[r] : offsets[r + 1]]
                turn = min(n, max(0, at - more + 1))  # windows before it hold the words to the left
                for a, b, begin in ((0, turn, at - more), (turn, n, at)):
                    if a < b:
                        words = values[a : b + window - 1]
                        stretch = _number(values[begin : begin + length + more])
                        place = begin - a
                        out.append((anchor, content, a, stretch, _number(words, place + 1), low, high, place, b - a, words))
            columns = list(zip(*out, strict=True)) or [()] * 10
            kinds = [pa.int64()] * 2 + [pa.int32()] + [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["whole", "whole_content", "from", "anchor", "content", "low", "high", "at", "n", "values"],
            )

    return run


def _stream(window: int, shard_words: int):
    """Rows come sorted by anchor; whole anchors are gathered to shards of about ``shard_words`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: list[tuple[int, int, int, list[int]]] = []
        words, last = 0, None

        def flush() -> pa.RecordBatch:
            automaton = SuffixAutomaton()
            for _, _, low, sequence in shard:
                automaton.add(sequence, low)
            automaton.settle()
            lows = [automaton.smallest_owners(sequence, window) for *_, sequence in shard]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([s[0] for s in shard], pa.int64()),
                    pa.array([s[1] for s in shard], pa.int64()),
                    pa.array([s[2] for s in shard], pa.int64()),
                    pa.array(lows, pa.list_(pa.int64())),
                ],
                ["anchor", "content", "low", "lows"],
            )

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if words >= shard_words and row[0] != last:
                    yield flush()
                    shard, words = [], 0
                shard.append(row)
                words += len(row[3])
                last = row[0]
        if shard:
            yield flush()

    return run


def _kept(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        bits = np.arange(64, dtype=np.uint64)
        for whole in batches:
            for start in range(0, whole.num_rows, 256):
                batch = whole.slice(start, 256)
                rows = []
                for z, marks in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                    words = unpacker.decompress(z.as_py()).split()
                    n = len(words)
                    if marks:
                        turns = np.zeros(n + 1, np.int64)
                        for mark in marks:
                            at = mark["first"] + np.nonzero(np.uint64(mark["mask"]) >> bits & np.uint64(1))[0]
                            np.add.at(turns, at, 1)
                            np.add.at(turns, at + window, -1)
                        keep = np.cumsum(turns[:n]) == 0
                        words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
                    rows.append((n, n - len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
                columns = list(zip(*rows, strict=True)) or [()] * 3
                kinds = [pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                    ["doc_id", "n_words", "n_removed", "kept_sha256"],
                )

    return run


def _settled(contents: DataFrame, length: int, window: int, shard_words: int) -> DataFrame:
    """(anchor, content, low, lows) of segments whose anchors, of ``length`` words, have several each.

    ``lows`` has the smallest document of every window. ``contents`` is a written table; its column busy marks
    the anchors to be lengthened.
    """
    dealt = contents.where("NOT busy").select("anchor", "content", "low", "values").repartition("anchor")
    streamed = dealt.sortWithinPartitions("anchor", "content").mapInArrow(
        _stream(window, shard_words), "anchor long, content long, low long, lows array<long>"
    )
    streamed = streamed.withColumn("lows", F.transform("lows", lambda low, i: F.struct(i.alias("i"), low.alias("lowest"))))
    busy = contents.where("busy").drop("busy")
    if busy.isEmpty():
        return streamed
    pieces = cut(
        busy.mapInArrow(
            _longer(window, length),
            "whole long, whole_content long, from int, anchor long, content long, low long, high long, "
            "at int, n int, values array<long>",
        )
    )
    kinds = cut(
        pieces.groupBy("anchor", "content").agg(
            F.min("low").alias("low"), F.max("high").alias("high"), *(F.any_value(c).alias(c) for c in ("at", "n", "values"))
        )
    )
    shared = _shared(kinds.select("anchor", "low", "high", "n"), window, shard_words)
    found = cut(kinds.join(shared, "anchor"))
    drop_cut(kinds)
    every = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.struct(i.alias("i"), F.col("low").alias("lowest")))
    alone = found.where("kinds = 1").select("anchor", "content", "low", every.alias("lows"))
    several = found.where("kinds > 1").select("anchor", "content", "low", "high", "at", "n", "values", "busy")
    known = alone.unionByName(_settled(several, length + (window - length + 1) // 2, window, shard_words))
    moved = F.transform("lows", lambda x: F.struct((x["i"] + F.col("from")).alias("i"), x["lowest"].alias("lowest")))
    links = pieces.select("whole", "whole_content", "from", "anchor", "content")
    back = links.join(known, ["anchor", "content"]).groupBy(F.col("whole").alias("anchor"), F.col("whole_content").alias("content"))
    return streamed.unionByName(back.agg(F.min("low").alias("low"), F.flatten(F.collect_list(moved)).alias("lows")))


def _shared(kinds: DataFrame, window: int, shard_words: int) -> DataFrame:
    """(anchor, kinds, busy) of anchors in two documents or more; busy ones have more words than a shard."""
    anchors = kinds.groupBy("anchor").agg(
        F.count("*").alias("kinds"),
        F.sum(F.col("n") + (window - 1)).alias("words"),
        F.min("low").alias("lowest"),
        F.max("high").alias("highest"),
    )
    busy = (F.col("kinds") > 1) & (F.col("words") > shard_words)
    return anchors.where("lowest < highest").select("anchor", "kinds", busy.alias("busy"))


def repeated_windows(docs: DataFrame, window: int = 50, shard_words: int = 20_000) -> DataFrame:
    """(doc_id, text_key, first, mask): bit i of ``mask`` is set if window ``first + i`` starts in a document with a smaller id.

    ``docs`` has doc_id, text_key and t (UTF-8). ``shard_words`` is the size of an automaton's shard.
    """
    rows = cut(_segment_rows(docs, window))
    kinds = cut(
        rows.groupBy("anchor", "content").agg(
            F.min(F.struct("doc_id", "text_key", "first", "n")).alias("rep"), F.max("doc_id").alias("high")
        )
    )
    shared = _shared(kinds.select("anchor", F.col("rep.doc_id").alias("low"), "high", "rep.n"), window, shard_words)
    found = cut(kinds.join(shared, "anchor").select("anchor", "content", "kinds", "busy", "high", "rep.*"))
    drop_cut(kinds)
    alone = found.where("kinds = 1").select("anchor", "content", F.col("doc_id").alias("low"), F.lit(None).cast(LOWS).alias("lows"))
    wanted = (
        found.where("kinds > 1")
        .groupBy("doc_id", "text_key")
        .agg(F.collect_list(F.struct("anchor", "content", "high", "first", "n", "busy")).alias("wanted"))
    )
    contents = _packed(docs).dropDuplicates(["doc_id", "text_key"]).join(wanted, ["doc_id", "text_key"])
    contents = cut(
        contents.select("doc_id", "z", "wanted").mapInArrow(
            _contents(window),
            "anchor long, content long, low long, high long, at int, n int, values array<long>, busy boolean",
        )
    )
    known = cut(alone.unionByName(_settled(contents, GRAM, window, shard_words)))
    drop_cut(contents)
    hits = rows.join(known, ["anchor", "content"])
    none = F.lit(0).cast("long")
    bit = lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i)
    every = F.when(F.col("low") < F.col("doc_id"), bit(F.col("n")) - 1).otherwise(none)
    earlier = F.transform("lows", lambda x: F.when(x["lowest"] < F.col("doc_id"), bit(x["i"])).otherwise(none))
    some = F.aggregate(earlier, none, lambda a, b: a + b)
    hits = hits.select("doc_id", "text_key", "first", F.when(F.col("lows").isNull(), every).otherwise(some).alias("mask"))
    return hits.where("mask <> 0")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row.

    Words stand between ASCII white space. A null text has no words; rows with a null id are returned whole
    and are no reference. Rows with one id don't make each other repeats, equal or not. Other columns are
    not read; an empty table gives an empty result. The window may be 10 to 72 words.
    """
    if not GRAM <= window <= GRAM + 62:
        raise ValueError("the window must have 10 to 72 words")
    split = _split(docs, id_col, text_col)
    marks = repeated_windows(split, window).distinct()
    marks = marks.groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("first", "mask")).alias("marks"))
    joined = _packed(split).join(marks, ["doc_id", "text_key"], "left").select("doc_id", "z", "marks")
    return joined.mapInArrow(_kept(window), "doc_id long, n_words long, n_removed long, kept_sha256 string")
