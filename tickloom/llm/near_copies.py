"""Near copies by the exact Jaccard similarity of their sets of word shingles.

Two documents link when their sets share at least ``similarity`` of their union, and groups are the connected
components of these links. No pair is missed and none below the bound links:

* Equal sets are one node from the start, so copies never meet as pairs.
* Prefix filter: in any one order of all shingles, sets of similarity t share one of the first
  n - ceil(t n) + 1 shingles of each. Frequent shingles of a sample come last in the order, so common lines
  seldom meet; the sample only bears on the number of candidates.
* Each shingle's sets are first compared with the smallest of them. What this joins need not meet again: only
  pairs of different components are formed afterwards, in tiles of bounded size that any task can take. So a large
  group of near copies costs a star and not a square.
* Tiles compare SimHashes of the sets by exclusive-or and bit counts. Their radius is so wide that a link lies beyond it
  with a chance of ``LOSS`` at most (``radius``), as seldom as hashes of sets collide.
* Pairs of too unequal sizes, and those whose sets must differ in too many shingles by the parities of buckets of their
  hashes, a lower bound of the true difference, are left out both times.
* A pair that shares several shingles is given by the first of them only. Each set brings its ``EARLY`` smallest ones for that;
  what is shared beyond them may give a pair again, which costs a row and loses none.
* Every candidate pair is decided by its texts' whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import LOWER_ASCII, cut, drop_cut
from tickloom.llm.simhash import _mixed, components, majority

_XXH = partial(xxhash.xxh64_intdigest, seed=42)
#: Words of 64 bits of a SimHash, shingles that a set brings to its cells, and the chance that a link lies beyond the radius.
WORDS, EARLY, LOSS = 8, 32, 1e-12


def shingles(text: bytes | None, size: int = 5) -> np.ndarray:
    """The distinct 64-bit hashes of a text's word shingles in rising order.

    A-Z are lower-cased, words stand between ASCII white space. A text of fewer words is one shingle; a null text
    or one without words has none.
    """
    parts = (text or b"").translate(LOWER_ASCII).split()
    words = np.fromiter(map(_XXH, parts), np.uint64, len(parts))
    size = min(size, len(words))
    if not size:
        return words
    hashes = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        hashes = hashes * np.uint64(0xD6E8FEB86659FD93) + words[i : i + len(hashes)]
    return np.unique(_mixed(hashes, 1))


def prefix(found: np.ndarray, common: np.ndarray, place: np.ndarray, similarity: float) -> np.ndarray:
    """The first n - ceil(t n) + 1 of a set's n hashes; ``common`` (rising) come last, by their ``place``."""
    n = len(found)
    if not n:
        return found
    wanted = n - math.ceil(similarity * n - 1e-9) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        rank = np.where(common[at] == found, place[at] + 1, 0)
        found = found[np.argsort(rank, kind="stable")]
    return found[:wanted]


def parities(found: np.ndarray) -> tuple[np.ndarray, bytes | None]:
    """Whether each of B buckets holds an odd number of a set's hashes: in 512 bits, and for large sets in more.

    Each hash that only one of two sets has changes one bit, so no more bits differ than hashes do. B is the first power of
    two that reaches the size of the set; half as many are the exclusive or of the halves.
    """
    size = max(512, 1 << max(len(found) - 1, 0).bit_length())
    odd = np.bincount((found >> np.uint64(20) & np.uint64(size - 1)).astype(np.int64), minlength=size).astype(np.uint8) & 1
    more = np.packbits(odd).tobytes() if size > 512 else None
    return np.packbits(np.bitwise_xor.reduce(odd.reshape(-1, 512))).view(np.int64), more


def parities_differ(a: bytes, b: bytes) -> int:
    """In how many buckets two sets differ, after the larger number of buckets is folded to the smaller."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    size = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(z.reshape(-1, size)) for z in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def bit_differs(similarity: float, exact: int = 24) -> float:
    """The greatest chance that one SimHash bit differs between two sets that link.

    Hashes are fair coins, so shared ones and those of either set alone are binomial. Counted out for up to ``exact``
    shared hashes; beyond, sums are as good as normal, and the angle of two sets of equal size is the widest.
    """
    odds = [np.array([math.comb(n, k) / 2**n for k in range(n + 1)]) for n in range(exact + 1)]
    worst = math.acos(2 * similarity / (1 + similarity)) / math.pi
    for shared in range(1, exact + 1):
        alone = min(math.floor(shared * (1 / similarity - 1) + 1e-9), exact)
        ones = np.arange(shared + 1)
        for a in range(alone + 1):
            for b in range(min(a, alone - a) + 1):
                high = [
                    np.array([odds[m][[k for k in range(m + 1) if 2 * (k + s) > shared + m]].sum() for s in ones]) for m in (a, b)
                ]
                worst = max(worst, float((odds[shared] * (high[0] * (1 - high[1]) + high[1] * (1 - high[0]))).sum()))
    return worst


@lru_cache
def radius(similarity: float, bits: int = WORDS * 64, loss: float = LOSS) -> int:
    """In how many bits the SimHashes of two sets that link may differ: more have a chance of ``loss`` at most."""
    p, beyond = bit_differs(similarity), 0.0
    for d in range(bits, 0, -1):
        beyond += math.comb(bits, d) * p**d * (1 - p) ** (bits - d)
        if beyond > loss:
            return d
    return 0


def met_before(early: np.ndarray, x: np.ndarray, y: np.ndarray, token: int) -> np.ndarray:
    """Whether rows x and y of ``early`` (shingles in rising order, padded with the greatest) share one below ``token``."""
    found = np.zeros(len(x), bool)
    for a in range(0, len(x), 4096):
        b = slice(a, a + 4096)
        left, right = early[x[b]], early[y[b]]
        found[b] = ((left[:, :, None] == right[:, None, :]) & (left < token)[:, :, None]).any((1, 2))
    return found


def similar(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both)


def common_shingles(texts: DataFrame, size: int, sample: int, most: int = 50_000) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in rising order, place of each by frequency): the shingles of several texts of a bounded sample."""
    total = texts.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingles(t.as_py(), size).view(np.int64))], ["h"])

    some = texts.select("t").where(F.pmod(F.xxhash64("t"), F.lit(max(1, -(-total // sample)))) == 0).distinct()
    counts = some.mapInArrow(run, "h long").groupBy("h").count().where("count > 2")
    rows = counts.orderBy(F.desc("count"), "h").limit(most).collect()
    common = np.array([r.h for r in reversed(rows)], np.int64).view(np.uint64)
    order = np.argsort(common)
    return common[order], order


def _pairs(similarity: float):
    most = radius(similarity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; a cell may go on in the next batch.

        They hold cell, tile, key, root, n, token, the parities, the SimHash and the smallest tokens of the key.
        """
        rest = np.empty((0, 14 + WORDS + EARLY), np.int64)

        def pairs(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            cuts = [0, *(np.nonzero(rows[1:, 0] != rows[:-1, 0])[0] + 1), len(rows)]
            left, right, held = [], [], 0
            for s, e in zip(cuts, cuts[1:], strict=False):
                _, tile, key, root, n = rows[s:e, :5].T
                token = rows[s, 5]
                bits, prints = (rows[s:e, i:j].view(np.uint64) for i, j in ((6, 14), (14, 14 + WORDS)))
                early = rows[s:e, 14 + WORDS :]
                apart = (tile != tile[0]).any()
                for a in range(0, e - s, 256):
                    b = slice(a, a + 256)
                    met = (key[b, None] < key) & (root[b, None] != root)
                    met &= np.minimum(n[b, None], n) >= similarity * np.maximum(n[b, None], n) - 1e-6
                    if apart:
                        met &= tile[b, None] != tile
                    x, y = np.nonzero(met)
                    near = np.bitwise_count(prints[x + a] ^ prints[y]).sum(1, dtype=np.int64) <= most
                    x, y = x[near], y[near]
                    differ = np.bitwise_count(bits[x + a] ^ bits[y]).sum(1, dtype=np.int64)
                    near = differ <= (1 - similarity) / (1 + similarity) * (n[x + a] + n[y]) + 1e-6
                    x, y = x[near], y[near]
                    new = ~met_before(early, x + a, y, token)
                    x, y = x[new], y[new]
                    left.append(key[x + a])
                    right.append(key[y])
                    held += len(x)
                    if held > 100_000:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["u", "v"])
                        left, right, held = [], [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["u", "v"])

        for batch in batches:
            rows = np.concatenate([rest, np.stack([np.asarray(c) for c in batch.columns], 1)])
            changes = np.nonzero(rows[1:, 0] != rows[:-1, 0])[0]
            end = int(changes[-1]) + 1 if len(changes) else 0
            if end:
                yield from pairs(rows[:end])
            rest = rows[end:]
        if len(rest):
            yield from pairs(rest)

    return run


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, first, key, n) of the tokens with several rows; rows come sorted by token and key."""
    rest = np.empty((0, 3), np.int64)  # a token's only row so far
    token, first = None, 0  # of a token whose rows went out already
    for batch in batches:
        rows = np.concatenate([rest, np.stack([np.asarray(c) for c in batch.columns], 1)])
        if not len(rows):
            continue
        starts = np.concatenate([[0], np.nonzero(rows[1:, 0] != rows[:-1, 0])[0] + 1])
        sizes = np.diff(np.append(starts, len(rows)))
        firsts, several = rows[starts, 1], sizes > 1
        if token is not None and rows[0, 0] == token:
            firsts[0], several[0] = first, True
        rest = rows[len(rows) if several[-1] else len(rows) - 1 :]
        token, first = (rows[-1, 0], firsts[-1]) if several[-1] else (None, 0)
        kept = np.repeat(several, sizes)
        columns = rows[kept, 0], np.repeat(firsts, sizes)[kept], rows[kept, 1], rows[kept, 2]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["token", "first", "key", "n"])


def _possible(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (u, v) that neither the sizes of their sets nor the parities rule out; ``sets`` has key, n, bits, more."""
    both = pairs
    for side in "uv":
        named = sets.select(F.col("key").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("n", "bits", "more")))
        both = both.join(named, side)
    differ = reduce(Column.__add__, (F.bit_count(F.col("bits_u")[i].bitwiseXOR(F.col("bits_v")[i])) for i in range(8)))
    most = (1 - similarity) / (1 + similarity) * (F.col("n_u") + F.col("n_v")) + 1e-6
    sizes = F.least("n_u", "n_v") >= similarity * F.greatest("n_u", "n_v") - 1e-6
    both = both.where(sizes & (differ <= most)).select("u", "v", most.alias("most"), "more_u", "more_v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)
            kept = pa.array([a is None or b is None or parities_differ(a, b) <= most for most, a, b in rows], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(kept) for i in (0, 1)], ["u", "v"])

    return both.mapInArrow(run, "u long, v long")


def _linked(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs (u, v) whose sets are similar, by the text that stands for each; ``docs`` has text_key and t."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = lru_cache(256)(partial(shingles, size=size))
        for batch in batches:
            texts = zip(batch.column(2), batch.column(3), strict=True)
            kept = pa.array([similar(of(a.as_py()), of(b.as_py()), similarity) for a, b in texts], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], ["u", "v"])

    wanted = nodes.join(pairs.select(F.explode(F.array("u", "v")).alias("key")).distinct(), "key").select("key", "text_key")
    texts = cut(docs.join(wanted, "text_key").groupBy("key").agg(F.min("t").alias("t")))
    both = pairs.join(texts.select(F.col("key").alias("u"), F.col("t").alias("a")), "u")
    both = both.join(texts.select(F.col("key").alias("v"), F.col("t").alias("b")), "v")
    found = cut(both.select("u", "v", "a", "b").mapInArrow(run, "u long, v long"))
    drop_cut(texts)
    return found


def groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    similarity: float = 0.8,
    sample: int = 10_000,
    tile_rows: int = 2048,
) -> DataFrame:
    """(doc_id, text_key, root, component_id) for every row of ``docs``.

    ``text_key`` is ``text_key`` of the row's text and ``root`` names the component, as one id may have texts in
    several. ``component_id`` is the smallest id reachable over links, itself included. Null texts and texts without words
    have one and the same empty set. Repeated rows come back as often as they went in; null ids are kept and never
    become a component's id. An empty table gives an empty result; other columns are not read.
    """
    t = F.col(text_col).cast("binary")
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_key(t).alias("text_key"), t.alias("t"))
    shared = docs.sparkSession.sparkContext.broadcast(common_shingles(picked, shingle, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py(), shingle) for t in batch.column(2)]
            keys = np.array([_XXH(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            firsts = [prefix(s, *shared.value, similarity) for s in sets]
            ends = np.cumsum([0, *map(len, firsts)], dtype=np.int32)
            values = np.concatenate([np.empty(0, np.uint64), *firsts]).view(np.int64)
            sizes = pa.array([len(s) for s in sets], pa.int64())
            bits, more = zip(*map(parities, sets), strict=True) if sets else ((), ())
            prints = [np.array(majority(s, WORDS), np.uint64).view(np.int64) for s in sets]
            columns = [pa.array(keys), sizes, *(pa.array(x, pa.list_(pa.int64())) for x in (prints, bits)), pa.array(more, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
                ["doc_id", "text_key", "key", "n", "print", "bits", "more", "prefix"],
            )

    schema = "doc_id long, text_key long, key long, n long, print array<long>, bits array<long>, more binary, prefix array<long>"
    prints = cut(picked.mapInArrow(run, schema))
    nodes = prints.groupBy("key").agg(F.min("doc_id").alias("low_id"), F.min("text_key").alias("text_key"))
    sets = prints.select("key", "n", "bits", "more").dropDuplicates(["key"])
    # copies of a set count once: the prefixes of one row of each key
    tokens = prints.select("key", "n", "prefix").dropDuplicates(["key"]).select(F.explode("prefix").alias("token"), "key", "n")
    dealt = tokens.repartition("token").sortWithinPartitions("token", "key")
    met = cut(dealt.mapInArrow(_repeated, "token long, first long, key long, n long"))
    stars = met.where("key <> first").select(F.col("first").alias("u"), F.col("key").alias("v")).distinct()
    stars = cut(_possible(stars, sets, similarity))
    links = _linked(stars, picked, nodes, shingle, similarity)

    roots = components(links).withColumnRenamed("node", "key")
    placed = met.drop("first").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    placed = cut(placed.select("token", "key", "n", "root"))
    mixed = placed.groupBy("token").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.count("*").alias("total"))
    tiles = F.ceil(F.col("total") / tile_rows)
    left = placed.join(mixed.where("a <> b").select("token", "total"), "token").withColumn("tile", F.pmod(F.xxhash64("key"), tiles))
    early = left.groupBy("key").agg(F.slice(F.array_sort(F.collect_list("token")), 1, EARLY).alias("early"))
    left = left.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), tiles - 1)))
    cell = F.xxhash64("token", F.least("tile", "other"), F.greatest("tile", "other"))
    left = left.select(cell.alias("cell"), "tile", "key", "root", "n", "token")
    left = left.join(prints.select("key", "print", "bits").dropDuplicates(["key"]).join(early, "key"), "key")
    width = {"bits": 8, "print": WORDS, "early": EARLY}
    numbers = (F.coalesce(F.get(c, F.lit(i)), F.lit((1 << 63) - 1)) for c, n in width.items() for i in range(n))
    dealt = left.select("cell", "tile", "key", "root", "n", "token", *numbers).repartition("cell")
    pairs = cut(dealt.sortWithinPartitions("cell").mapInArrow(_pairs(similarity), "u long, v long").distinct())
    fresh = cut(_possible(pairs.join(stars, ["u", "v"], "left_anti"), sets, similarity))
    links = links.unionByName(_linked(fresh, picked, nodes, shingle, similarity))

    roots = components(links).withColumnRenamed("node", "key")
    grouped = nodes.drop("text_key").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    smallest = grouped.groupBy("root").agg(F.min("low_id").alias("component_id"))
    rows = prints.select("doc_id", "text_key", "key")
    found = cut(rows.join(grouped.join(smallest, "root").select("key", "root", "component_id"), "key").drop("key"))
    for done in (prints, met, placed, stars, pairs, fresh, links):
        drop_cut(done)
    return found


def text_key(text: Column) -> Column:
    """A hash of a text, which tells apart the texts of one id."""
    return F.xxhash64(text.cast("binary"))


def near_copies(docs: DataFrame, *args, **kwargs) -> DataFrame:
    """(doc_id, component_id) of ``groups``."""
    return groups(docs, *args, **kwargs).select("doc_id", "component_id")
