"""SimHash near-duplicates by tiled exact comparison.

Fingerprints are 64-bit SimHashes of word shingles. Two documents link when their fingerprints
differ in ``radius`` bits or fewer, and groups are the connected components of these links.

How the comparison stays exact and bounded:

* Equal fingerprints are one node from the start, so copies never meet as pairs.
* The 64 bits are cut into blocks. Fingerprints within the radius agree on all but ``radius``
  blocks, so each pair of them shares the value of at least one choice of the remaining blocks.
  That value is the bucket; nothing is lost and unrelated fingerprints rarely meet.
* A bucket above ``tile_rows`` is cut into tiles of one population count each. Only pairs of tiles
  whose counts differ by at most the radius are formed (a larger difference already proves a larger
  distance), and every pair of tiles is a cell of its own that any task can take.
* A cell compares with numpy exclusive-or and bit counts, again skipping tiles by population count,
  and returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import LOWER_ASCII, cut, drop_cut

_XXH = partial(xxhash.xxh64_intdigest, seed=42)


def _mixed(h: np.ndarray, word: int) -> np.ndarray:
    """Another hash of the same shingles for fingerprint word ``word``; word 0 is the hash itself."""
    if word == 0:
        return h
    h = h + np.uint64(word * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def fingerprint(text: bytes | None, shingle: int = 3, words: int = 1) -> list[int]:
    """SimHash of UTF-8 text in ``words`` numbers of 64 bits.

    A-Z are lower-cased, words stand between ASCII white space, shingles count with repeats. A text of
    fewer words is one shingle; a null text or one without words has fingerprint zero.
    """
    parts = (text or b"").translate(LOWER_ASCII).split()
    if not parts:
        return [0] * words
    if len(parts) <= shingle:
        hashes = np.array([_XXH(b" ".join(parts))], np.uint64)
    else:
        grams = zip(*(parts[i:] for i in range(shingle)), strict=False)
        hashes = np.fromiter(map(_XXH, map(b" ".join, grams)), np.uint64, len(parts) - shingle + 1)
    return majority(hashes, words)


def majority(hashes: np.ndarray, words: int) -> list[int]:
    """SimHash of 64-bit hashes in ``words`` numbers of 64 bits: a bit is 1 if over half of the hashes have it."""
    out = []
    for word in range(words):
        bits = np.unpackbits(_mixed(hashes, word).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        counts = bits[whole:].sum(0, dtype=np.int64)
        if whole:  # 255 ones still fit a byte, so most adding is done on bytes
            counts += bits[:whole].reshape(-1, 255, 64).sum(1, dtype=np.uint8).sum(0, dtype=np.int64)
        out.append(int(np.packbits(counts * 2 > len(bits), bitorder="little").view(np.uint64)[0]))
    return out


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, words: int = 1
) -> DataFrame:
    """(doc_id, fp, f0 ...): one row per input row; ``fp`` names the whole fingerprint."""
    names = [f"f{i}" for i in range(words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [fingerprint(t.as_py(), shingle, words) for t in batch.column(1)]
            fps = np.array(rows, np.uint64).reshape(-1, words).view(np.int64)
            columns = [pa.array(np.ascontiguousarray(fps[:, i])) for i in range(words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *names])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("t"))
    found = picked.mapInArrow(run, "doc_id long, " + ", ".join(f"{n} long" for n in names))
    return found.withColumn("fp", F.col("f0") if words == 1 else F.xxhash64(*names))


def block_masks(blocks: int, kept: int) -> list[int]:
    """Bit masks, one per choice of ``kept`` of the blocks that 64 bits are cut into."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    one = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(some) for some in combinations(one, kept)]


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int, tile: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of rows within the radius; both sides are (rows, words) of 64 bits.

    Rows are tiled in the order of their population counts, and tile pairs whose counts differ by more
    than the radius are skipped.
    """
    pop_a, pop_b = (np.bitwise_count(x).sum(1, dtype=np.int64) for x in (a, b))
    oa, ob = np.argsort(pop_a, kind="stable"), np.argsort(pop_b, kind="stable")
    a, b, pop_a, pop_b = a[oa], b[ob], pop_a[oa], pop_b[ob]
    left, right = [], []
    for i in range(0, len(a), tile):
        rows = a[i : i + tile]
        low = np.searchsorted(pop_b, pop_a[i] - radius, "left")
        high = np.searchsorted(pop_b, pop_a[min(i + tile, len(a)) - 1] + radius, "right")
        for j in range(low, high, tile):
            other = b[j : min(j + tile, high)]
            apart = np.bitwise_count(rows[:, None, 0] ^ other[None, :, 0]).astype(np.int16)
            for word in range(1, a.shape[1]):
                apart += np.bitwise_count(rows[:, None, word] ^ other[None, :, word])
            x, y = np.nonzero(apart <= radius)
            left.append(oa[x + i])
            right.append(ob[y + j])
    none = np.empty(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def forest(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``size`` items the smallest item of its component under the links (i, j)."""
    root = np.arange(size)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def _cell_links(ids: np.ndarray, fps: np.ndarray, side: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    if (side == 0).all():
        i, j = near_pairs(fps, fps, radius)
    else:
        left, right = np.nonzero(side == 1)[0], np.nonzero(side == 2)[0]
        i, j = near_pairs(fps[left], fps[right], radius)
        i, j = left[i], right[j]
    root = forest(len(ids), i, j)
    kept = np.nonzero(root != np.arange(len(ids)))[0]
    return ids[kept], ids[root[kept]]


def _compare(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell; a cell may go on in the next batch."""
        rest: np.ndarray | None = None

        def links(rows: np.ndarray) -> pa.RecordBatch | None:
            starts = np.nonzero((rows[1:, :2] != rows[:-1, :2]).any(1))[0] + 1
            cuts = [0, *starts, len(rows)]
            found = [
                _cell_links(rows[s:e, 3], rows[s:e, 4:].view(np.uint64), rows[s:e, 2], radius)
                for s, e in zip(cuts, cuts[1:], strict=False)
                if e - s > 1
            ]
            found = [f for f in found if len(f[0])]
            if not found:
                return None
            x, y = (np.concatenate(c) for c in zip(*found, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(x), pa.array(y)], ["u", "v"])

        for batch in batches:
            rows = np.stack([np.asarray(c) for c in batch.columns], 1)
            rows = rows if rest is None else np.concatenate([rest, rows])
            changes = np.nonzero((rows[1:, :2] != rows[:-1, :2]).any(1))[0]
            end = int(changes[-1]) + 1 if len(changes) else 0
            if end and (out := links(rows[:end])):
                yield out
            rest = rows[end:]
        if rest is not None and len(rest) and (out := links(rest)):
            yield out

    return run


def links(nodes: DataFrame, radius: int = 2, blocks: int = 3, kept: int = 1, tile_rows: int = 2048) -> DataFrame:
    """(u, v): links between distinct fingerprints, enough of them to join every linked pair's component.

    ``nodes`` has one row per distinct fingerprint: ``fp`` and its words ``f0 ...``. With
    ``blocks - kept >= radius`` and one word no pair within the radius can be missed.
    """
    names = [c for c in nodes.columns if c[0] == "f" and c[1:].isdigit()]
    masks = block_masks(blocks, kept)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = [F.col(n).bitwiseAND(F.lit(m).cast("long")) for n in names for m in signed]
    pop = sum((F.bit_count(n) for n in names[1:]), F.bit_count(names[0])).cast("int")
    keyed = nodes.select("fp", *names, pop.alias("pop"), F.posexplode(F.array(*keys)).alias("band", "key"))
    by_pop = keyed.groupBy("band", "key", "pop").count()
    buckets = by_pop.groupBy("band", "key").agg(
        F.sum("count").alias("total"),
        F.collect_list(F.struct("pop", F.ceil(F.col("count") / tile_rows).alias("n"))).alias("slots"),
    )
    buckets = buckets.where("total > 1").select(
        "band", "key", F.when(F.col("total") > tile_rows, F.map_from_entries("slots")).alias("slots")
    )
    met = keyed.join(buckets, ["band", "key"])
    met = met.withColumn("slot", F.pmod(F.xxhash64("fp"), F.element_at("slots", F.col("pop"))))

    def cells(around: Column, right: bool) -> Column:
        """Cells of this row's tile with every other tile of a population count in ``around``."""

        def of(q: Column) -> Column:
            n = F.coalesce(F.element_at(F.col("slots"), q), F.lit(0).cast("long"))
            every = F.slice(F.sequence(F.lit(0).cast("long"), n), F.lit(1), n.cast("int"))
            beyond = (lambda x: x < F.col("slot")) if right else (lambda x: x > F.col("slot"))
            wanted = F.filter(every, lambda x: (q != F.col("pop")) | beyond(x))
            own = (F.col("pop"), F.col("slot"))
            return F.transform(
                wanted,
                lambda x: F.struct(
                    F.xxhash64(F.col("band"), F.col("key"), *((q, x, *own) if right else (*own, q, x))).alias("tiles"),
                    F.lit(2 if right else 1).cast("long").alias("side"),
                ),
            )

        return F.flatten(F.transform(around, of))

    zero = F.lit(0).cast("long")
    whole = F.array(F.struct(zero.alias("tiles"), zero.alias("side")))
    alone = F.array(F.struct(F.xxhash64("band", "key", "pop", "slot").alias("tiles"), zero.alias("side")))
    later = cells(F.sequence(F.col("pop"), F.col("pop") + radius), right=False)
    earlier = cells(F.sequence(F.col("pop") - radius, F.col("pop")), right=True)
    placed = met.select(
        F.xxhash64("band", "key").alias("bucket"),
        "fp",
        *names,
        F.inline(F.when(F.col("slots").isNull(), whole).otherwise(F.concat(alone, later, earlier))),
    )
    dealt = placed.select("bucket", "tiles", "side", "fp", *names).repartition("bucket", "tiles")
    return dealt.sortWithinPartitions("bucket", "tiles").mapInArrow(_compare(radius), "u long, v long")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): every node of the edges with the smallest node of its component.

    Alternating large and small stars; each round is two aggregations and two joins on thin rows, cut
    off in the shared folder. Nothing is gathered by component.
    """
    pairs = cut(edges.where("u <> v").selectExpr("greatest(u, v) AS u", "least(u, v) AS v").distinct())
    before = None
    for _ in range(max_rounds):
        both = pairs.unionByName(pairs.selectExpr("v AS u", "u AS v"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").selectExpr("v AS u", "m AS v")
        large = large.where("u <> v").distinct()  # now u > v everywhere
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").selectExpr("v AS u", "m AS v")
        after = cut(small.unionByName(low.selectExpr("u", "m AS v")).distinct())
        state = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_cut(pairs)
        pairs = after
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return pairs.selectExpr("u AS node", "v AS root").unionByName(pairs.selectExpr("v AS node", "v AS root").distinct())


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    radius: int = 2,
    words: int = 1,
    blocks: int = 3,
    kept: int = 1,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links, itself included. Null and empty texts have
    fingerprint zero and link like any other. Repeated rows come back as often as they went in; null ids
    are kept and never become a component's id (a component of null ids only has a null id). An empty
    table gives an empty result; other columns are not read.

    With several words the radius counts over all their bits, and candidates are the pairs that agree on
    ``kept`` of the ``blocks`` of any one word.
    """
    prints = cut(fingerprints(docs, id_col, text_col, shingle, words))
    names = [f"f{i}" for i in range(words)]
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("low_id"), *(F.first(n).alias(n) for n in names))
    roots = components(links(nodes.drop("low_id"), radius, blocks, kept))
    grouped = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = grouped.groupBy("root").agg(F.min("low_id").alias("component_id"))
    classes = grouped.join(smallest, "root").select("fp", "component_id")
    hexed = F.concat(*(F.lower(F.lpad(F.hex(n), 16, "0")) for n in names))
    return prints.join(classes, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8
) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the row with the smallest id stays.

    Of repeated rows with one id and text one stays. Where one id has several texts, each is judged by itself: those
    of different groups may all stay, and of those within one group the one with the smallest text hash counts as
    the first. Rows with a null id can't be told apart by id and all stay. Other columns are kept as they were.
    """
    from tickloom.llm.near_copies import groups, text_key

    found = groups(docs, id_col, text_col, shingle, similarity).where("doc_id = component_id")
    first = found.groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("__rows")).groupBy("root")
    first = first.agg(F.min(F.struct(F.col("doc_id").alias("__first_id"), F.col("text_key").alias("__first_key"), "__rows")).alias("m"))
    first = first.select("m.*")
    named = docs.where(F.col(id_col).isNotNull()).withColumn("__text_key", text_key(F.col(text_col)))
    same = (F.col(id_col).cast("long") == F.col("__first_id")) & (F.col("__text_key") == F.col("__first_key"))
    once = named.join(first.where("__rows = 1"), same, "left_semi")
    repeated = named.join(first.where("__rows > 1"), same, "left_semi").dropDuplicates([id_col, "__text_key"])
    return once.unionByName(repeated).drop("__text_key").unionByName(docs.where(F.col(id_col).isNull()))
