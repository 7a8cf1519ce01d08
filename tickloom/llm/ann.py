"""Approximate nearest neighbours by adaptive dimension scan over inverted lists.

Vectors are dealt to lists by their nearest of a set of centroids, which are fitted on a bounded sample; every
vector is indexed. A query probes its nearest lists. All vectors are turned by one random rotation, so that
the first d of D columns of a difference are an unbiased sample of its squared length. Within a list the
columns are read in blocks, and after each block a candidate goes when its scaled partial distance lies
beyond the current k-th best by more than the test allows: partial * D / d > best * (1 + eps / sqrt(d))^2.
Survivors are scored on the original vectors in double precision.

The k nearest vectors of a small sample that goes with the index are a query's first finds. They bound its k-th best from the start, in
every list, and the bound falls as a list is scanned in growing chunks.

Lists are cut into slots, so that a list that holds a third of all vectors is as many bounded cells as it needs. A cell
holds the vectors of its slot while queries stream by; only beyond a block of queries is a slot copied.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import cut


@dataclass(frozen=True)
class Index:
    """Centroids, rotation and a sample (all of fixed size), and how many lists a query probes."""

    centroids: np.ndarray
    rotation: np.ndarray
    probes: int
    ids: np.ndarray
    sample: np.ndarray

    def first(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of about the k nearest sample vectors that aren't the query's own row."""
        apart = (self.sample * self.sample).sum(1) - 2 * self.sample @ query
        apart[self.ids == own] = np.inf
        near = np.argpartition(apart, k - 1)[:k] if len(apart) > k else np.arange(len(apart))
        near = near[np.isfinite(apart[near])]
        return self.ids[near], lengths(self.sample[near] - query)

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        c = self.centroids
        return (c * c).sum(1) - 2 * vectors @ c.T


def lengths(apart: np.ndarray) -> np.ndarray:
    """The Euclidean length of each row."""
    return np.sqrt((apart * apart).sum(1))


def usable(frame: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): rows with an id and a finite, non-zero vector of the most common length."""
    v = F.col(vector_col).cast("array<double>")
    rows = frame.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (length.n if length else 0))


def fit(rows: DataFrame, recall: float, max_lists: int = 512, sample_per_list: int = 40, rounds: int = 8, seed: int = 11, max_shared: int = 8192) -> Index | None:
    """k-means on at most about ``max_lists * sample_per_list`` vectors, chosen by a hash of their id.

    The number of probed lists is the least that holds a share of ``recall`` of the nearest neighbours which
    256 sample vectors have within the sample. At most ``max_shared`` sample vectors, and a sixteenth of
    the rows, go with the index, so that first finds bound the search but don't stand in for it.
    """
    total = rows.count()
    if not total:
        return None
    lists = int(np.clip(np.sqrt(total), 1, max_lists))
    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) / float(1 << 30)
    wanted = lists * sample_per_list
    chosen = rows.where(draw < wanted / total).orderBy("vec_id").limit(2 * wanted).select("vec_id", "v").toPandas()
    if not len(chosen):
        chosen = rows.orderBy("vec_id").limit(1).select("vec_id", "v").toPandas()
    sample, at = np.unique(np.stack(chosen["v"].to_numpy()), axis=0, return_index=True)
    ids = chosen["vec_id"].to_numpy()[at]
    rng = np.random.default_rng(seed)
    centroids = sample[rng.permutation(len(sample))[:lists]].copy()
    for _ in range(rounds):
        near = ((centroids * centroids).sum(1) - 2 * sample @ centroids.T).argmin(1)
        sums, counts = np.zeros_like(centroids), np.bincount(near, minlength=len(centroids))
        np.add.at(sums, near, sample)
        centroids[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    rotation, _ = np.linalg.qr(rng.normal(size=(sample.shape[1],) * 2))
    shared = np.sort(rng.permutation(len(sample))[: min(max_shared, total // 16)])
    index = Index(centroids, rotation, len(centroids), ids[shared], sample[shared])
    asked = sample[rng.permutation(len(sample))[:256]]
    apart = (sample * sample).sum(1) - 2 * asked @ sample.T
    near = apart.argsort(1)[:, 1:11]
    rank = index.distances(asked).argsort(1).argsort(1)
    needed = np.take_along_axis(rank, index.distances(sample).argmin(1)[near], 1).ravel()
    probes = int(np.quantile(needed, recall)) + 1 if len(needed) else 1
    return replace(index, probes=probes)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(len(column), -1)


class Slot:
    """Vectors of a cell, turned and cut into blocks of columns. ``read`` counts the numbers read of ``whole``."""

    def __init__(self, vectors: np.ndarray, rotation: np.ndarray, block: int = 16, eps: float = 2.1):
        turned = vectors @ rotation
        self.size, self.block, self.eps, self.rows = vectors.shape[1], block, eps, len(vectors)
        self.columns = [np.ascontiguousarray(turned[:, a : a + block]) for a in range(0, self.size, block)]
        self.read = self.whole = 0

    def scan(self, turned: np.ndarray, k: int, best: float = np.inf) -> np.ndarray:
        """The places of the candidates that no test abandoned; ``best`` is a square that the k-th best can't exceed."""
        kept, near, start, size = [], np.empty(0), 0, self.size
        while start < self.rows:
            end = min(self.rows, max(4 * k, 64) if not start else 4 * start)
            alive, partial = np.arange(start, end), np.zeros(end - start)
            for n, cols in enumerate(self.columns):
                if not len(alive):
                    break
                seen = min((n + 1) * self.block, size)
                step = cols[alive] - turned[n * self.block : seen]
                self.read += step.size
                partial = partial + np.einsum("ij,ij->i", step, step)
                if np.isfinite(best):
                    slack = (1 + self.eps / np.sqrt(seen)) ** 2 * seen / size if seen < size else 1 + 1e-9
                    stay = partial <= best * slack + 1e-12
                    alive, partial = alive[stay], partial[stay]
            kept.append(alive)
            near = np.concatenate([near, partial])
            if len(near) >= k:
                near = np.partition(near, k - 1)[:k]
                best = min(best, near.max())
            self.whole += (end - start) * size
            start = end
        return np.concatenate(kept) if kept else np.empty(0, int)


def _search_cells(index: Index, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by cell, vectors first; a cell may go on in the next batch, and its queries aren't kept."""
        cell, parts, held = None, [], None

        def search(own: np.ndarray, asked: np.ndarray, bounds: np.ndarray) -> pa.RecordBatch:
            nonlocal parts, held
            if held is None:
                ids, vectors = (np.concatenate(c) for c in zip(*parts, strict=True))
                parts, held = [], (ids, vectors, Slot(vectors, index.rotation))
            ids, vectors, slot = held
            out = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
            for n, turned in enumerate(asked @ index.rotation):
                at = slot.scan(turned, k + 1, bounds[n])  # one more, as the query's own row may be here
                at = at[ids[at] != own[n]]
                score = lengths(vectors[at] - asked[n])
                order = np.lexsort((ids[at], score))
                near, score = ids[at][order], score[order]
                new = np.ones(len(near), bool)
                new[1:] = (near[1:] != near[:-1]) | (score[1:] != score[:-1])
                near, score = near[new][:k], score[new][:k]
                out.append((np.full(len(near), own[n]), near, score))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([np.asarray(batch.column(i)) for i in range(4)], 1)
            ids, vectors, bounds = np.asarray(batch.column(4)), _matrix(batch.column(5)), np.asarray(batch.column(6))
            cuts = [0, *(np.nonzero((keys[1:] != keys[:-1]).any(1))[0] + 1), len(keys)]
            for s, e in zip(cuts, cuts[1:], strict=False):
                if cell != tuple(keys[s, :3]):
                    cell, parts, held = tuple(keys[s, :3]), [], None
                if keys[s, 3] == 0:
                    parts.append((ids[s:e], vectors[s:e]))
                elif parts or held:
                    yield search(ids[s:e], vectors[s:e], bounds[s:e])

    return run


def nearest(
    frame: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    query_every: int = 100,
    k: int = 10,
    recall: float = 0.97,
    least_candidates: int = 400,
    cell_rows: int = 4096,
    cell_queries: int = 65_536,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row whose id divides by ``query_every``.

    Rows with a null id, and null, zero or non-finite vectors or such of an unusual length, take no part.
    Ties go to the smaller id. Rows that repeat an id with the same vector count once. With fewer than k
    candidates all are returned; an empty table gives an empty result; other columns are not read.
    """
    spark = frame.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    rows = usable(frame, id_col, vector_col)
    index = fit(rows, recall)
    if index is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(index)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = shared.value.distances(_matrix(batch.column(1))).argmin(1) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays([pa.array(near, pa.int64()), *batch.columns], ["list", "vec_id", "v"])

    listed = cut(rows.distinct().mapInArrow(deal, "list long, vec_id long, v array<double>"))
    sizes = np.zeros(len(index.centroids), np.int64)
    for r in listed.groupBy("list").count().collect():  # as many rows as lists
        sizes[r.list] = r["count"]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = shared.value.distances(_matrix(batch.column(1))).argsort(1)
            enough = (np.cumsum(sizes[order], 1) < least_candidates).sum(1) + 1
            lists = [o[: max(n, shared.value.probes)].tolist() for o, n in zip(order, enough, strict=True)]
            first = [shared.value.first(own, v, k) for own, v in zip(batch.column(0).to_pylist(), _matrix(batch.column(1)), strict=True)]
            bounds = [float(score.max() ** 2) * (1 + 1e-9) if len(score) == k else float("inf") for _, score in first]
            pairs = [[{"vec_id": i, "score": x} for i, x in zip(near.tolist(), score.tolist(), strict=True)] for near, score in first]
            kinds = (pa.list_(pa.int64()), pa.float64(), pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.float64())])))
            columns = [pa.array(c, t) for c, t in zip((lists, bounds, pairs), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["vec_id", "v", "lists", "bound", "first"])

    queries = listed.where(F.col("vec_id") % query_every == 0).select("vec_id", "v").distinct()
    probed = cut(queries.mapInArrow(probe, "vec_id long, v array<double>, lists array<long>, bound double, first array<struct<vec_id:long,score:double>>"))
    asked = probed.select("vec_id", "v", "bound", F.explode("lists").alias("list"))
    asks = np.zeros(len(sizes), np.int64)
    for r in asked.groupBy("list").count().collect():
        asks[r.list] = r["count"]

    def per_list(values: np.ndarray) -> F.Column:
        return F.get(F.lit([int(x) for x in values]), F.col("list").cast("int")).cast("long")

    slots, blocks = per_list(np.maximum(1, -(-sizes // cell_rows))), per_list(np.maximum(1, -(-asks // cell_queries)))
    own_slot, own_block = F.pmod(F.xxhash64("vec_id"), slots), F.pmod(F.xxhash64("vec_id"), blocks)
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    candidates = listed.select("list", own_slot.alias("slot"), upto(blocks).alias("block"), F.lit(0).alias("side"), "vec_id", "v", F.lit(0.0).alias("bound"))
    wanted = asked.select("list", upto(slots).alias("slot"), own_block.alias("block"), F.lit(1).alias("side"), "vec_id", "v", "bound")
    cells = candidates.unionByName(wanted).repartition("list", "slot", "block").sortWithinPartitions("list", "slot", "block", "side")
    found = cells.mapInArrow(_search_cells(index, k), "query_id long, vec_id long, score double")
    first = probed.select(F.col("vec_id").alias("query_id"), F.explode("first").alias("f")).select("query_id", "f.*")
    ranked = found.unionByName(first).distinct().withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
