"""Toxicity scores by non-negative positive-unlabelled learning.

Training sees confirmed toxic texts and unlabelled texts only. With the class prior p, positives P and
unlabelled U, the risk of a score g under the logistic loss l is

    p * E_P[l(g, +)] + max(0, E_U[l(g, -)] - p * E_P[l(g, -)])

where the second part estimates the risk on the unseen negatives and may not fall below zero: when a batch
takes it there, the step goes the other way and gives the over-fitted part back. Features are the distinct
words of the whole text, hashed; the model is one weight per hash and an intercept. Several classifiers, each
from its own order of batches, are averaged.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import held_out

#: What stands around a word and is no part of it.
_EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "¿¡«»…“”„"


class _Hashes(dict):
    """Token to feature number, kept while a worker runs."""

    def __init__(self, bits: int):
        super().__init__()
        self.mask = (1 << bits) - 1

    def __missing__(self, token: str) -> int:
        found = zlib.crc32(token.strip(_EDGE).encode()) & self.mask
        if len(self) > 150_000:
            self.clear()
        if len(token) < 64:
            self[token] = found
        return found


def features(text: str | None, hashes: _Hashes) -> set[int]:
    """Feature numbers of the distinct lower-case words of a text."""
    return set(map(hashes.__getitem__, set((text or "").lower().split())))


@dataclass(frozen=True)
class Model:
    """Weights by feature number, an intercept, and how many bits feature numbers have."""

    weights: np.ndarray
    intercept: float
    bits: int

    def scores(self, texts: Iterator[str | None], hashes: _Hashes) -> np.ndarray:
        out = np.array([self.weights[list(f)].sum() if (f := features(t, hashes)) else 0.0 for t in texts], float)
        return 1 / (1 + np.exp(-np.clip(out + self.intercept, -30, 30)))


def fit_nnpu(
    positive: list[np.ndarray],
    unlabelled: list[np.ndarray],
    prior: float,
    bits: int,
    classifiers: int = 3,
    steps: int = 1500,
    batch: int = 1024,
    rate: float = 0.1,
    decay: float = 1e-4,
    least_z: float = 4.5,
    seed: int = 7,
) -> Model:
    """Average of ``classifiers`` linear models fitted by Adam on the non-negative risk."""
    size = 1 << bits
    if not positive or not unlabelled:
        return Model(np.zeros(size), -30.0 if not positive else 0.0, bits)
    # A word stays if its share of positives differs from its share of unlabelled texts by more than chance
    # allows over so many words; others would only let the model memorise.
    in_p, in_u = (np.bincount(np.concatenate(x), minlength=size) for x in (positive, unlabelled))
    n_p, n_u = len(positive), len(unlabelled)
    pooled = (in_p + in_u + 0.5) / (n_p + n_u + 1)
    apart = in_p / n_p - in_u / n_u
    usable = (np.abs(apart) > least_z * np.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u))) & (in_p + in_u >= 3)

    kept = np.nonzero(usable)[0]
    place = np.full(size, -1)
    place[kept] = np.arange(len(kept))

    def flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        places = [place[r][usable[r]] for r in rows]
        return np.concatenate(places), np.cumsum([0, *map(len, places)])

    sides = flat(positive), flat(unlabelled)
    n = len(kept)  # the intercept stands behind the words
    total = np.zeros(n + 1)
    for c in range(classifiers):
        rng = np.random.default_rng(seed + c)
        w, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
        w[n] = np.log(prior / (1 - prior))
        for step in range(1, steps + 1):
            ids, rows = [], []
            for side, (words, at) in enumerate(sides):
                chosen = rng.integers(0, len(at) - 1, batch)
                lengths = at[chosen + 1] - at[chosen]
                within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                ids.append(words[np.repeat(at[chosen], lengths) + within])
                rows.append(np.repeat(np.arange(batch) + side * batch, lengths))
            ids, rows = np.concatenate(ids), np.concatenate(rows)
            g = np.bincount(rows, w[ids], 2 * batch) + w[n]
            sigma = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
            loss = np.logaddexp(0, g)  # of calling it negative; its slope is sigma
            negative_part = loss[batch:].mean() - prior * loss[:batch].mean()
            if negative_part >= 0:  # slopes of p * E_P[l(+)] + E_U[l(-)] - p * E_P[l(-)]
                slope = np.concatenate([np.full(batch, -prior), sigma[batch:]])
            else:
                slope = np.concatenate([prior * sigma[:batch], -sigma[batch:]])
            grad = np.append(np.bincount(ids, slope[rows], n), slope.sum()) / batch
            grad[:n] += decay * w[:n]
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
            lr = rate * (1 - step / steps) + 1e-4
            w -= lr * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        total += w
    weights = np.zeros(size)
    weights[kept] = total[:n] / classifiers
    return Model(weights, total[n] / classifiers, bits)


STRETCHES = (1.0, 1.5, 2.0, 3.0, 4.0, 6.0)


def stretched(model: Model, factor: float, unlabelled: list[np.ndarray], prior: float) -> Model:
    """The model times a factor, with the intercept that makes the mean score of unlabelled texts the prior."""
    g = factor * np.array([model.weights[r].sum() for r in unlabelled])
    low, high = -60.0, 60.0
    for _ in range(60):
        b = (low + high) / 2
        low, high = (b, high) if (1 / (1 + np.exp(-np.clip(g + b, -60, 60)))).mean() < prior else (low, b)
    return Model(model.weights * factor, b, model.bits)


def fit_calibrated(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, bits: int) -> Model:
    """Fit on all texts, stretched by the factor that has the least risk on a fifth kept from a first fit.

    The penalty that keeps the fit from memorising also makes its scores timid.
    """
    if len(positive) < 20 or len(unlabelled) < 50:
        return fit_nnpu(positive, unlabelled, prior, bits)
    seen, (some_p, some_u) = ([[r for i, r in enumerate(rows) if (i % 5 == 0) == kept] for rows in (positive, unlabelled)] for kept in (False, True))
    first = fit_nnpu(*seen, prior, bits)

    def risk(factor: float) -> float:
        m = stretched(first, factor, some_u, prior)
        g_p, g_u = (np.array([m.weights[r].sum() for r in rows]) + m.intercept for rows in (some_p, some_u))
        plus, minus_p, minus_u = (np.logaddexp(0, x).mean() for x in (-g_p, g_p, g_u))
        return prior * plus + max(0.0, minus_u - prior * minus_p)

    return stretched(fit_nnpu(positive, unlabelled, prior, bits), min(STRETCHES, key=risk), unlabelled, prior)


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    bits: int = 20,
    max_positive: int = 5000,
    max_unlabelled: int = 10000,
) -> Model:
    """Fit on a bounded sample: about ``max_positive`` confirmed toxic and ``max_unlabelled`` other texts.

    Ids are chosen by a hash, never by place, and each once (of several texts of one id the one with the smallest
    features); so the sample, and what is broadcast, is bounded. Ids of the held-out fifth are left out of both samples. A document counts as confirmed toxic if any of its label rows says 1; the class prior is the
    share of such documents among the labelled ones that may be learnt from.
    """
    learnt = labels.select(F.col(id_col).cast("string").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where(
        F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out("doc_id")
    )
    learnt = learnt.groupBy("doc_id").agg(F.max("label").alias("label"))
    labelled, toxic = learnt.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    known = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text")).where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id")
    )
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    texts = known.agg(F.count("*")).first()[0]
    chosen = learnt.where((F.col("label") == 1) & (draw < max_positive / max(toxic, 1))).select("doc_id", draw.alias("__d"))
    chosen = chosen.orderBy("__d", "doc_id").limit(2 * max_positive).select("doc_id")  # a proven bound for the broadcast
    positive = known.join(F.broadcast(chosen), "doc_id").withColumn("kind", F.lit(1))
    unlabelled = known.where(1 - draw < max_unlabelled / max(texts, 1)).withColumn("kind", F.lit(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes(bits)
        for batch in batches:
            rows = [np.sort(np.fromiter(features(t, hashes), np.int32)).tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(rows, pa.binary())], ["doc_id", "kind", "ids"])

    both = positive.unionByName(unlabelled).select("doc_id", "kind", "text")
    sample = both.mapInArrow(run, "doc_id string, kind int, ids binary").groupBy("doc_id", "kind").agg(F.min("ids").alias("ids"))
    found = sample.select("kind", "ids").toArrow()
    rows = sorted(zip(found["ids"].to_pylist(), found["kind"].to_pylist(), strict=True))
    prior = min(max(toxic / max(labelled, 1), 1e-3), 0.9)
    split = [[np.frombuffer(r, np.int32) for r, k in rows if k == kind and r] for kind in (1, 0)]
    return fit_calibrated(*split, prior, bits)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; the model sees the whole text and nothing else.

    Null and empty texts get the score of a text without words. Null ids stay null and count as held out, as
    crc32('') is 0. Repeated rows come back as often as they went in. An empty table gives
    an empty result. Other columns are not read.
    """
    scored = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), score_column(docs.sparkSession, model)(F.col(text_col)).alias("score")
    )
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def score_column(spark, model: Model):
    """A function from a text column to its score; the model (a fixed 2 ** bits weights) is broadcast."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes = _Hashes(shared.value.bits)
        for part in parts:
            yield pd.Series(shared.value.scores(part, hashes))

    return scores


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on ``labels`` and score every row of ``docs``."""
    return score(docs, train(docs, labels, id_col, text_col), id_col, text_col)
