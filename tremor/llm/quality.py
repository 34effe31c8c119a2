"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated by isotonic regression.

The features approximate a Gaussian kernel. Every partition adds up the normal equations of its labelled rows, one system for each fold;
Spark sums them, so the driver sees matrices of a fixed size whatever the number of rows. Out-of-fold scores are counted in a fixed
number of bins, to which the isotonic step function is fitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import cut, held_out, labelled, only_columns, tidy
from tremor.llm.docstats import FEATURES, document_stats

DIM, FOLDS, BINS, RIDGE = 192, 3, 512, 1e-3
THRESHOLD = 0.7


@dataclass
class Fourier:
    """Standardised statistics to cosine features; the random directions are fixed by ``seed``."""

    mean: np.ndarray
    scale: np.ndarray
    dim: int = DIM
    seed: int = 11

    def __call__(self, x: np.ndarray) -> np.ndarray:
        d = len(self.mean)
        rng = np.random.default_rng(self.seed)
        w = rng.normal(size=(d, self.dim)) / np.sqrt(2 * d)
        b = rng.uniform(0, 2 * np.pi, self.dim)
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.hstack([np.sqrt(2 / self.dim) * np.cos(z @ w + b), np.ones((len(x), 1))])


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def pool(score: np.ndarray, weight: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic regression by pooling adjacent violators: (centre, value) of each block, for ascending ``score``."""
    blocks: list[list[float]] = []
    for s, w, y in zip(score, weight, label, strict=True):
        blocks.append([s * w, w, y])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[0] / b[1] for b in blocks]), np.array([b[2] / b[1] for b in blocks])


@dataclass
class Model:
    fourier: Fourier
    beta: np.ndarray
    at: np.ndarray
    value: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.fourier(x) @ self.beta, self.at, self.value), 0, 1)


def _normal_equations(train: DataFrame, fourier: Fourier) -> np.ndarray:
    """Sums of [phi, y]'[phi, y] by fold, from sums by partition."""
    k = fourier.dim + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FOLDS, k, k))
        for b in batches:
            if b.num_rows:
                rows = np.hstack([fourier(matrix(b.column(1))), b.column(2).to_numpy(zero_copy_only=False)[:, None]])
                fold = b.column(0).to_numpy(zero_copy_only=False)
                for f in range(FOLDS):
                    total[f] += rows[fold == f].T @ rows[fold == f]
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["cell", "v"])

    rows = train.select("fold", "features", F.col("y").cast("double")).mapInArrow(tidy(run), "cell int, v double").groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(FOLDS * k * k)
    out[rows.column("cell").to_numpy()] = rows.column("v").to_numpy()
    return out.reshape(FOLDS, k, k)


def _solve(system: np.ndarray) -> np.ndarray:
    a, b = system[:-1, :-1], system[:-1, -1]
    return np.linalg.solve(a + RIDGE * (1 + np.trace(a) / len(a)) * np.eye(len(a)), b)


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """``stats``: doc_id and features; ``labels``: doc_id and quality. Held-out rows are not learned from. Without labels every score is 0.5."""
    n = len(FEATURES)
    moments = stats.select(*[f(F.col("features")[i]).alias(f"{f.__name__}{i}") for f in (F.avg, F.stddev_pop) for i in range(n)]).first()
    values = np.array([float(v or 0) for v in moments])
    fourier = Fourier(values[:n], np.where(values[n:] > 1e-9, values[n:], 1))
    train = stats.select("doc_id", "features").join(labelled(labels, "quality"), "doc_id").withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)).cast("int"))
    systems = _normal_equations(train, fourier)
    whole = systems.sum(axis=0)
    if not whole[-2, -2]:
        return Model(fourier, np.zeros(fourier.dim + 1), np.array([0.0]), np.array([0.5]))
    betas = [_solve(whole - s) for s in systems]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                each = np.stack([fourier(matrix(b.column(1))) @ beta for beta in betas])
                score = each[b.column(0).to_numpy(zero_copy_only=False), np.arange(b.num_rows)]
                bins = np.clip(((score + 0.5) / 2 * BINS).astype(np.int32), 0, BINS - 1)
                yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(score), b.column(2)], names=["bin", "score", "y"])

    counts = train.select("fold", "features", F.col("y").cast("double")).mapInArrow(tidy(run), "bin int, score double, y double").groupBy("bin").agg(F.avg("score").alias("s"), F.count("*").alias("n"), F.sum("y").alias("y")).orderBy("bin").collect()
    s, w, y = (np.array([float(r[k]) for r in counts]) for k in ("s", "n", "y"))
    return Model(fourier, _solve(whole), *pool(s, w, y))


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1, higher: quality 1 likelier), predicted (1 if score >= 0.7).

    Labels of held-out rows (crc32 of the id as text modulo 4 is 2) are never read. Null and empty texts have the statistics of no words and
    a score like any other; a null id is not held out. Repeated rows are scored each. Null labels and labels of unknown ids are not used.
    Nothing but the text enters a score.
    """
    stats = cut(document_stats(only_columns(docs, "doc_id", "text"), ["doc_id"]).select("doc_id", "features"))
    model = fit(stats, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model(matrix(b.column(1))))], names=["doc_id", "score"])

    scored = stats.mapInArrow(tidy(run), f"doc_id {dict(stats.dtypes)['doc_id']}, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
