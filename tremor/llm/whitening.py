"""Whitening of embeddings by a compensated covariance.

1. Tasks sum the quantised vectors exactly, as integers, and count them.
2. Each vector is centred on the exact mean as an unevaluated sum of two doubles. Centred columns are split, free of error, into slices of ``SLICE`` bits below the
   column's largest entry, so that products of slices and their sums over up to ``ROWS`` rows are exact in a double: the outer products of a batch come out of a few matrix
   products without any rounding. They are added up in double-double (two-sums), and a task sends the high and the low part of each row of its sum.
   Those are merged row by row, again by two-sums, so no task and not the driver holds more than one matrix of the dimensions.
3. The driver solves the one matrix: reduction to tridiagonal form and divide and conquer (LAPACK's ``syevd``, which ``numpy.linalg.eigh`` calls), then a step of
   refinement with the low part in extended precision.
4. A last pass measures how far the covariance of the whitened rows is from the identity.

Only sums of the size of one vector, and one matrix of the dimensions, ever reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import only_columns, tidy

#: Bits of a slice; rows whose products of slices are summed exactly in a double: 2 * (SLICE - 1) + log2(ROWS) <= 53.
SLICE, ROWS = 21, 1024
#: Larger quantised entries count as this large.
MOST = 1 << 52


@dataclass(frozen=True)
class Quantiser:
    """x = floor(scale * c) + offset, as a 64-bit integer of magnitude ``MOST`` at most."""

    scale: float = 1024.0
    offset: int = 100_000

    def __call__(self, c: np.ndarray) -> np.ndarray:
        return np.clip(np.floor(c * self.scale), -MOST, MOST).astype(np.int64) + self.offset


@dataclass(frozen=True)
class Whitening:
    """n vectors of ``size`` dimensions with the exact ``sums``; eigenvalues, falling, and unit eigenvectors (columns) of their covariance, whose trace is given."""

    n: int
    size: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    quantiser: Quantiser

    @property
    def flat(self) -> np.ndarray:
        """Components without variance but for rounding."""
        return self.values <= 4 * self.size * np.finfo(float).eps * self.trace

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: 64-bit integers, or Python's where those would not do."""
        wide = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0) >= 1 << 62
        return x.astype(object) * self.n - np.array(self.sums, object) if wide else x * self.n - np.array(self.sums, np.int64)

    def project(self, m: np.ndarray, k: int) -> np.ndarray:
        """The first ``k`` components of centred rows, over the root of their eigenvalue; 0 for a component without variance."""
        scale = np.where(self.flat[:k], 0.0, 1 / np.sqrt(np.where(self.flat[:k], 1.0, self.values[:k])))
        return (m / self.n).astype(float) @ self.vectors[:, :k] * scale


def dense(column: pa.Array, size: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix of doubles) of the rows without null or non-finite entries, for each length, or for ``size`` only; empty vectors are left out."""
    ends = column.offsets.to_numpy()
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    lengths = np.diff(ends)
    good = column.is_valid().to_numpy(zero_copy_only=False) & (bad[ends[1:]] == bad[ends[:-1]]) & (lengths > 0)
    for length in np.unique(lengths[good]) if size is None else [size]:
        at = np.flatnonzero(good & (lengths == length))
        if len(at):
            yield at, values[ends[at][:, None] + np.arange(length)]


def _two_sum(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    s = a + b
    t = s - a
    return s, (a - (s - t)) + (b - t)


class DoubleDouble:
    """A matrix that grows by matrices; high + low is its sum to about 106 bits."""

    def __init__(self, shape: tuple[int, ...]):
        self.high, self.low = np.zeros(shape), np.zeros(shape)

    def add(self, high: np.ndarray, low: np.ndarray | float = 0.0) -> None:
        s, e = _two_sum(self.high, high)
        self.high, self.low = _two_sum(s, e + self.low + low)


def slices(high: np.ndarray, low: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Three matrices of integers of SLICE - 1 bits and a sign, and the unit of each column: high + low is unit * (a + b / 2^SLICE + c / 4^SLICE) but for what lies below."""
    _, exponent = np.frexp(np.abs(high).max(axis=0))
    unit = np.ldexp(1.0, exponent - SLICE + 1)
    parts, rest = [], high / unit
    for k in range(3):
        if k == 2:
            rest = rest + low / unit * 4.0**SLICE
        part = np.rint(rest)
        parts.append(part)
        rest = (rest - part) * 2.0**SLICE
    return parts, unit


def add_outer(total: DoubleDouble, high: np.ndarray, low: np.ndarray) -> None:
    """Add the sum of the outer products of the rows of high + low."""
    for at in range(0, len(high), ROWS):
        (a, b, c), unit = slices(high[at : at + ROWS], low[at : at + ROWS])
        scale = unit[:, None] * unit
        ab, ac = a.T @ b, a.T @ c
        for part, power in ((a.T @ a, 0), (ab, 1), (ab.T, 1), (b.T @ b, 2), (ac, 2), (ac.T, 2)):
            total.add(part * scale * 2.0 ** (-SLICE * power))


def _merged(parts: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Row i of the sum of matrices whose rows (i, high, low) lie in any number of tasks: each row is added up by one task, part by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, DoubleDouble] = {}
        for b in batches:
            for i, high, low in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                own = np.array(high.as_py())
                total.setdefault(i, DoubleDouble(own.shape)).add(own, np.array(low.as_py()))
        for i, v in total.items():
            yield _matrix([i], v.high[None], v.low[None])

    rows = parts.repartition("i").mapInArrow(tidy(run), parts.schema).collect()
    return {r.i: (np.array(r.high), np.array(r.low)) for r in rows}


_MATRIX = "i int, high array<double>, low array<double>"


def _matrix(index, high: np.ndarray, low: np.ndarray) -> pa.RecordBatch:
    rows = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)), pa.array(m.ravel()))
    return pa.RecordBatch.from_arrays([pa.array(index, pa.int32()), rows(high), rows(low)], names=["i", "high", "low"])


def totals(vectors: DataFrame, quantiser: Quantiser) -> tuple[int, int, tuple[int, ...]]:
    """(n, size, exact sums of the quantised entries) of the vectors of the most common length, of equals the longer; n is 0 without vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for b in batches:
            for at, c in dense(b.column(0)):
                x = quantiser(c)
                own = found.setdefault(c.shape[1], [0, 0, 0])
                own[0] += len(at)
                own[1] += (x >> 26).sum(axis=0)  # halves, so that sums of any number of entries fit 64 bits
                own[2] += (x & ((1 << 26) - 1)).sum(axis=0)
        for size, (n, high, low) in found.items():
            arrays = [np.full(size, size), np.arange(size), np.full(size, n), high, low]
            yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int64)) for a in arrays], names=["size", "pos", "n", "high", "low"])

    parts = vectors.select("embedding").mapInArrow(tidy(run), "size long, pos long, n long, high long, low long")
    summed = parts.groupBy("size", "pos").agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low"))
    whole = summed.groupBy("size").agg(F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "high", "low"))).alias("sums"))
    found = whole.orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    if not found:
        return 0, 0, ()
    return found[0].n, found[0].size, tuple((r.high << 26) + r.low for r in found[0].sums)


def covariance(vectors: DataFrame, n: int, sums: tuple[int, ...], quantiser: Quantiser) -> tuple[np.ndarray, np.ndarray]:
    """(high, low) of the sum of centred outer products."""
    mean = [Fraction(s, n) for s in sums]
    near = np.array([float(m) for m in mean])
    rest = np.array([float(m - Fraction(float(m))) for m in mean])
    size = len(sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = DoubleDouble((size, size))
        for b in batches:
            for _, c in dense(b.column(0), size):
                high, low = _two_sum(quantiser(c).astype(float), -near)
                add_outer(total, *_two_sum(high, low - rest))
        if total.high.any():
            yield _matrix(np.arange(size), total.high, total.low)

    rows = _merged(vectors.select("embedding").mapInArrow(tidy(run), _MATRIX))
    none = (np.zeros(size), np.zeros(size))
    high, low = (np.stack([rows.get(i, none)[k] for i in range(size)]) for k in (0, 1))
    return high, low


def eigen(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns; the first entry of largest magnitude is positive) of the symmetric matrix high + low."""
    a = high.astype(np.longdouble) + low
    a = (a + a.T) / 2
    values, v = np.linalg.eigh(a.astype(float))
    v = v.astype(np.longdouble)
    off = np.eye(len(a)) - v.T @ v
    s = v.T @ a @ v
    values = np.diag(s) / (1 - np.diag(off))
    gap = values[None, :] - values[:, None]
    close = np.abs(gap) <= 2 * (np.abs(s - np.diag(values)).max() + np.abs(values).max(initial=0) * np.abs(off).max(initial=0))
    step = np.where(close, off / 2, (s + values[None, :] * off) / np.where(close, 1, gap))
    v = v + v @ step
    v /= np.sqrt((v * v).sum(axis=0))
    order = np.argsort(-values, kind="stable")
    values, v = values[order].astype(float), v[:, order].astype(float)
    lead = np.abs(v).round(12).argmax(axis=0)
    return values, v * np.where(v[lead, np.arange(len(a))] < 0, -1.0, 1.0)


def fit(vectors: DataFrame, quantiser: Quantiser = Quantiser()) -> Whitening | None:  # noqa: B008
    """The whitening of all vectors of the most common length; None if there is none."""
    vectors = only_columns(vectors, "embedding")
    n, size, sums = totals(vectors, quantiser)
    if not n:
        return None
    high, low = covariance(vectors, n, sums, quantiser)
    values, found = eigen(high, low)
    return Whitening(n, size, sums, values / n, found, float((np.diag(high).astype(np.longdouble) + np.diag(low)).sum() / n), quantiser)


def identity_error(vectors: DataFrame, model: Whitening, k: int) -> float:
    """Largest absolute entry of the covariance of the first ``k`` whitened components minus the identity; components without variance are left out."""
    use = np.flatnonzero(~model.flat[:k])
    if not len(use):
        return 0.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = DoubleDouble((len(use) + 1, len(use) + 1))
        for b in batches:
            for _, c in dense(b.column(0), model.size):
                w = model.project(model.centred(model.quantiser(c)), k)[:, use]
                w = np.column_stack([w, np.ones(len(w))])  # the last row sums the components, whose mean is zero but for rounding
                add_outer(total, w, np.zeros_like(w))
        if total.high.any():
            yield _matrix(np.arange(len(use) + 1), total.high, total.low)

    rows = _merged(vectors.select("embedding").mapInArrow(tidy(run), _MATRIX))
    second = np.stack([rows[i][0] + rows[i][1] for i in range(len(use) + 1)]) / model.n
    mean = second[-1, :-1]
    return float(np.abs(second[:-1, :-1] - np.outer(mean, mean) - np.eye(len(use))).max())


def whiten(vectors: DataFrame, components: int = 8, quantiser: Quantiser = Quantiser()) -> DataFrame:  # noqa: B008
    """One row per vector and component, up to ``components``: vec_id, component, n, deviation, whitened, explained, identity_error, eigenvalue.

    Vectors that are null, empty, or hold null or non-finite entries are dropped, and so are those that have not the most common length (of equals the longer).
    Repeated rows are rows of their own, and a null vec_id is a value like others. Without any vector the result is empty. A component without variance has
    whitened 0 and does not count for identity_error; of eigenvalues that tie any basis may come out, the same for all rows. deviation is the exact
    sum of (n * x - S)^2, or null where that does not fit a long. Columns besides vec_id and embedding are not looked at, whatever they are called.
    """
    vectors = only_columns(vectors, "vec_id", "embedding")
    kind = dict(vectors.dtypes)["vec_id"]
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, eigenvalue double"
    model = fit(vectors, quantiser)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    k = min(components, model.size)
    error = identity_error(vectors, model, k)
    explained = model.values[:k] / model.trace if model.trace > 0 else np.zeros(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, c in dense(b.column(1), model.size):
                m = model.centred(model.quantiser(c))
                near = (m.astype(float) ** 2).sum(axis=1)
                if m.dtype != object and near.max() < 9.2e18:
                    deviation = pa.array(np.repeat((m * m).sum(axis=1), k))
                else:  # exact, row by row
                    own = [s if (s := sum(int(v) ** 2 for v in row)) < 1 << 63 else None for row in m.tolist()]
                    deviation = pa.array([s for s in own for _ in range(k)], pa.int64())
                rows = len(at)
                tiled = lambda v, t=None, r=rows: pa.array(np.tile(v, r), t)
                out = [b.column(0).take(pa.array(np.repeat(at, k))), tiled(np.arange(1, k + 1), pa.int32()), pa.array(np.full(rows * k, model.n, np.int64)), deviation, pa.array(model.project(m, k).ravel()), tiled(explained), pa.array(np.full(rows * k, error)), tiled(model.values[:k])]
                yield pa.RecordBatch.from_arrays(out, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "eigenvalue"])

    return vectors.mapInArrow(tidy(run), schema)
