"""Whitening of vectors by shifted CholeskyQR.

The rows A of centred vectors are orthogonalised by passes over the data: each pass sums the Gram matrix of A R⁻¹ (a triangular
solve per row), takes its Cholesky factor and composes it with R. The first Gram matrix is shifted, so that its factor exists
however ill-conditioned A is; the passes after it bring R to the R of a QR decomposition of A, in which small components are
not lost as they are in the covariance itself. Singular values and right vectors of R are those of A: components and
variances. Only matrices of the vectors' width reach the driver; partial sums are added up in levels.

Entries become whole numbers, ``floor(scale * entry) + offset``, so sums and distances from the mean are exact.

Defined cases: null vectors and vectors with a null or non-finite entry are left out; so are empty vectors and those of another
length than most (of equally frequent lengths the longest counts); repeated rows count and appear as often as they occur; a
component without variance (a constant dimension, fewer rows than dimensions) has a null ``whitened`` and an ``explained`` of
0; if all rows are equal, ``explained`` and ``identity_error`` are null; ``deviation`` is null where it does not fit 64 bits;
no usable rows give an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage_table

#: Passes after the shifted one. Two are enough up to a condition of 1e15; more end at once when nothing changes any more.
PASSES = 6
#: Partial sums that one task of an adding level reads.
FAN_IN = 64


@dataclass
class Whitening:
    """What is fitted: n, sums, the unit components that have a variance (columns), all variances and their sum."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def dimensions(self) -> int:
        return len(self.sums)

    @property
    def mean(self) -> np.ndarray:
        return np.array([int(s) / self.n for s in self.sums])

    @property
    def rank(self) -> int:
        """Components with a variance above rounding."""
        return self.components.shape[1]


def whole_numbers(
    vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 1024, offset: int = 100000
) -> DataFrame:
    """``id`` and ``x`` (array of long) of the usable vectors, staged."""
    rows = vectors.select(vectors[id_column].alias("id"), vectors[vector_column].cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(finite, F.lit(False)))
    made = rows.select("id", F.transform("v", lambda c: F.floor(c * scale).cast("long") + offset).alias("x"))
    made = stage_table(made, "whole-vectors")
    lengths = made.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return made.where(F.size("x") == lengths["d"]) if lengths else made


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], kind: type) -> np.ndarray | None:
    """Sum of ``part(matrix)`` over all batches: one row per task, then fewer and fewer, until the driver adds the last ones."""
    schema, arrow = ("p array<long>", pa.int64()) if kind is int else ("p array<double>", pa.float64())

    def packed(total: np.ndarray | None) -> Iterator[pa.RecordBatch]:
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(arrow))], names=["p"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                made = part(_matrix(batch))
                total = made if total is None else total + made
        yield from packed(total)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                made = _matrix(batch, "p").sum(axis=0)
                total = made if total is None else total + made
        yield from packed(total)

    sums = rows.select("x").mapInArrow(first, schema)
    tasks = rows.rdd.getNumPartitions()
    while tasks > FAN_IN:
        tasks = -(-tasks // FAN_IN)
        sums = sums.repartition(tasks).mapInArrow(again, schema)
    parts = [np.array(row["p"]) for row in sums.collect()]
    return sum(parts[1:], parts[0]) if parts else None


def _gram(x: DataFrame, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Gram matrix of the centred rows times ``basis``."""
    d = basis.shape[1]
    gram = _summed(x, lambda m: (q := (m - mean) @ basis).T @ q, float)
    return gram.reshape(d, d)


def fit(x: DataFrame) -> Whitening | None:
    """Components of the rows of :func:`whole_numbers`; None if there are none."""
    totals = _summed(x, lambda m: np.append(m.sum(axis=0), len(m)), int)
    if totals is None:
        return None
    n, sums = int(totals[-1]), totals[:-1]
    d, eps = len(sums), np.finfo(float).eps
    mean = np.array([int(s) / n for s in sums])
    gram = _gram(x, mean, np.eye(d))
    if not np.trace(gram) > 0:
        return Whitening(n, sums, np.zeros((d, 0)), np.zeros(d), 0.0)
    shift = 11 * (n * d + d * (d + 1)) * eps * np.linalg.norm(gram, 2)
    r = np.linalg.cholesky(gram + shift * np.eye(d)).T
    basis = np.linalg.solve(r, np.eye(d))  # A @ basis is (nearly) orthonormal, and A = A @ basis @ r
    for turn in range(PASSES):
        gram = _gram(x, mean, basis)
        sizes, axes = np.linalg.eigh(gram)
        lasting = sizes > 16 * d * eps
        if turn == 0 and not lasting.all():
            # Directions without variance: only the shift gave them a length. The rest goes on without them.
            r = np.sqrt(sizes[lasting])[:, None] * axes[:, lasting].T @ r
            basis = basis @ (axes[:, lasting] / np.sqrt(sizes[lasting]))
            continue
        factor = np.linalg.cholesky(gram).T
        r, basis = factor @ r, np.linalg.solve(factor.T, basis.T).T
        if np.abs(gram - np.eye(len(gram))).max() < 64 * d * eps:
            break
    _, sizes, turned = np.linalg.svd(r, full_matrices=False)
    variances = np.zeros(d)
    variances[: len(sizes)] = sizes**2 / n
    return Whitening(n, sums, turned.T.copy(), variances, float(variances.sum()))


def _projection(found: Whitening, count: int) -> np.ndarray:
    return found.components[:, :count] / np.sqrt(found.variances[:count])


def identity_error(x: DataFrame, found: Whitening, count: int) -> float | None:
    """Largest absolute entry of the covariance of the whitened rows minus the identity."""
    count = min(count, found.rank)
    if not count:
        return None
    mean, projection = found.mean, _projection(found, count)
    middle = _summed(x, lambda m: ((m - mean) @ projection).sum(axis=0), float) / found.n
    covariance = _summed(x, lambda m: (w := (m - mean) @ projection - middle).T @ w, float).reshape(count, count) / found.n
    return float(np.abs(covariance - np.eye(count)).max())


def whiten(
    vectors: DataFrame, count: int = 8, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 1024, offset: int = 100000
) -> DataFrame:
    """``id_column``, component, n, deviation, whitened, explained and identity_error of every usable row and component."""
    x = whole_numbers(vectors, id_column, vector_column, scale, offset)
    found = fit(x)
    kind = x.schema["id"].dataType.simpleString()
    schema = f"`{id_column}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if found is None:
        return x.sparkSession.createDataFrame([], schema)
    kept, full, error = min(count, found.dimensions), min(count, found.rank), identity_error(x, found, count)
    mean, projection = found.mean, _projection(found, full)
    explained = [float(v / found.trace) if found.trace > 0 else None for v in found.variances[:kept]]
    n, sums = found.n, found.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, rows = _matrix(batch), batch.num_rows
            if not rows:
                continue
            # 64 bits where they are proven to be enough, else whole numbers of any size.
            wide = float(n) * np.abs(m).max() < 2**62
            far = n * m - sums if wide else np.array(m, dtype=object) * n - sums.astype(object)
            if wide and float(np.abs(far).max()) ** 2 * m.shape[1] < 2**62:
                deviation = (far * far).sum(axis=1).tolist()
            else:
                exact = [sum(int(v) ** 2 for v in row) for row in far]
                deviation = [v if v < 2**63 else None for v in exact]
            whitened = np.full((rows, kept), np.nan)
            whitened[:, :full] = (m - mean) @ projection
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(pa.array(np.repeat(np.arange(rows), kept))),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * kept, n, np.int64)),
                    pa.array([v for v in deviation for _ in range(kept)], pa.int64()),
                    pa.array(whitened.ravel(), mask=np.tile(np.arange(kept) >= full, rows)),
                    pa.array(explained * rows, pa.float64()),
                    pa.array([error] * (rows * kept), pa.float64()),
                ],
                names=[id_column, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return x.select("id", "x").mapInArrow(run, schema)
