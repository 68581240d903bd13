"""Whitening of embeddings by shifted CholeskyQR.

The distinct vectors are the rows of a tall matrix. Its centred rows are made orthonormal in repeated passes: the tasks sum the Gram matrix of their
rows, the driver takes its Cholesky factor, and the next pass solves each row for the factors so far before it
multiplies. The first factor is that of the Gram matrix plus a small multiple of the identity, so it exists for any data; what the shift and
the condition of the data leave over, the next passes see in their Gram matrix and remove. The product R of the factors has the
singular values and right vectors of the whole matrix, so an SVD of this small matrix gives the principal components
with the precision of a QR decomposition, which an eigenvalue problem of the first Gram matrix does not have.

The driver holds matrices of dimensions x dimensions only; rows stay in the tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areacast.llm import numbers
from areacast.sources.tables import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Whole numbers that a double holds exactly.
LIMIT = 1 << 53
PASSES = 12
_UNIT = float(np.finfo(np.float64).eps) / 2
# A Gram matrix this near to a projection is that of rows that are orthonormal on what they span.
_DONE = 1e-11
# Singular values below this share of the largest one are rounding, not a direction of the data.
_RANK = 1e-10


@dataclass(frozen=True)
class Whitening:
    """What the fit leaves: a model of dimensions x components."""

    n: int
    sums: tuple[int, ...]
    axes: np.ndarray  # dimensions x components, unit columns
    values: np.ndarray  # variances along the components, falling
    trace: float
    identity_error: float | None = None

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def whitened(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.mean) @ self.axes / np.sqrt(self.values)

    def deviations(self, rows: np.ndarray) -> list[int | None]:
        """Sums over the dimensions of (n * x - S)^2, exactly; None where a long cannot hold it."""
        if not len(rows):
            return []
        most = self.n * int(max(abs(int(rows.min())), abs(int(rows.max())))) + max(map(abs, self.sums))
        kind = np.int64 if len(self.sums) * most * most <= numbers.LONG_MAX else object
        apart = rows.astype(kind) * self.n - np.array(self.sums, kind)
        return [numbers.long_or_none(int(v)) for v in (apart * apart).sum(axis=1)]


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Rows q with q @ factor = row, for an upper triangular factor: forward substitution, all rows at once."""
    out = np.array(rows, order="F")
    for i in range(len(factor)):
        if i:
            out[:, i] -= out[:, :i] @ factor[:i, i]
        out[:, i] /= factor[i, i]
    return out


def _sums(fit: DataFrame, dims: int) -> tuple[int, tuple[int, ...]]:
    """Number of rows, and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * (dims + 1)
        for batch in batches:
            rows = numbers.matrix(batch.column(0), dims)
            totals = [a + b for a, b in zip(totals, [*numbers.column_sums(rows), len(rows)])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims + 1), pa.int32()), numbers.decimals(totals)], ["place", "total"]
        )

    found = numbers.summed(fit.mapInArrow(run, f"place int, total {numbers.EXACT}"), ["place"])
    return int(found[(dims,)]), tuple(int(found[(i,)]) for i in range(dims))


def _gram(fit: DataFrame, dims: int, size: int, turned) -> np.ndarray:
    """The sum over all rows x of the products of ``turned(x)``, ``size`` numbers, with itself."""
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            q = turned(numbers.matrix(batch.column(0), dims).astype(np.float64))
            total += q.T @ q
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(upper[0])), pa.int32()), pa.array(total[upper])], ["place", "total"]
        )

    found = numbers.summed(fit.mapInArrow(run, "place int, total double"), ["place"])
    gram = np.zeros((size, size))
    gram[upper] = [found[(i,)] for i in range(len(upper[0]))]
    return gram + np.triu(gram, 1).T


def orthogonalised(gram_of, n: int, dims: int) -> list[np.ndarray]:
    """The triangular factors of the passes: rows solved for them one after the other are orthonormal.

    ``gram_of(factors)`` is the Gram matrix of the rows solved for the factors so far.
    """
    factors: list[np.ndarray] = []
    while len(factors) < PASSES:
        gram = gram_of(factors)
        norm = float(np.linalg.norm(gram, 2))
        if norm == 0 or factors and np.abs(gram @ gram - gram).max() <= _DONE:
            break
        if not factors:
            # The shift of the first pass; a bound on it keeps it a shift where there are very many rows.
            shift = norm * min(11 * (n * dims + dims * (dims + 1)) * _UNIT, 1e-3)
        else:
            # Later ones need it only where the rows span fewer dimensions.
            flat = np.linalg.eigvalsh(gram)[0] < 0.01 * norm
            shift = norm * 100 * dims * _UNIT if flat else 0.0
        factors.append(np.linalg.cholesky(gram + shift * np.eye(dims)).T)
    return factors


def fitted(fit: DataFrame, dims: int, keep: int) -> Whitening:
    """The whitening of a table of distinct rows x: centring, orthogonalising passes, SVD of R, and its error.

    ``identity_error`` is the largest entry of the whitened rows' covariance minus the identity, measured
    by one more pass. It is 0 where there is no component: one row, or equal rows only.
    """
    n, sums = _sums(fit, dims)
    mean = np.array([s / n for s in sums])

    def gram_of(factors: list[np.ndarray]) -> np.ndarray:
        return _gram(fit, dims, dims, lambda rows: reduce(solved, factors, rows - mean))

    factors = orthogonalised(gram_of, n, dims)
    if not factors:
        return Whitening(n, sums, np.zeros((dims, 0)), np.zeros(0), 0.0, 0.0)
    product = reduce(lambda r, factor: factor @ r, factors)
    _, singular, axes = np.linalg.svd(product)
    real = min(keep, int((singular > _RANK * singular[0]).sum()))
    model = Whitening(
        n, sums, axes[:real].T.copy(), singular[:real] ** 2 / n, float((singular**2).sum()) / n
    )

    def with_one(rows: np.ndarray) -> np.ndarray:
        return np.column_stack([model.whitened(rows), np.ones(len(rows))])

    moments = _gram(fit, dims, real + 1, with_one) / n
    covariance = moments[:-1, :-1] - np.outer(moments[-1, :-1], moments[-1, :-1])
    error = float(np.abs(covariance - np.eye(real)).max())
    return Whitening(model.n, model.sums, model.axes, model.values, model.trace, error)


def whiten(
    vectors: DataFrame, id_column: str, vector: str = "embedding", scale: int = 256, keep: int = 4
) -> DataFrame:
    """(id, n, deviation, whitened, explained, identity_error) of each vector.

    An entry c becomes the whole number x = floor(scale * c). Each distinct x vector counts once in the fit: n of them, with sums
    S. ``whitened`` has one number per component, up to ``keep`` by falling variance: (x - S/n) along the unit component over its
    standard deviation. ``deviation`` is the sum of (n * x - S)^2 over the dimensions, null where a long cannot hold it; ``explained`` the
    components' shares of the variance. The sign of a component is any, the same for all rows.

    Dropped are vectors that are null or empty, or hold null or non-finite entries or some beyond 2^53 / scale. Vectors of different
    lengths are fits of their own. Data of fewer directions than ``keep`` have fewer components, down to none. Repeated rows and ids
    are rows of their own. An empty table gives no rows.
    """
    x = numbers.whole(F.col(vector), scale, LIMIT)
    parsed = vectors.where(F.size(vector) > 0).select(F.col(id_column).cast("bigint").alias("id"), x.alias("x"))
    parsed = parsed.where("x is not null")
    fit = written(parsed.select("x").distinct().withColumn("dims", F.size("x")), "distinct_vectors")
    out = None
    # Lengths, not vectors: one or a few.
    for dims in sorted(r["dims"] for r in fit.select("dims").distinct().collect()):
        model = fitted(fit.where(F.col("dims") == dims).select("x"), dims, keep)
        found = _applied(parsed.where(F.size("x") == dims), dims, model)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = parsed.sparkSession.createDataFrame([], _OUT)
    return out.withColumnRenamed("id", id_column)


_OUT = "id bigint, n bigint, deviation bigint, whitened array<double>, explained array<double>, identity_error double"


def _applied(parsed: DataFrame, dims: int, model: Whitening) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = numbers.matrix(batch.column("x"), dims)
            flat = pa.array(model.whitened(rows.astype(np.float64)).ravel())
            ends = pa.array(np.arange(len(rows) + 1) * len(model.values), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(model.deviations(rows), pa.int64()),
                 pa.ListArray.from_arrays(ends, flat)],
                ["id", "deviation", "whitened"],
            )

    turned = parsed.mapInArrow(run, "id bigint, deviation bigint, whitened array<double>")
    shares = F.array(*[F.lit(float(v) / model.trace) for v in model.values])
    return turned.select(
        "id", F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        shares.cast("array<double>").alias("explained"),
        F.lit(model.identity_error).cast("double").alias("identity_error"),
    )
