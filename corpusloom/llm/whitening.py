"""Whitening of embeddings: Welford's updates in partition iterators, merged by the parallel formula, then symmetric QR.

The entries c of a vector become whole numbers x = floor(64 c) + 1000000. One pass streams each partition: every vector is a
rank-one update of the count, the means and the centred products (Welford), and the sums of x are kept as whole numbers.
A partition yields one row of them. Rows are merged by the parallel formula, FAN of them at a time in tasks until FAN or
fewer are left, which the driver merges; their size is that of a matrix of the dimension, whatever the number of vectors.
The matrix is made tridiagonal by Householder's reflections and solved by implicit QR steps with Wilkinson's shifts.
Components are kept by falling eigenvalue. A second pass takes the whitened vectors' covariance the same way, which is
measured against the identity, and a third gives the result. Nothing is shuffled by a key.

Defined cases: a vector that is null, or holds a null or an entry that isn't finite, is dropped, and so is one with an entry beyond
2^46, whose x couldn't be exact; of several dimensions the most frequent counts, of ties the larger, and other vectors are
dropped; repeated rows count as often as they stand; a null vec_id is kept; components whose eigenvalue is below RANK of the
largest have no unit variance to be scaled to, and are left out, so a single vector, or equal ones, or none, give no rows;
deviations are exact whole numbers of up to 38 digits, null beyond; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import batches_of, bounded_batches, durable, table

#: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Components that are kept at most, and the share of the largest eigenvalue below which one has no variance.
COMPONENTS, RANK = 32, 1e-12
#: Rows of moments that a task or the driver merges at once.
FAN = 32
#: Entries are within this many, so that x and its differences are exact in doubles.
LARGEST = 2.0**46
_MOMENTS = "n bigint, sums array<bigint>, mean array<double>, products array<double>"


@dataclass
class Moments:
    """Count, exact sums, means and centred products of vectors, which are shifted by ``origin`` for the last two."""

    n: int
    sums: list[int]
    mean: np.ndarray
    products: np.ndarray

    @classmethod
    def empty(cls, dims: int) -> Moments:
        return cls(0, [0] * dims, np.zeros(dims), np.zeros((dims, dims)))

    def add(self, vectors: np.ndarray) -> None:
        """Welford's rank-one update for each row."""
        mean, products = self.mean, self.products
        step = np.empty_like(products)
        for v in vectors:
            self.n += 1
            delta = v - mean
            mean += delta / self.n
            np.multiply(delta[:, None], (v - mean)[None, :], out=step)
            products += step

    def merge(self, other: Moments) -> Moments:
        """Both together, by the parallel formula."""
        if not self.n or not other.n:
            return other if other.n else self
        n = self.n + other.n
        delta = other.mean - self.mean
        mean = self.mean + delta * (other.n / n)
        products = self.products + other.products + np.outer(delta, delta) * (self.n * (other.n / n))
        return Moments(n, [a + b for a, b in zip(self.sums, other.sums, strict=True)], mean, products)

    def covariance(self) -> np.ndarray:
        """With divisor n; the two halves, which rounding sets apart, are averaged."""
        return (self.products + self.products.T) / (2 * max(self.n, 1))

    def batch(self) -> pa.RecordBatch:
        columns = [[self.n], [self.sums], [self.mean.tolist()], [self.products.ravel().tolist()]]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64())]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["n", "sums", "mean", "products"])

    @classmethod
    def read(cls, n: int, sums: list[int], mean: list[float], products: list[float]) -> Moments:
        return cls(n, sums, np.array(mean), np.array(products).reshape(len(mean), len(mean)))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite and not too large."""
    wide = vector.cast("array<double>")
    return vector.isNotNull() & F.coalesce(F.forall(wide, lambda c: F.coalesce((F.abs(c) <= LARGEST) & ~F.isnan(c), F.lit(False))), F.lit(False))


def dimension(rows: DataFrame) -> int:
    """The most frequent number of entries of ``rows`` (vector), the larger of ties; 0 without rows."""
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
    found = sizes.agg(F.max(F.struct("n", "d")).alias("most")).first()["most"]
    return found["d"] if found else 0


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Entries of an array column as doubles, a row a vector."""
    return column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)


def whole(vectors: np.ndarray) -> np.ndarray:
    """x of each entry, exact."""
    return np.floor(SCALE * vectors).astype(np.int64) + SHIFT


def moments(rows: DataFrame, dims: int, values: Callable[[pa.Array], tuple[np.ndarray, np.ndarray | None]]) -> Moments:
    """The moments of what ``values`` makes of the first column of ``rows``: numbers to take up, and whole ones to sum."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Moments.empty(dims)
        for batch in batches_of(batches):
            vectors, exact = values(batch.column(0))
            held.add(vectors)
            if exact is not None:
                held.sums = [a + int(b) for a, b in zip(held.sums, exact.sum(axis=0), strict=True)]
        if held.n:
            yield held.batch()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Moments.empty(dims)
        for batch in batches_of(batches):
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held = held.merge(Moments.read(*row))
        if held.n:
            yield held.batch()

    bounded_batches(rows.sparkSession)
    made = durable(rows.mapInArrow(stream, _MOMENTS))
    while (parts := made.count()) > FAN:  # a row a partition at most
        made = durable(made.coalesce(math.ceil(parts / FAN)).mapInArrow(merged, _MOMENTS))
    total = Moments.empty(dims)
    for row in made.collect():  # FAN rows at most
        total = total.merge(Moments.read(*row))
    return total


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, subdiagonal and Q of a symmetric matrix, which is Q T Q', by Householder's reflections."""
    a, n = matrix.astype(np.float64).copy(), len(matrix)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1 :, k]
        size = np.linalg.norm(x)
        if not size:
            continue
        v = x.copy()
        v[0] += math.copysign(size, x[0])
        v /= np.linalg.norm(v)
        a[k + 1 :, k:] -= 2 * np.outer(v, v @ a[k + 1 :, k:])
        a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def symmetric_qr(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and their unit eigenvectors as columns: implicit QR steps with Wilkinson's shifts."""
    d, e, q = tridiagonal(matrix)
    q = np.ascontiguousarray(q.T)  # a row a vector, so that a rotation takes two rows
    high = len(d) - 1
    tiny = np.finfo(np.float64).eps
    least = tiny * tiny * (np.abs(d).max(initial=0.0) + np.abs(e).max(initial=0.0))
    steps = 0
    while high > 0:
        for i in range(high):
            if abs(e[i]) <= max(tiny * (abs(d[i]) + abs(d[i + 1])), least):
                e[i] = 0.0
        if not e[high - 1]:
            high -= 1
            continue
        if (steps := steps + 1) > 60 * len(d):
            raise ArithmeticError("the eigenvalues don't converge: the matrix holds entries that aren't finite")
        low = high - 1
        while low > 0 and e[low - 1]:
            low -= 1
        half, off = (d[high - 1] - d[high]) / 2, e[high - 1]
        shift = d[high] - off * off / (half + math.copysign(math.hypot(half, off), half))
        x, z = d[low] - shift, e[low]
        for k in range(low, high):
            r = math.hypot(x, z)
            c, s = (x / r, z / r) if r else (1.0, 0.0)
            if k > low:
                e[k - 1] = r
            a, b, f = d[k], d[k + 1], e[k]
            d[k] = c * c * a + 2 * c * s * f + s * s * b
            d[k + 1] = s * s * a - 2 * c * s * f + c * c * b
            e[k] = c * s * (b - a) + (c * c - s * s) * f
            if k + 1 < high:
                x, z = e[k], s * e[k + 1]
                e[k + 1] *= c
            upper = c * q[k] + s * q[k + 1]
            q[k + 1] = c * q[k + 1] - s * q[k]
            q[k] = upper
    order = np.argsort(-d, kind="stable")
    return d[order], q[order].T


@dataclass
class Whitening:
    """n and exact sums of x over the fit list, eigenvalues and unit eigenvectors (columns) that are kept, and the trace."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of whole vectors."""
        centred = (x - self.sums // self.n) - (self.sums % self.n) / self.n
        return centred @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int]:
        """The sum over dimensions of (n x - S)^2, exact."""
        moved = x - self.sums // self.n  # whole, and as small as the spread
        rest = (self.sums % self.n).tolist()
        bound = int(np.abs(moved).max(initial=0) + 1) * self.n
        if bound * bound * max(x.shape[1], 1) < 2**63:
            return ((moved * self.n - np.array(rest, dtype=np.int64)) ** 2).sum(axis=1).tolist()
        return [sum((a * self.n - b) ** 2 for a, b in zip(row, rest, strict=True)) for row in moved.tolist()]


def fit(rows: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """The whitening of ``rows`` (vector: usable ones of ``dims`` entries)."""

    def values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        x = whole(_matrix(column, dims))
        return (x - SHIFT).astype(np.float64), x

    total = moments(rows, dims, values)
    covariance = total.covariance()
    found, vectors = symmetric_qr(covariance)
    kept = [i for i in range(min(components, dims)) if found[i] > RANK * max(found[0], 0) and found[i] > 0]
    return Whitening(total.n, np.array(total.sums, dtype=np.int64), found[kept], vectors[:, kept], float(np.trace(covariance)))


def identity_error(rows: DataFrame, dims: int, model: Whitening) -> float:
    """The largest absolute entry of the whitened vectors' covariance over ``rows``, minus the identity."""
    kept = len(model.values)
    spread = moments(rows, kept, lambda column: (model.project(whole(_matrix(column, dims))), None)).covariance()
    return float(np.abs(spread - np.eye(kept)).max(initial=0.0))


def whitened_components(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of each usable row and component of ``rows``."""
    schema = "key bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    kept = rows.select(F.col(vector).alias("vector"), F.col(key).cast("bigint").alias("key")).filter(usable(F.col("vector")))
    dims = dimension(kept)
    kept = kept.filter(F.size("vector") == dims)
    model = fit(kept, dims, components) if dims else Whitening(0, np.zeros(0), np.zeros(0), np.zeros((0, 0)), 0.0)
    many = len(model.values)
    if not many:
        return rows.sparkSession.createDataFrame([], schema).withColumnRenamed("key", key)
    error = identity_error(kept, dims, model)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches_of(batches):
            for at in range(0, big.num_rows, 1024):  # each row becomes as many as there are components
                batch = big.slice(at, 1024)
                x = whole(_matrix(batch.column(0), dims))
                rows_, each = len(x), np.repeat(np.arange(len(x)), many)
                exact = [Decimal(v) if v < 10**38 else None for v in model.deviations(x)]
                columns = [
                    batch.column(1).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), rows_)),
                    pa.array(np.full(rows_ * many, model.n)),
                    pa.array(exact, pa.decimal128(38, 0)).take(pa.array(each)),
                    pa.array(model.project(x).ravel()),
                    pa.array(np.tile(model.values / model.trace, rows_)),
                    pa.array(np.full(rows_ * many, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    bounded_batches(rows.sparkSession)
    return kept.mapInArrow(run, schema).withColumnRenamed("key", key)


def op12_whitening_welford_qr(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitened_components(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("bigint"))
