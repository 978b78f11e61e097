"""Whitened vectors: principal components of unit variance, found by contour integration.

Components become whole numbers x = floor(64 c) + 1000000; the covariance is that of the distinct vectors. It is
gathered in one pass of whole numbers: each task adds up products of vectors less the rounded mean, which is what
centring before multiplying asks for, without rounding; the fraction that is left of the mean is taken off afterwards.
So the result does not depend on how rows are dealt to tasks, and the driver gets a matrix of the dimensions' size, never rows.

Its largest eigenvalues are found by FEAST. Intervals that hold a few each are laid by bisection on *inertia counts*:
the number of eigenvalues above a shift, the signs of the pivots of the shifted matrix. For each interval a circle is
drawn through its ends; Gauss-Legendre quadrature of complex shifted solves along it projects a block of vectors onto
the interval's eigenvectors, Rayleigh-Ritz takes them out, and both are repeated until the residuals stop falling. The
number that is found must equal the inertia count; if it does not, the block grows and the interval is done again.

Rows whose vector is null, or holds a null, not a number or an infinite entry, are left out, and so are those whose
length is not the most frequent one (the longer of equally frequent ones) and those with an entry that has no place in
a long. Where entries are so far apart that sums of products would not fit a long, they are gathered as doubles.
Components without variance can't be whitened and are left out. ``deviation`` is null where it does not fit a long. Repeated rows count once in the covariance and each get their rows; a null vec_id stays null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoferry.llm.common import Scratch

#: Fixed values of the contract.
SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Eigenvalues of an interval, quadrature nodes of a half circle, and rounds at most.
PER_INTERVAL, NODES, ROUNDS = 8, 8, 30
#: Eigenvalues closer than this part of the largest are taken together.
CLOSE = 1e-9
#: Beyond this, sums of squares might not fit; entries are kept to what a long holds.
_FITS = float(1 << 62)


def whole_numbers(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """vec_id and the whole numbers of each vector that can be used."""
    value = F.col(f"`{vector}`").cast("array<double>")
    usable = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < _FITS / SCALE)
    return rows.select(F.col(f"`{key}`").alias("vec_id"), value.alias("v")).where((F.size("v") > 0) & F.forall("v", usable)).select(
        "vec_id", F.transform("v", lambda c: F.floor(F.lit(float(SCALE)) * c) + OFFSET).alias("x")
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


@dataclass
class Moments:
    """Number of vectors, exact sums, and the covariance with divisor n."""

    n: int
    sums: list[int]
    covariance: np.ndarray

    @property
    def mean(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as a whole number and the fraction that is left, each exact to a double."""
        whole = [(2 * s + self.n) // (2 * self.n) for s in self.sums]
        return np.array(whole, np.int64), np.array([(s - w * self.n) / self.n for s, w in zip(self.sums, whole)])


def gathered(products, frame: DataFrame, d: int) -> np.ndarray:
    """The sum over all tasks of a symmetric matrix that each makes of its vectors."""

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = products(_matrix(batch.column(0)))
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(list(total), pa.list_(pa.from_numpy_dtype(total.dtype)))], names=["row", "values"])

    kind = "double" if products(np.zeros((1, d), np.int64)).dtype == np.float64 else "long"
    each = frame.select("x").mapInArrow(add_up, f"row long, values array<{kind}>")
    summed = each.select("row", F.posexplode("values").alias("column", "value")).groupBy("row", "column").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros((d, d), np.float64 if kind == "double" else np.int64)
    out[summed.column("row").to_numpy(), summed.column("column").to_numpy()] = summed.column("value").to_numpy()
    return out


def moments(fit: DataFrame, d: int) -> Moments:
    """Of the vectors of a written table, one row each."""
    each = fit.select(F.posexplode("x").alias("at", "value")).groupBy("at")
    found = each.agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("total"), F.min("value").alias("low"), F.max("value").alias("high")).orderBy("at").collect()
    result = Moments(found[0].n, [int(row.total) for row in found], np.zeros((d, d)))
    whole, rest = result.mean
    span = float(max(max(row.high - w, w - row.low) for row, w in zip(found, whole.tolist())))

    def exact(x: np.ndarray) -> np.ndarray:
        z = x - whole
        if span * span * len(z) < 1 << 53:  # as exact as doubles, and faster
            z = z.astype(np.float64)
        return (z.T @ z).astype(np.int64)

    def rounded(x: np.ndarray) -> np.ndarray:
        z = (x - whole).astype(np.float64) - rest
        return z.T @ z

    if span * span * result.n < _FITS:
        result.covariance = gathered(exact, fit, d) / result.n - np.outer(rest, rest)
    else:  # sums of products might not fit a long
        result.covariance = gathered(rounded, fit, d) / result.n
    return result


# Eigenvalues of a symmetric matrix


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and side diagonal of a similar tridiagonal matrix (Householder)."""
    a = matrix.copy()
    n = len(a)
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        length = np.linalg.norm(v)
        if length == 0:
            continue
        v[0] += np.copysign(length, v[0])
        v /= np.linalg.norm(v)
        block = a[k + 1 :, k + 1 :]
        w = block @ v
        w -= (v @ w) * v
        block -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1 :, k] -= 2 * v * (v @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
    return np.diag(a).copy(), np.diag(a, -1).copy()


class Inertia:
    """How many eigenvalues lie above a shift: the positive pivots of the shifted tridiagonal matrix."""

    def __init__(self, matrix: np.ndarray) -> None:
        self.diagonal, self.side = tridiagonal(matrix)
        around = np.concatenate(([0], np.abs(self.side), [0]))
        self.low = float((self.diagonal - around[:-1] - around[1:]).min())
        self.high = float((self.diagonal + around[:-1] + around[1:]).max())
        self.size = max(abs(self.low), abs(self.high), np.finfo(float).tiny)

    def above(self, shift: float) -> int:
        least = np.finfo(float).eps * self.size * 1e-3
        positive, pivot = 0, 1.0
        squares = np.concatenate(([0.0], self.side**2))
        for a, b2 in zip((self.diagonal - shift).tolist(), squares.tolist()):
            pivot = a - b2 / pivot
            if abs(pivot) < least:
                pivot = -least
            positive += pivot > 0
        return positive

    def shift_with(self, wanted: int) -> float:
        """A shift with ``wanted`` eigenvalues above it, or the next number that has one: eigenvalues that rounding alone
        could tell apart stay together. It is the middle of a gap."""
        for count in range(wanted, len(self.diagonal)):
            low, high = self.low, self.high  # more than wanted above low, fewer above high
            while high - low > CLOSE * self.size:
                middle = (low + high) / 2
                above = self.above(middle)
                if above == count:
                    ends = self._gap(middle, count)
                    if ends[1] - ends[0] > CLOSE * self.size:
                        return sum(ends) / 2
                    break
                low, high = (middle, high) if above > count else (low, middle)
        return self.low - 1e-3 * self.size

    def _gap(self, inside: float, count: int) -> tuple[float, float]:
        """The ends of the gap that the shift lies in."""
        ends = []
        for far in (self.low - 1e-3 * self.size, self.high + 1e-3 * self.size):
            near = inside
            for _ in range(40):
                middle = (near + far) / 2
                near, far = (middle, far) if self.above(middle) == count else (near, middle)
            ends.append(near)
        return ends[0], ends[1]


def projected(matrix: np.ndarray, low: float, high: float, block: np.ndarray) -> np.ndarray:
    """The block's part in the eigenvectors of the interval: quadrature of the resolvent along the circle through its ends."""
    center, radius = (low + high) / 2, (high - low) / 2
    points, weights = np.polynomial.legendre.leggauss(NODES)
    out = np.zeros_like(block)
    unit = np.eye(len(matrix))
    for point, weight in zip(points, weights):
        turn = np.exp(1j * np.pi / 2 * (1 - point))  # the lower half circle is its mirror image
        solved = np.linalg.solve((center + radius * turn) * unit - matrix, block.astype(complex))
        out += weight / 2 * (radius * turn * solved).real
    return out


def interval_pairs(matrix: np.ndarray, low: float, high: float, count: int, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """All eigenvalues in the interval, rising, and their unit vectors; ``count`` is how many inertia says there are."""
    n = len(matrix)
    width = min(n, max(count + 4, int(1.5 * count)))
    while True:
        block = np.random.default_rng(seed).standard_normal((n, width))
        before = np.inf
        for _ in range(ROUNDS):
            basis, strength, _ = np.linalg.svd(projected(matrix, low, high, block), full_matrices=False)
            basis = basis[:, strength > strength[0] * 1e-14]
            values, turns = np.linalg.eigh(basis.T @ matrix @ basis)
            vectors = basis @ turns
            inside = (values > low) & (values < high)
            residual = np.abs(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside]).max(initial=0.0)
            if inside.sum() == count and residual >= before / 2:
                return values[inside], vectors[:, inside]
            before = residual if inside.sum() == count else np.inf
            block = vectors
        if width == n:
            raise ArithmeticError(f"{inside.sum()} of {count} eigenvalues were found between {low} and {high}")
        width = min(n, 2 * width)


def largest_pairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns, the largest entry of each positive."""
    matrix = (matrix + matrix.T) / 2
    inertia = Inertia(matrix)
    wanted = min(wanted, len(matrix))
    high, found = inertia.high + 1e-3 * inertia.size, 0
    values, vectors = [], []
    while found < wanted:
        low = inertia.shift_with(min(len(matrix), found + PER_INTERVAL))
        above = inertia.above(low)
        some, theirs = interval_pairs(matrix, low, high, above - found)
        values.append(some[::-1])
        vectors.append(theirs[:, ::-1])
        high, found = low, above
    values, vectors = np.concatenate(values), np.concatenate(vectors, axis=1)
    vectors *= np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values[:wanted], vectors[:, :wanted]


# Whitened rows

_RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def _projector(found: Moments, values: np.ndarray, vectors: np.ndarray):
    whole, rest = found.mean
    scaled = vectors / np.sqrt(values)
    return lambda x: ((x - whole).astype(np.float64) - rest) @ scaled


def whitened(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable row and component: vec_id, component, n, deviation, whitened, explained and identity_error."""
    spark: SparkSession = rows.sparkSession
    kind = rows.schema[key].dataType.simpleString()
    scratch = Scratch()
    usable = whole_numbers(rows, key, vector)
    # The distinct vectors are made before the common length is known, so that the table is read once for both.
    every = scratch.stage(usable.select("x").distinct(), "vectors")
    lengths = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        scratch.drop(spark)
        return spark.createDataFrame([], f"vec_id {kind}, {_RESULT}")
    d = lengths.d
    fit = every.where(F.size("x") == d)
    found = moments(fit, d)
    trace = float(np.trace(found.covariance))
    if trace == 0:  # one distinct vector
        scratch.drop(spark)
        return spark.createDataFrame([], f"vec_id {kind}, {_RESULT}")
    values, vectors = largest_pairs(found.covariance, components)
    alive = values > values[0] * d * np.finfo(float).eps
    values, vectors = values[alive], vectors[:, alive]
    project = _projector(found, values, vectors)
    k = len(values)

    def seconds(x: np.ndarray) -> np.ndarray:
        w = np.zeros((len(x), d))
        w[:, :k] = project(x)
        return w.T @ w

    # The whitened vectors are centred: they come of vectors less their mean.
    error = float(np.abs(gathered(seconds, fit, d)[:k, :k] / found.n - np.eye(k)).max())
    scratch.drop(spark)
    whole, _ = found.mean
    left = np.array([s - int(w) * found.n for s, w in zip(found.sums, whole)], object)  # S - n * whole
    explained = values / trace

    def project_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            scores = project(x)
            z = x - whole
            far = float(np.abs(z).max(initial=0) + 1) * found.n
            if far * far * d < _FITS:
                deviation = ((z * found.n - left.astype(np.int64)) ** 2).sum(axis=1).tolist()
            else:
                exact = ((z.astype(object) * found.n - left) ** 2).sum(axis=1).tolist()
                deviation = [value if value < 1 << 63 else None for value in exact]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(len(x) * k, found.n)), pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(len(x)), k))),
                 pa.array(scores.ravel()), pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return usable.where(F.size("x") == d).mapInArrow(project_rows, f"vec_id {kind}, {_RESULT}")
