"""Whitening of embeddings: principal components of their covariance, scaled to variance one.

A vector's entries c become the integers x = floor(scale * c).  The fit list holds each
distinct x once, so copies do not weigh.  Spark makes the fit list (a distinct, combined
before its shuffle), the exact sums per dimension, and the covariance: each task adds up the
products of centred rows in one matrix, and the matrices are summed by entry in Spark.  The
driver gets one value a pair of dimensions, whatever the number of rows.

The leading eigenpairs of that matrix come from Householder reflections to a tridiagonal
matrix, bisection on Sturm counts for the eigenvalues, and inverse iteration for the vectors;
vectors whose eigenvalues lie close together are orthogonalised against each other.  The few
components go to the tasks, which project every row.  How far the covariance of the projected
fit list is from the identity is measured in a further pass.

Rows: those whose vector is null or holds null or non-finite entries take no part; a vector
shorter than the longest counts as ended by zeros, an empty one too; null, repeated and tied
vec_ids are rows like others; more columns are ignored.  A component without variance (less
than rounding leaves of the largest) cannot be scaled and is left out: there are none if all
vectors are equal, and then, as for an empty table, no rows.  ``scale * c`` beyond 64 bits
becomes the nearest of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import materialise, slices

_EPS = float(np.finfo(np.float64).eps)
_CLOSE = 1e-3     # eigenvalues nearer than this part of the norm form a cluster
_SURE = 2.0 ** 62  # estimates below this leave no doubt that a sum fits in 64 bits


@dataclass(frozen=True)
class Whitening:
    """A fitted model: ``components`` are columns, ``variances`` their eigenvalues."""

    scale: int
    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float

    @property
    def dims(self) -> int:
        return len(self.sums)


# --- leading eigenpairs of a symmetric matrix -------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and reflection vectors (rows) of the Householder reduction."""
    a = np.array(matrix, dtype=np.float64)
    d = len(a)
    mirrors = np.zeros((max(d - 2, 0), d))
    for k in range(d - 2):
        x = a[k + 1:, k]
        length = np.sqrt(x @ x)
        if length == 0:
            continue
        v = x.copy()
        v[0] += np.copysign(length, x[0])
        v /= np.sqrt(v @ v)
        mirrors[k, k + 1:] = v
        rest = a[k + 1:, k + 1:]
        p = 2 * (rest @ v)
        q = p - (p @ v) * v
        rest -= np.outer(v, q) + np.outer(q, v)
        a[k + 1, k] = -np.copysign(length, x[0])
    return np.diag(a).copy(), np.array([a[i + 1, i] for i in range(d - 1)]), mirrors


def below(diagonal: np.ndarray, beside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each value of ``at`` the number of eigenvalues less than it (Sturm count)."""
    tiny = np.finfo(np.float64).tiny / _EPS
    squares = beside * beside
    q = diagonal[0] - at
    count = (q < 0).astype(np.int64)
    for i in range(1, len(diagonal)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = diagonal[i] - at - squares[i - 1] / q
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, beside: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until no double lies between."""
    d = len(diagonal)
    off = np.abs(np.concatenate([[0.0], beside, [0.0]]))
    radius = off[:-1] + off[1:]
    low = np.full(k, (diagonal - radius).min())
    high = np.full(k, (diagonal + radius).max())
    margin = 2 * d * _EPS * max(abs(low[0]), abs(high[0])) + np.finfo(np.float64).tiny
    low, high = low - margin, high + margin
    wanted = d - 1 - np.arange(k)  # so many lie below the eigenvalue
    while True:
        middle = low + (high - low) / 2
        if not ((middle > low) & (middle < high)).any():
            return middle
        beyond = below(diagonal, beside, middle) > wanted
        high, low = np.where(beyond, middle, high), np.where(beyond, low, middle)


def _solver(diagonal: np.ndarray, beside: np.ndarray, value: float, least: float):
    """Solves (T - value) x = b by elimination with row exchanges."""
    d = len(diagonal)
    main, up, up2 = diagonal - value, np.append(beside, 0.0), np.zeros(d)
    swaps, factors = np.zeros(d, dtype=bool), np.zeros(d)
    for i in range(d - 1):
        below_it = beside[i]
        if abs(main[i]) < abs(below_it):
            swaps[i] = True
            factors[i] = main[i] / below_it
            main[i], up[i], up2[i], main[i + 1], up[i + 1] = (
                below_it, main[i + 1], up[i + 1], up[i] - factors[i] * main[i + 1], -factors[i] * up[i + 1])
        elif main[i] != 0:
            factors[i] = below_it / main[i]
            main[i + 1] -= factors[i] * up[i]
    main = np.where(np.abs(main) < least, np.copysign(least, main), main)

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.copy()
        for i in range(d - 1):
            if swaps[i]:
                x[i], x[i + 1] = x[i + 1], x[i]
            x[i + 1] -= factors[i] * x[i]
        for i in reversed(range(d)):
            if i + 1 < d:
                x[i] -= up[i] * x[i + 1]
            if i + 2 < d:
                x[i] -= up2[i] * x[i + 2]
            x[i] /= main[i]
        return x

    return solve


def leading_vectors(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix (columns) for its eigenvalues ``values``."""
    d, k = len(diagonal), len(values)
    norm = max(np.abs(diagonal).max(), np.abs(beside).max() if d > 1 else 0.0)
    vectors = np.zeros((d, k))
    first = 0  # where the cluster begins
    for j in range(k):
        if j and values[j - 1] - values[j] > _CLOSE * norm:
            first = j
        # equal eigenvalues are told apart by a few units in the last place
        solve = _solver(diagonal, beside, values[j] - (j - first) * 2 * _EPS * norm, _EPS * norm)
        x = np.random.default_rng(j).uniform(0.5, 1.0, d)
        for _ in range(5):
            x = solve(x / np.abs(x).max())
            for _ in range(2):  # once more for what rounding left
                x -= vectors[:, first:j] @ (vectors[:, first:j].T @ x)
                x /= np.sqrt(x @ x)
        vectors[:, j] = x
    return vectors


def leading_eigenpairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors
    (columns; the entry of largest size is positive)."""
    size = float(np.abs(matrix).max(initial=0.0))
    k = min(k, len(matrix))
    if size == 0:
        return np.zeros(k), np.eye(len(matrix))[:, :k]
    diagonal, beside, mirrors = tridiagonal(matrix / size)
    values = leading_values(diagonal, beside, k)
    vectors = leading_vectors(diagonal, beside, values)
    for v in mirrors[::-1]:
        vectors -= 2 * np.outer(v, v @ vectors)
    vectors /= np.sqrt((vectors * vectors).sum(axis=0))
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(k)])
    return values * size, vectors * signs


# --- rows -------------------------------------------------------------------------------


def quantised(embeddings: DataFrame, scale: int, vector: str = "embedding") -> DataFrame:
    """``vec_id, x`` of the rows that take part; x as long as the vector."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    entry = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))
    return embeddings.where(F.col(vector).isNotNull() & ~bad).select("vec_id", entry.alias("x"))


def _ended(rows: DataFrame, dims: int) -> DataFrame:
    """``rows`` whose x have ``dims`` entries, zeros at the end."""
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x"))
    return rows.withColumn("x", F.when(F.size("x") < dims, F.concat("x", zeros)).otherwise(F.col("x")))


def _matrix(column, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of rows and exact sum of each dimension.  High and low halves are added apart,
    so that no sum leaves 64 bits in a task."""
    def partial(batches: Iterator) -> Iterator:
        import pyarrow as pa

        n, high, low = 0, np.zeros(dims, np.int64), np.zeros(dims, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            n += len(x)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(np.full(dims, n)),
                                          pa.array(high), pa.array(low)], ["j", "n", "high", "low"])

    found = (fit.select("x").mapInArrow(partial, "j long, n long, high long, low long").groupBy("j")
             .agg(F.sum("n").alias("n"), *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in ("high", "low")])
             .orderBy("j").collect())  # one row a dimension
    return found[0]["n"], [(int(r["high"]) << 32) + int(r["low"]) for r in found]


class _Centre:
    """Rows less the mean: the whole part is taken off as integers, so a distant mean costs
    no digits."""

    def __init__(self, n: int, sums: tuple[int, ...]):
        parts = [divmod(s, n) for s in sums]
        self.whole = np.array([w for w, _ in parts], dtype=np.int64)
        self.rest = np.array([r / n for _, r in parts])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        near = (x ^ (x - self.whole)) & (x ^ self.whole) >= 0  # no overflow
        return np.where(near, (x - self.whole).astype(np.float64),
                        x.astype(np.float64) - self.whole.astype(np.float64)) - self.rest


def _covariance(fit: DataFrame, n: int, sums: tuple[int, ...]) -> np.ndarray:
    dims, centre = len(sums), _Centre(n, sums)

    def partial(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros((dims, dims))
        for batch in slices(batches, 4096):
            z = centre(_matrix(batch.column(0), dims))
            total += z.T @ z
        for i in range(dims):  # a matrix row at a time, from the diagonal on
            yield pa.RecordBatch.from_arrays([pa.array(np.full(dims - i, i)), pa.array(np.arange(i, dims)),
                                              pa.array(total[i, i:])], ["i", "j", "v"])

    found = (fit.select("x").mapInArrow(partial, "i long, j long, v double").groupBy("i", "j")
             .agg((F.sum("v") / F.lit(float(n))).alias("v")).toArrow())  # one row a pair of dimensions
    i, j, v = (found.column(c).to_numpy() for c in ("i", "j", "v"))
    out = np.zeros((dims, dims))
    out[i, j] = out[j, i] = v
    return out


def _identity_error(fit: DataFrame, n: int, sums: tuple[int, ...], projection: np.ndarray) -> float:
    """Largest entry of the projected rows' covariance minus the identity."""
    dims, k, centre = len(sums), projection.shape[1], _Centre(n, sums)

    def projected(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in slices(batches, 4096):
            w = centre(_matrix(batch.column(0), dims)) @ projection
            yield pa.RecordBatch.from_arrays([pa.array(w[:, c]) for c in range(k)], names)

    names = [f"w{c}" for c in range(k)]
    w = fit.select("x").mapInArrow(projected, ", ".join(f"{c} double" for c in names))
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    found = w.agg(*[F.covar_pop(names[a], names[b]).alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(v - (a == b)) for v, (a, b) in zip(found, pairs, strict=True))


def fit_whitening(embeddings: DataFrame, components: int = 4, scale: int = 256,
                  vector: str = "embedding") -> Whitening | None:
    """The model of all rows of ``embeddings (vec_id, <vector>)``; None if no component has
    variance."""
    rows = quantised(embeddings, scale, vector)
    dims = rows.agg(F.max(F.size("x"))).first()[0]
    if not dims:
        return None
    fit = materialise(_ended(rows, dims).select("x").distinct(), "vectors")
    n, sums = _sums(fit, dims)
    sums = tuple(sums)
    covariance = _covariance(fit, n, sums)
    values, vectors = leading_eigenpairs(covariance, components)
    kept = values > 16 * dims * _EPS * max(values[0], 0.0)
    if not kept.any():
        return None
    values, vectors = values[kept], vectors[:, kept]
    error = _identity_error(fit, n, sums, vectors / np.sqrt(values))
    return Whitening(scale, n, sums, vectors, values, float(np.trace(covariance)), error)


def _deviations(x: np.ndarray, z: np.ndarray, n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, dict[int, Decimal]]:
    """Sums of (n x - S)^2, exact: 64-bit arithmetic wraps, and is right wherever the sum
    itself fits; the others (by row) are added up in whole numbers."""
    about = (z * z).sum(axis=1) * float(n) * float(n)
    n64, s64 = (np.array([v & (2 ** 64 - 1) for v in some], dtype=np.uint64) for some in ((n,), sums))
    off = x.astype(np.uint64) * n64 - s64
    exact = (off * off).sum(axis=1, dtype=np.uint64).astype(np.int64)
    large = {int(r): Decimal(sum((n * v - s) ** 2 for v, s in zip(x[r].tolist(), sums, strict=True)))
             for r in np.flatnonzero(~(about < _SURE))}
    return exact, large


def apply_whitening(embeddings: DataFrame, model: Whitening | None, vector: str = "embedding") -> DataFrame:
    """A row for each row that takes part and each component: ``vec_id, component, n,
    deviation`` (decimal; null beyond 38 digits) ``, whitened, explained, identity_error``."""
    rows = quantised(embeddings, model.scale if model else 1, vector)
    own = rows.schema["vec_id"]
    kind = T.StructType([own, T.StructField("component", T.IntegerType()), T.StructField("low", T.LongType()),
                         T.StructField("large", T.DecimalType(38, 0)), T.StructField("whitened", T.DoubleType()),
                         T.StructField("explained", T.DoubleType())])
    if model is None:
        rows = rows.where(F.lit(False)).select("vec_id", *[
            F.lit(None).cast(f.dataType).alias(f.name) for f in kind.fields[1:]])
    else:
        schema = to_arrow_schema(kind)
        dims, k, n, sums = model.dims, model.components.shape[1], model.n, model.sums
        projection, centre = model.components / np.sqrt(model.variances), _Centre(n, sums)
        share = model.variances / model.trace

        def projected(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in slices(batches, 2048):
                x = _matrix(batch.column(1), dims)
                z = centre(x)
                exact, large = _deviations(x, z, n, sums)
                each = np.repeat(np.arange(len(x)), k)
                large = [v if (v := large.get(r)) is not None and v.adjusted() < 38 else None for r in each.tolist()]
                low = pa.array(exact[each], mask=~((z * z).sum(axis=1) * float(n) * float(n) < _SURE)[each])
                columns = [batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), len(x))), low,
                           pa.array(large, pa.decimal128(38, 0)), pa.array((z @ projection).ravel()),
                           pa.array(np.tile(share, len(x)))]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        rows = _ended(rows, dims).mapInArrow(projected, kind)
    return rows.select("vec_id", "component", F.lit(model.n if model else 0).cast("long").alias("n"),
                       F.coalesce("large", F.col("low").cast("decimal(38,0)")).alias("deviation"), "whitened", "explained",
                       F.lit(model.identity_error if model else None).cast("double").alias("identity_error"))


def whiten(embeddings: DataFrame, components: int = 4, scale: int = 256, vector: str = "embedding") -> DataFrame:
    """Every row of ``embeddings`` in the components of all of them."""
    return apply_whitening(embeddings, fit_whitening(embeddings, components, scale, vector), vector)
