"""Whitening of embeddings by leading principal components (operator 13).

Entries become integers (``floor(64 * c) + 1000000``), so that counts and sums
are exact. Three narrow passes over the vectors fit the model, one applies it:

1. number of vectors and the sum of each dimension (integers);
2. the covariance: every task centres its vectors by the exact mean before it
   multiplies, and adds up one matrix; Spark adds the tasks' matrices in blocks
   with partial sums, so nothing but numbers of the dimension comes to the driver;
3. there the matrix (dimension squared, whatever the rows) is brought to
   tridiagonal form by Householder reflections, the leading eigenvalues are
   bisected with Sturm counts, and inverse iteration gives their vectors, where
   those of a cluster of close eigenvalues are kept orthogonal to each other;
4. the projection (dimension x components) is broadcast; a pass measures the
   covariance of the whitened vectors, the last one writes them.

Defined cases: a null vector, one with null or non-finite entries and one
without entries is dropped, and so is one whose length is not the most frequent
(of equally frequent the greatest) length; entries beyond 2**46 count as 2**46;
repeated rows count each; a null id stays null; other columns are kept, but for
those named as an output; components whose eigenvalue is nothing but rounding
(constant or dependent dimensions, a single vector) are left out; an empty
table gives an empty result. ``deviation`` is a whole number of up to 38 digits;
the query's long column holds it up to about a hundred million vectors and fails
beyond instead of giving another number.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm._shared import bound_arrow_batches, ship_by_value

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
#: Largest entry in magnitude: sixty-four times it is still a whole double.
MOST = 2.0 ** 46
#: Columns of a block in which tasks' matrices are added up.
BLOCK = 32
#: Eigenvalues closer than this share of the largest one form a cluster.
CLUSTER = 1e-3


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: ``axes`` holds one column per component, already
    divided by the root of its eigenvalue."""
    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    axes: np.ndarray
    identity_error: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


# -- inside tasks -----------------------------------------------------------------------------

def whole_vectors(column, dimension: int | None = None):
    """(row numbers, lengths, entries as doubles) of the rows of an Arrow list
    array that are kept; with a dimension the entries are a matrix."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    given = column.values
    entries = (given if pa.types.is_floating(given.type) else pc.cast(given, pa.float64())).to_numpy(zero_copy_only=False)
    entries = entries.astype(np.float64)  # null entries are not a number from here on
    size = np.diff(offsets)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    keep = column.is_valid().to_numpy(zero_copy_only=False) & (size > 0) & (bad[offsets[1:]] == bad[offsets[:-1]])
    if dimension is None:
        return np.flatnonzero(keep), size[keep], entries
    rows = np.flatnonzero(keep & (size == dimension))
    at = offsets[:-1][rows][:, None] + np.arange(dimension)
    return rows, size[rows], entries[at.reshape(-1)].reshape(len(rows), dimension)


def integers(entries: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * np.clip(entries, -MOST, MOST)).astype(np.int64) + SHIFT


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - S/n with one rounding: whole part and remainder of the mean apart."""
    whole = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s % n / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]):
    """Sum over the dimensions of (n*x - S)^2, exact, as an Arrow decimal array."""
    from decimal import Decimal

    import pyarrow as pa
    whole = pa.decimal128(38, 0)
    reach = max((max(n * int(x[:, j].max()) - s, s - n * int(x[:, j].min())) for j, s in enumerate(sums)), default=0) if len(x) else 0
    if reach * reach * len(sums) < 1 << 62 and all(abs(s) < 1 << 62 for s in sums) and n * (int(np.abs(x).max()) if len(x) else 0) < 1 << 62:
        d = n * x - np.array(sums, dtype=np.int64)
        return pa.array((d * d).sum(axis=1)).cast(pa.decimal128(38, 0))
    return pa.array([Decimal(sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True))) for row in x], type=whole)


# -- the driver's share: a matrix of the dimension ---------------------------------------------

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal, off-diagonal and the Householder reflections (row from which
    they act, unit vector) that bring a symmetric matrix to tridiagonal form."""
    a = np.array(matrix, dtype=np.float64)
    d, made = len(a), []
    for k in range(d - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            continue
        x[0] += size if x[0] >= 0 else -size
        v = x / np.linalg.norm(x)
        rest = a[k + 1:, k + 1:]
        p = rest @ v
        q = p - (v @ p) * v
        rest -= 2 * (np.outer(v, q) + np.outer(q, v))
        below = a[k + 1:, k] - 2 * v * (v @ a[k + 1:, k])
        a[k + 1:, k] = a[k, k + 1:] = below
        made.append((k + 1, v))
    return np.diag(a).copy(), np.diag(a, 1).copy(), made


def sturm_count(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are below each of ``at``:
    the negative pivots of its shifted factorisation."""
    least = np.finfo(float).tiny ** 0.5 + np.finfo(float).eps * (np.abs(off).max(initial=0.0) ** 2)
    below, pivot = np.zeros(len(at), np.int64), np.ones(len(at))
    for i, value in enumerate(diagonal):
        pivot = value - at - (off[i - 1] ** 2 / pivot if i else 0.0)
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        below += pivot < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, bisected until no double is between."""
    d = len(diagonal)
    edge = np.concatenate([[0.0], np.abs(off), [0.0]])
    radius = edge[:-1] + edge[1:]  # Gershgorin
    low, high = np.full(k, (diagonal - radius).min()), np.full(k, (diagonal + radius).max())
    pad = np.finfo(float).eps * max(abs(low[0]), abs(high[0]), 1e-300) * d
    low, high = low - pad, high + pad
    wanted = d - np.arange(k)  # the j-th largest has that many eigenvalues up to it
    for _ in range(200):
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        up = sturm_count(diagonal, off, middle) >= wanted
        high, low = np.where(up, middle, high), np.where(up, low, middle)
    return low + (high - low) / 2


def _factored(diagonal: np.ndarray, off: np.ndarray, shift: float):
    """LU factors with row exchanges of the shifted tridiagonal matrix; solves."""
    d = len(diagonal)
    norm = np.abs(diagonal).max(initial=0.0) + np.abs(off).max(initial=0.0)
    tiny = np.finfo(float).eps * (norm or 1.0)
    u0, u1, u2 = diagonal - shift, np.append(off, 0.0), np.zeros(d)
    steps = []
    for i in range(d - 1):
        lower = off[i]
        if abs(lower) > abs(u0[i]):
            swap = True
            a0, a1, a2 = u0[i], u1[i], u2[i]
            u0[i], u1[i], u2[i] = lower, u0[i + 1], u1[i + 1]
            factor = a0 / lower
            u0[i + 1], u1[i + 1] = a1 - factor * u1[i], a2 - factor * u2[i]
        else:
            swap = False
            u0[i] = u0[i] or tiny
            factor = lower / u0[i]
            u0[i + 1] -= factor * u1[i]
        steps.append((swap, factor))
    small = np.abs(u0) < tiny
    u0[small] = np.where(u0[small] < 0, -tiny, tiny)

    def solve(b: np.ndarray) -> np.ndarray:
        y = b.copy()
        for i, (swap, factor) in enumerate(steps):
            if swap:
                y[i], y[i + 1] = y[i + 1], y[i]
            y[i + 1] -= factor * y[i]
        for i in range(d - 1, -1, -1):
            if i + 1 < d:
                y[i] -= u1[i] * y[i + 1]
            if i + 2 < d:
                y[i] -= u2[i] * y[i + 2]
            y[i] /= u0[i]
        return y
    return solve


def eigenvectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors of the tridiagonal matrix for falling ``values`` by inverse
    iteration, made orthogonal within each cluster of close values."""
    d = len(diagonal)
    out = np.zeros((d, len(values)))
    size = max(abs(values[0]), np.finfo(float).tiny) if len(values) else 1.0
    first = 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * size:
            first = j
        # equal values of a cluster are told apart by a shift of a few units in the last place
        solve = _factored(diagonal, off, value - (j - first) * 4 * np.finfo(float).eps * size)
        y = np.random.default_rng(j).standard_normal(d)
        for _ in range(5):
            y /= np.abs(y).max()
            y = solve(y)
            y /= np.linalg.norm(y)
            for _ in range(2):
                y -= out[:, first:j] @ (out[:, first:j].T @ y)
            y /= np.linalg.norm(y)
        out[:, j] = y
    return out


def leading_components(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues and their unit eigenvectors (columns)."""
    size = np.abs(matrix).max(initial=0.0) or 1.0
    diagonal, off, reflections = tridiagonal(matrix / size)
    values = leading_eigenvalues(diagonal, off, min(k, len(matrix)))
    vectors = eigenvectors(diagonal, off, values)
    for at, v in reversed(reflections):
        vectors[at:] -= 2 * np.outer(v, v @ vectors[at:])
    return values * size, vectors


# -- the job ----------------------------------------------------------------------------------

def _summed(vectors: DataFrame, dimension: int, shape: tuple[int, int], kernel) -> np.ndarray:
    """Sum over all vectors of ``kernel(integer matrix) -> matrix of shape``: one
    matrix per task, added up by Spark in rows of ``BLOCK`` columns."""
    names = [f"v{i}" for i in range(BLOCK)]
    height, width = shape

    def run(batches):
        import pyarrow as pa
        total = np.zeros((height, -(-width // BLOCK) * BLOCK))
        for batch in batches:
            rows, _, entries = whole_vectors(batch.column(0), dimension)
            if len(rows):
                total[:, :width] += kernel(integers(entries))
        if total.any():
            blocks = total.shape[1] // BLOCK
            parts = total.reshape(height * blocks, BLOCK)
            keys = [pa.array(np.repeat(np.arange(height), blocks).astype(np.int32)),
                    pa.array(np.tile(np.arange(blocks), height).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(keys + [pa.array(parts[:, i].copy()) for i in range(BLOCK)], names=["r", "b", *names])
    made = vectors.mapInArrow(run, "r int, b int, " + ", ".join(f"{v} double" for v in names))
    out = np.zeros((height, -(-width // BLOCK) * BLOCK))
    for row in made.groupBy("r", "b").agg(*[F.sum(v).alias(v) for v in names]).collect():
        out[row["r"], row["b"] * BLOCK:(row["b"] + 1) * BLOCK] = [row[v] for v in names]
    return out[:, :width]


def _dimension(vectors: DataFrame) -> int:
    """The most frequent length of the vectors that are whole; 0 if there are none."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            _, size, _ = whole_vectors(batch.column(0))
            length, rows = np.unique(size, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(length.astype(np.int64)), pa.array(rows.astype(np.int64))], names=["length", "n"])
    best = (vectors.mapInArrow(run, "length bigint, n bigint").groupBy("length").agg(F.sum("n").alias("n"))
            .orderBy(F.desc("n"), F.desc("length")).first())
    return best["length"] if best else 0


def _sums(vectors: DataFrame, dimension: int) -> tuple[int, tuple[int, ...]]:
    """(n, sum of each dimension), exact: high and low bits are added apart."""
    def run(batches):
        import pyarrow as pa
        n, high, low = 0, np.zeros(dimension, np.int64), np.zeros(dimension, np.int64)
        for batch in batches:
            rows, _, entries = whole_vectors(batch.column(0), dimension)
            x = integers(entries)
            n, high, low = n + len(rows), high + (x >> 20).sum(axis=0), low + (x & ((1 << 20) - 1)).sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimension)), pa.array(np.full(dimension, n)), pa.array(high), pa.array(low)],
                                             names=["dim", "n", "high", "low"])
    parts = vectors.mapInArrow(run, "dim bigint, n bigint, high bigint, low bigint")
    whole = {c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")}
    rows = sorted(parts.groupBy("dim").agg(*whole.values()).collect(), key=lambda r: r["dim"])
    return int(rows[0]["n"]), tuple((int(r["high"]) << 20) + int(r["low"]) for r in rows)


def fit_whitening(df: DataFrame, components: int = COMPONENTS, vector: str = "embedding") -> Whitening | None:
    """The whitening of the vectors of ``df``; None if no vector is whole."""
    bound_arrow_batches(df.sparkSession)
    vectors = df.select(F.col(vector).alias("v"))
    dimension = _dimension(vectors)
    if not dimension:
        return None
    n, sums = _sums(vectors, dimension)

    def moments(x):
        c = centred(x, n, sums)
        return np.vstack([c.T @ c, c.sum(axis=0)])
    total = _summed(vectors, dimension, (dimension + 1, dimension), moments)
    covariance, drift = total[:-1] / n, total[-1] / n
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    values, unit = leading_components(covariance, components)
    real = values > dimension * np.finfo(float).eps * max(trace, 0.0)
    values, axes = values[real], unit[:, real] / np.sqrt(values[real])
    k = len(values)
    if not k:
        return Whitening(n, sums, trace, values, axes, 0.0)
    middle = drift @ axes

    def spread(x):
        w = centred(x, n, sums) @ axes - middle
        return w.T @ w
    error = float(np.abs(_summed(vectors, dimension, (k, k), spread) / n - np.eye(k)).max())
    return Whitening(n, sums, trace, values, axes, error)


def whiten(df: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """The whole vectors' rows of ``df`` with ``deviation`` (decimal) and
    ``whitened`` (one double per component)."""
    bound_arrow_batches(df.sparkSession)
    names = [c for c in df.columns if c not in ("deviation", "whitened")]
    given = df.select(*[F.col(f"`{c}`") for c in names])
    schema = T.StructType([*given.schema.fields, T.StructField("deviation", T.DecimalType(38, 0)),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    shared = df.sparkSession.sparkContext.broadcast((model.n, model.sums, model.axes))  # dimension x components

    def run(batches):
        import pyarrow as pa
        n, sums, axes = shared.value
        for batch in batches:
            rows, _, entries = whole_vectors(batch.column(names.index(vector)), len(sums))
            x = integers(entries)
            w = centred(x, n, sums) @ axes
            ends = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * axes.shape[1], type=pa.int32())
            kept = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*kept.columns, deviations(x, n, sums), pa.ListArray.from_arrays(ends, pa.array(w.reshape(-1)))],
                                             names=[*names, "deviation", "whitened"])
    return given.mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    model = fit_whitening(vectors)
    if model is None:
        return spark.createDataFrame([], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
                                         "explained double, identity_error double")
    parts = whiten(vectors, model).select("vec_id", F.col("deviation").cast("bigint").alias("deviation"), F.posexplode("whitened"))
    explained = F.array(*map(F.lit, model.explained)) if model.explained else F.array().cast("array<double>")
    return parts.select(F.col("vec_id").cast("bigint").alias("vec_id"), (F.col("pos") + 1).alias("component"),
                        F.lit(model.n).cast("bigint").alias("n"), "deviation", F.col("col").alias("whitened"),
                        F.get(explained, F.col("pos")).alias("explained"),
                        F.lit(model.identity_error).cast("double").alias("identity_error"))


ship_by_value(__name__)
