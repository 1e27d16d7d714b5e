"""Embedding whitening: components by QDWH spectral divide and conquer, applied by broadcast.

Vectors become whole numbers ``floor(scale * c)``. The fit list is each distinct such
vector once; it is written below the shared folder and read by three jobs: count and
sums, the products of the centred vectors, and the covariance of the whitened ones.
Vectors are centred by the rounded mean before they are multiplied, so every product
sum is a whole number; the rest of the mean, under one half, is taken off exactly. The
covariance then has no rounding but its last one, whatever the order of the tasks.

The eigenvectors come from polar decompositions: the unitary factor of ``V - sI``, by
QR- and Cholesky-based dynamically weighted Halley steps, gives the projector on all
components above ``s``; an orthonormal basis of its range and one of the complement
split ``V`` into two smaller problems, until a block is a single component or a
multiple of the identity. Only the blocks that hold the wanted components are split.
This runs on the driver over ``d * d`` numbers, never over rows; ``max_dimension``
bounds it.

Defined results: a row whose vector is null, or holds a null, NaN or infinite entry, is
left out. Of vectors of several lengths those of the most frequent length count (ties:
the longer), the others are left out; vectors without entries never count. Repeated
rows and ids are kept; each gets its rows. A component whose variance is zero (up to
rounding) has ``whitened`` null and no part in ``identity_error``, which is null where no
component is left. ``deviation`` is null where it exceeds a long. Tables without a
usable vector give no rows. Other columns are kept; columns named like a result are
replaced, and the vector is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import discard, shared_dir
from .common import packed

EPS = np.finfo(np.float64).eps
#: Whole numbers up to here are exact as doubles.
EXACT = 1 << 53


# ----------------------------------------------------------------- polar and spectral splits


def polar(a: np.ndarray) -> np.ndarray:
    """The unitary polar factor of a symmetric, non-singular matrix, by weighted Halley steps."""
    n = len(a)
    eye = np.eye(n)
    x = a / np.linalg.norm(a, "fro")
    low = EPS / math.sqrt(n)  # no singular value of a matrix that can be told from a singular one is smaller
    for _ in range(30):
        root = (4.0 * (1.0 - low * low) / low**4) ** (1.0 / 3.0)
        lead = math.sqrt(1.0 + root)
        p = lead + 0.5 * math.sqrt(max(0.0, 8.0 - 4.0 * root + 8.0 * (2.0 - low * low) / (low * low * lead)))
        q = (p - 1.0) ** 2 / 4.0
        r = p + q - 1.0
        if r > 100.0:  # ill-conditioned: by QR of the stacked matrix
            both = np.linalg.qr(np.vstack([math.sqrt(r) * x, eye]))[0]
            new = (q / r) * x + ((p - q / r) / math.sqrt(r)) * (both[:n] @ both[n:].T)
        else:
            factor = np.linalg.cholesky(eye + r * (x.T @ x))
            half = np.linalg.solve(factor, x.T)
            new = (q / r) * x + (p - q / r) * np.linalg.solve(factor.T, half).T
        new = (new + new.T) / 2.0
        moved = np.linalg.norm(new - x, "fro")
        x = new
        low = min(1.0, low * (p + q * low * low) / (1.0 + r * low * low))
        if 1.0 - low < 10.0 * EPS and moved < EPS ** (1.0 / 3.0):
            break
    return x


def _halves(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the components of ``a`` above and below ``shift``; None where it splits nothing."""
    n = len(a)
    above = (polar(a - shift * np.eye(n)) + np.eye(n)) / 2.0
    rank = int(round(float(np.trace(above))))
    if not 0 < rank < n or np.linalg.norm(above @ above - above, "fro") > 1e-8:
        return None  # nothing on one side, or the shift is an eigenvalue itself
    basis = np.random.default_rng(n).standard_normal((n, rank))
    for _ in range(3):  # the projector's range; repeated, as one random start may be badly conditioned
        basis = np.linalg.qr(above @ basis)[0]
    whole = np.linalg.qr(basis, mode="complete")[0]
    return whole[:, :rank], whole[:, rank:]


def components(a: np.ndarray, wanted: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    wanted = len(a) if wanted is None else min(wanted, len(a))
    size = float(np.linalg.norm(a, "fro"))
    values: list[float] = []
    vectors: list[np.ndarray] = []
    blocks = [np.eye(len(a))]  # bases of invariant subspaces, the one with the largest components last
    while blocks and len(values) < wanted:
        basis = blocks.pop()
        n = basis.shape[1]
        block = basis.T @ a @ basis
        block = (block + block.T) / 2.0
        mean = float(np.trace(block)) / n
        rest = float(np.linalg.norm(block - mean * np.eye(n), "fro"))
        if n == 1 or rest <= 4.0 * EPS * n * size:  # one component, or equal ones: any basis is one of eigenvectors
            values += [mean] * n
            vectors += list(basis.T)
            continue
        # The largest eigenvalue exceeds the mean by `step` at least, and the smallest falls short by as much.
        step = rest / math.sqrt(n * max(1, n - 1))
        median = float(np.median(np.diag(block)))
        shifts = [median, *(mean + k * step for k in (0.0, 0.5, -0.5, 0.25, -0.25, 0.75, -0.75, 0.1, -0.1))]
        parts = next(filter(None, (_halves(block, s) for s in shifts)), None)
        if parts is None:
            raise ArithmeticError("no shift separates the components")
        blocks += [basis @ parts[1], basis @ parts[0]]
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    return np.array(values)[order], np.array(vectors).T[:, order] if vectors else np.empty((0, 0))


# ----------------------------------------------------------------- fitting


@dataclass
class Whitening:
    """What every task needs: ``d`` means and ``d * k`` numbers, bounded by the dimension alone."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    usable: int
    identity_error: float | None = None

    @property
    def dimension(self) -> int:
        return len(self.sums)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Components of the rows of ``x``; NaN where a component has no variance."""
        mean = np.array([s / self.n for s in self.sums])
        out = np.full((len(x), len(self.values)), np.nan)
        if self.usable:
            scaled = self.vectors[:, :self.usable] / np.sqrt(self.values[:self.usable])
            out[:, :self.usable] = (x - mean) @ scaled
        return out

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of ``(n * x - S) ** 2`` of the rows."""
        reach = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        if reach * reach * self.dimension < 1 << 63:
            apart = self.n * x - np.array(self.sums, dtype=np.int64)
            return (apart * apart).sum(axis=1).tolist()
        found = [sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x]
        return [f if f < 1 << 63 else None for f in found]


def whole_vector(vector: Column, scale: int) -> Column:
    """``floor(scale * c)`` of every entry, or null where the vector is null or has an entry that is no number."""
    number = F.transform(vector, lambda c: c.cast("double"))
    bad = F.exists(number, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.when(~bad & (F.size(number) > 0), F.transform(number, lambda c: F.floor(c * F.lit(float(scale))).cast("bigint")))


def _matrix(batch: pa.RecordBatch, column: int, d: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _products(x: np.ndarray) -> np.ndarray:
    """``x.T @ x`` exactly, as whole numbers (Python's where a long would not do)."""
    reach = int(np.abs(x).max(initial=0))
    if reach * reach * max(1, len(x)) < EXACT:
        as_double = x.astype(np.float64)  # all partial sums are whole and below 2 ** 53
        return (as_double.T @ as_double).astype(np.int64)
    wide = x.astype(object)
    return wide.T @ wide


def _product_sums(fit: DataFrame, centre: list[int]) -> tuple[list[int], dict[tuple[int, int], int]]:
    """Sums and product sums of the vectors less ``centre``, added up by Spark per pair of dimensions."""
    d = len(centre)
    mid = np.array(centre, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | None = None
        for batch in batches:
            x = _matrix(batch, 0, d) - mid
            found = _products(np.hstack([x, np.ones((len(x), 1), dtype=np.int64)])).astype(object)
            total = found if total is None else total + found
        if total is not None:
            i, j = np.triu_indices(d + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(v) for v in total[i, j]])], names=["i", "j", "v"])

    parts = fit.select("_x").mapInArrow(run, "i int, j int, v string")
    rows = parts.groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect()
    products = {(r["i"], r["j"]): int(r["v"]) for r in rows}
    return [products.get((i, d), 0) for i in range(d)], products


def fit(vectors: DataFrame, count: int | None = 4, max_dimension: int = 1024) -> Whitening | None:
    """The whitening of the distinct vectors ``_x`` (arrays of longs, none null); None if there are none.

    ``vectors`` is read once and its distinct vectors are written below the shared
    folder; what reaches the driver is sums by dimension and by pair of dimensions.
    """
    spark = vectors.sparkSession
    folder = shared_dir(spark, "whitening")
    vectors.select("_x").distinct().write.parquet(folder)
    lists = spark.read.parquet(folder)
    lengths = lists.groupBy(F.size("_x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        discard(spark, folder)
        return None
    d, n = lengths["d"], lengths["count"]
    if d > max_dimension:
        raise ValueError(f"vectors of {d} entries; the driver splits matrices of {max_dimension} at most")
    lists = lists.filter(F.size("_x") == d)
    by_place = lists.select(F.posexplode("_x").alias("i", "v")).groupBy("i").agg(F.sum(F.col("v").cast("decimal(19,0)")).alias("s"))
    sums = [int(r["s"]) for r in by_place.orderBy("i").collect()]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    left, products = _product_sums(lists, centre)
    cov = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            # Whole numbers up to the only division, which Python rounds correctly.
            cov[i, j] = cov[j, i] = (n * products[i, j] - left[i] * left[j]) / (n * n)
    values, basis = components(cov, count)
    trace = sum(n * products[i, i] - left[i] ** 2 for i in range(d)) / (n * n)
    usable = int((values > 64 * EPS * d * max(values[0], 0.0)).sum()) if len(values) and values[0] > 0 else 0
    model = Whitening(n, sums, values, basis, trace, usable)
    model.identity_error = _identity_error(lists, model)
    discard(spark, folder)
    return model


def _identity_error(lists: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the whitened fit list's covariance less the identity, counted by Spark."""
    k = model.usable
    if not k:
        return None
    shared = lists.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = shared.value.whitened(_matrix(batch, 0, shared.value.dimension))
            yield pa.RecordBatch.from_arrays([pa.array(z[:, i]) for i in range(k)], names=[f"z{i}" for i in range(k)])

    z = lists.select("_x").mapInArrow(run, ", ".join(f"z{i} double" for i in range(k)))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = z.agg(*[F.covar_pop(f"z{i}", f"z{j}").alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


# ----------------------------------------------------------------- applying


RESULTS = ("component", "n", "deviation", "whitened", "explained", "identity_error")


def whiten(
    df: DataFrame, vector: str = "embedding", count: int | None = 4, scale: int = 256, max_dimension: int = 1024,
) -> DataFrame:
    """A row per usable row of ``df`` and component: its columns but the vector, and ``RESULTS``."""
    spark = df.sparkSession
    whole = packed(df, {"_v": vector}, (vector, *RESULTS)).select(
        "_row", whole_vector(F.col("_v"), scale).alias("_x")).filter("_x is not null")
    model = fit(whole, count, max_dimension)
    explained = T.ArrayType(T.StructType([
        T.StructField("component", T.IntegerType()), T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType())]))
    schema = T.StructType([whole.schema["_row"], T.StructField("_parts", explained)])
    if model is None:
        parts, n, error = spark.createDataFrame([], schema), 0, None
    else:
        shared, n, error = spark.sparkContext.broadcast(model), model.n, model.identity_error
        d, k = model.dimension, len(model.values)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = shared.value
            share = own.values / own.trace if own.trace > 0 else np.full(k, np.nan)
            for batch in batches:
                x = _matrix(batch, 1, d)
                rows = len(x)
                each = pa.StructArray.from_arrays(
                    [pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                     pa.array([v for v in own.deviations(x) for _ in range(k)], pa.int64()),
                     pa.array(own.whitened(x).reshape(-1), from_pandas=True),
                     pa.array(np.tile(share, rows), from_pandas=True)],
                    names=["component", "deviation", "whitened", "explained"])
                offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * k)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, each)], names=["_row", "_parts"])

        parts = whole.filter(F.size("_x") == d).mapInArrow(run, schema)
    return parts.select("_row", F.explode("_parts").alias("_p")).select(
        "_row.*", "_p.component", F.lit(n).cast("bigint").alias("n"), "_p.deviation", "_p.whitened", "_p.explained",
        F.lit(error).cast("double").alias("identity_error"))
