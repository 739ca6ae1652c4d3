"""Whitening of embeddings by refined eigenvectors of their covariance.

Entries are turned into integers, so that sums and the products behind the
covariance are exact and don't depend on the partitioning.  Tasks add up
centred products, Spark adds up tasks; the driver holds two matrices of
dimension x dimension, never a row.  Its eigenvectors start in single precision
and are corrected by Ogita-Aishima iterations, which need matrix products only
and run in extended precision; eigenvalues too close for that are told apart by
a small problem of their own, shifted to the middle of their cluster.

Defined results: rows whose vector is null, empty or holds a null, a non-finite
entry or one of 2^47 or more (its square would not stay exact) are left out, as
are rows whose vector has not the most frequent length (the larger of two
equally frequent).  A null id and repeated rows are rows like others.  A
direction without variance can't be scaled: its ``whitened`` is null.
``deviation`` is null beyond 38 digits.  No usable row gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborspark.session import land

SCALE, SHIFT, LIMIT = 64, 1_000_000, float(1 << 53)
LIMB = 20  # bits of a limb: products of 2^13 rows of limbs are exact in doubles
BLOCK = 1 << 13
ROUNDS = 16


@dataclass(frozen=True)
class Model:
    """``components`` has one unit eigenvector per column, by falling eigenvalue."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray


def usable(df: DataFrame, vector: str, dims: int | None = None) -> tuple[DataFrame, int]:
    """Rows with a usable vector of ``dims`` entries, else of the most frequent length, as array<double>; and that length."""
    v = F.col(vector).cast("array<double>")
    fine = F.coalesce(F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) * SCALE < LIMIT)), F.lit(False)) & (F.size(v) > 0)
    rows = df.withColumn(vector, v).filter(fine)
    if dims is None:
        most = rows.groupBy(F.size(vector).alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
        dims = most["dims"] if most else 0
    return rows.filter(F.size(vector) == dims), dims


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _integers(column: pa.Array, dims: int) -> np.ndarray:
    return np.floor(_matrix(column, dims) * SCALE).astype(np.int64) + SHIFT


def _blocks(batches: Iterator[pa.RecordBatch], read: Callable[[pa.Array], np.ndarray]) -> Iterator[np.ndarray]:
    for batch in batches:
        rows = read(batch.column(0))
        for at in range(0, len(rows), BLOCK):
            yield rows[at : at + BLOCK]


def exact_sum(rows: np.ndarray) -> np.ndarray:
    """Column sums of int64 rows as Python integers."""
    return ((rows >> 32).sum(axis=0).astype(object) << 32) + (rows & 0xFFFFFFFF).sum(axis=0).astype(object)


def exact_gram(rows: np.ndarray) -> np.ndarray:
    """rows' rows of at most ``BLOCK`` int64 rows as Python integers, by limbs whose products are exact in doubles."""
    limbs, half = [], 1 << (LIMB - 1)
    while not limbs or rows.any():
        low = ((rows + half) & (2 * half - 1)) - half
        limbs.append(low.astype(np.float64))
        rows = (rows - low) >> LIMB
    total = np.zeros((limbs[0].shape[1],) * 2, dtype=object)
    for a, left in enumerate(limbs):
        for b, right in enumerate(limbs):
            total = total + ((left.T @ right).astype(np.int64).astype(object) << (LIMB * (a + b)))
    return total


def _emit(total: np.ndarray | None, exact: bool) -> Iterator[pa.RecordBatch]:
    """Upper triangle (or row) of a task's total as (i, j, value)."""
    if total is None:
        return
    i, j = np.triu_indices(len(total)) if total.ndim == 2 else (np.zeros(len(total), dtype=int), np.arange(len(total)))
    values = total[i, j] if total.ndim == 2 else total
    column = pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0)) if exact else pa.array(np.asarray(values, dtype=np.float64))
    yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), column], ["i", "j", "value"])


def _total(rows: DataFrame, column: str, read: Callable[[pa.Array], np.ndarray], part: Callable[[np.ndarray], np.ndarray], exact: bool) -> dict[tuple[int, int], Decimal | float]:
    """Sum of ``part`` over all blocks of rows, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _blocks(batches, read):
            total = part(block) if total is None else total + part(block)
        yield from _emit(total, exact)

    kind = "decimal(38,0)" if exact else "double"
    parts = rows.select(column).mapInArrow(run, f"i int, j int, value {kind}")
    return {(r["i"], r["j"]): r["value"] for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}


def _square(entries: dict[tuple[int, int], object], dims: int, kind: type) -> np.ndarray:
    out = np.zeros((dims, dims), dtype=kind)
    for (i, j), value in entries.items():
        out[i, j] = out[j, i] = value
    return out


def covariance(rows: DataFrame, vector: str, dims: int) -> tuple[int, list[int], np.ndarray]:
    """(rows, integer sums, covariance with divisor n) of the integer vectors.

    Products are of rows centred at the integer nearest to the mean; what is
    left of the mean is taken off exactly, then the quotient is rounded once.
    """
    read = lambda column: _integers(column, dims)
    counted = lambda block: np.append(exact_sum(block), len(block))
    first = _total(rows, vector, read, counted, exact=True)
    if not first:
        return 0, [], np.zeros((dims, dims), dtype=np.longdouble)
    n, sums = int(first[0, dims]), [int(first[0, j]) for j in range(dims)]
    middle = [(2 * s + n) // (2 * n) for s in sums]
    centre = np.array(middle, dtype=np.int64)
    products = _total(rows, vector, read, lambda block: exact_gram(block - centre), exact=True)
    rest = [s - n * m for s, m in zip(sums, middle)]
    out = np.zeros((dims, dims), dtype=np.longdouble)
    for (i, j), value in products.items():
        exact = Fraction(n * int(value) - rest[i] * rest[j], n * n)
        high = float(exact)
        out[i, j] = out[j, i] = np.longdouble(high) + np.longdouble(float(exact - Fraction(high)))
    return n, sums, out


def _clusters(values: np.ndarray, width: float) -> list[np.ndarray]:
    """Groups of two or more eigenvalues chained by gaps within ``width``."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > width) + 1
    return [group for group in np.split(order, cuts) if len(group) > 1]


def eigenpairs(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric long double matrix.

    Single-precision vectors are the start.  Each round corrects all vectors by
    E, where E_ij = (s_ij + l_j r_ij) / (l_j - l_i) for S = X'AX, R = I - X'X and
    r_ij / 2 within a cluster, then turns each cluster by the vectors of
    X_c'(A - m)X_c, which resolves gaps far below the precision of A itself.
    """
    size = np.abs(matrix).max() if matrix.size else 0
    if not size > 0:
        return np.zeros(len(matrix)), np.eye(len(matrix))
    a, one = matrix / size, np.eye(len(matrix), dtype=np.longdouble)
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    done = np.finfo(np.longdouble).eps * len(a)
    for _ in range(ROUNDS):
        r, s = one - x.T @ x, x.T @ (a @ x)
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        width = 2 * (np.linalg.norm(off.astype(np.float64)) + np.linalg.norm(a.astype(np.float64)) * np.linalg.norm(r.astype(np.float64)))
        groups = _clusters(values, width)
        label = np.arange(len(a))
        for group in groups:
            label[group] = group.min()
        near = label[:, None] == label[None, :]
        gap = np.where(near, 1, values[None, :] - values[:, None])
        fix = np.where(near, r / 2, (s + values[None, :] * r) / gap)
        x = x + x @ fix
        turned = 0.0
        for group in groups:
            own = x[:, group]
            middle = values[group].mean()
            small = own.T @ (a @ own - middle * own)
            spread = np.abs(small).max()
            if spread > done:
                turn = np.linalg.eigh((small / spread).astype(np.float64))[1]
                turned = max(turned, float(np.abs(small - np.diag(np.diag(small))).max()))
                x[:, group] = own @ turn
        if np.abs(fix).max() <= done and turned <= done:
            break
    values = np.diag(x.T @ (a @ x)) * size
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    sign = np.where(x[np.abs(x).argmax(axis=0), np.arange(len(a))] < 0, -1, 1)
    return values[order].astype(np.float64), (x * sign).astype(np.float64)


def fit(df: DataFrame, vector: str = "embedding", components: int = 32) -> Model:
    """Model over all usable vectors of ``df``, read three times."""
    rows, dims = usable(df, vector)
    n, sums, cov = covariance(rows, vector, dims)
    values, vectors = eigenpairs(cov)
    trace = float(np.trace(cov)) if dims else 0.0
    values = np.where(values > dims * np.finfo(np.float64).eps * trace, values, 0.0)[:components]
    explained = values / trace if trace > 0 else np.zeros(len(values))
    return Model(n, sums, vectors[:, :components], values, explained)


def _deviations(block: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[Decimal | None]]:
    """(x - S/n in double precision, exact sums of (nx - S)^2)."""
    reach = max(int(np.abs(block).max()) * n, max(map(abs, sums)))
    if reach < 1 << 61:
        scaled = block * n - np.array(sums, dtype=np.int64)
        small = int(np.abs(scaled).max()) ** 2 * block.shape[1] < 1 << 62
        squares = (scaled if small else scaled.astype(object)) ** 2
    else:
        scaled = block.astype(object) * n - np.array(sums, dtype=object)
        squares = scaled**2
    totals = [Decimal(int(v)) if v < 10**38 else None for v in squares.sum(axis=1)]
    return (scaled / n).astype(np.float64), totals


def whiten(df: DataFrame, model: Model, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(key, deviation decimal(38,0), whitened array<double>) of every usable row."""
    rows, dims = usable(df, vector, len(model.sums))
    fit_for = np.where(model.eigenvalues > 0, model.eigenvalues, np.nan)
    basis = model.components / np.sqrt(fit_for)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                centred, totals = _deviations(_integers(part.column(1), dims), model.n, model.sums)
                flat = (centred @ np.nan_to_num(basis) + 0 * basis.sum(axis=0)).ravel()
                values = pa.array(flat, mask=np.isnan(flat))
                offsets = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * basis.shape[1])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(totals, pa.decimal128(38, 0)), pa.ListArray.from_arrays(offsets, values)], ["key", "deviation", "whitened"])

    kind = df.schema[key].dataType.simpleString()
    return rows.select(key, vector).mapInArrow(run, f"key {kind}, deviation decimal(38,0), whitened array<double>").withColumnRenamed("key", key)


def identity_error(white: DataFrame, model: Model) -> float | None:
    """Largest absolute entry of the covariance of ``whitened`` (a landed table) minus the identity.

    Over directions with variance; null if there is none.
    """
    k, alive = len(model.eigenvalues), np.flatnonzero(model.eigenvalues > 0)
    if not len(alive):
        return None
    read = lambda column: np.nan_to_num(_matrix(column, k))[:, alive]
    sums = _total(white, "whitened", read, lambda block: block.sum(axis=0), exact=False)
    mean = np.array([sums[0, j] for j in range(len(alive))]) / model.n
    products = _total(white, "whitened", read, lambda block: (block - mean).T @ (block - mean), exact=False)
    return float(np.abs(_square(products, len(alive), np.float64) / model.n - np.eye(len(alive))).max())


def whitened_rows(df: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = 32) -> DataFrame:
    """One row per usable row and component: (key, component, n, deviation, whitened, explained, identity_error)."""
    model = fit(df, vector, components)
    white = land(whiten(df, model, vector, key), "whitened")
    error = identity_error(white, model)
    shares = F.array(*[F.lit(float(v)) for v in model.explained]).cast("array<double>")
    rows = white.select(key, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select(
        key, (F.col("at") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"),
    )
