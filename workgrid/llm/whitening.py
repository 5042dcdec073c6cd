"""Embedding whitening with a covariance from polarisation.

The components are whole numbers, ``floor(256 * c)``, so every statistic is an
exact integer. The *fit list* holds each distinct vector once. Over it one
pass gives the number of vectors and the sum of every dimension, a second
one the sum of squares of every centred dimension and of every sum of two
centred dimensions. With ``Q`` for these sums of squares, the polarisation
identity gives the cross term of dimensions ``i`` and ``j``::

    2 * cross(i, j) = Q(i + j) - Q(i) - Q(j)

no product of two different dimensions is ever formed. Centring is exact as
well: ``n * x - S`` with the sum ``S`` of the dimension. Tasks send one row per
dimension and pair, the covariance is put together on the driver (its size is
fixed by the number of dimensions) and decomposed by ``eigh``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from workgrid.llm.common import stored

SCALE = 256.0
COMPONENTS = 4
_ROWS = 2048
_LONG = 1 << 63
_LIMB = 21
_WHOLE = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Whitening:
    """The fitted map: ``whitened = (x - sums / n) @ vectors / sqrt(values)``."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray  # eigenvalues, falling; those that are zero are left out
    vectors: np.ndarray  # a unit eigenvector per column
    trace: float
    identity_error: float


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """``vectors`` with ``x array<long>`` beside the other columns, for rows whose vector has no null or non-finite entry.

    An entry whose 256-fold does not fit in a long raises an error.
    """
    def fits(c):
        c = c.cast("double")
        return F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))

    def whole(c):
        c = c.cast("double") * SCALE
        return F.when(F.abs(c) < float(1 << 62), F.floor(c)).otherwise(
            F.raise_error(F.lit("a component is too large for a whole number of 64 bits")).cast("long"))

    kept = vectors.where(F.col("embedding").isNotNull() & F.forall("embedding", fits))
    return kept.withColumn("x", F.transform("embedding", whole))


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dims)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, _ROWS):
            yield batch.slice(lo, _ROWS)


def column_sums(x: np.ndarray) -> np.ndarray:
    """Exact sums of the columns as Python integers."""
    if x.dtype == object:
        return x.sum(axis=0)
    high, low = x >> 31, x & ((1 << 31) - 1)
    return high.sum(axis=0).astype(object) * (1 << 31) + low.sum(axis=0).astype(object)


def square_sums(s: np.ndarray) -> np.ndarray:
    """Exact sums of the columns' squares as Python integers, in 64-bit steps where they suffice."""
    if s.dtype == object:
        return (s * s).sum(axis=0)
    most = max(abs(int(s.max())), abs(int(s.min())))
    if most * most * s.shape[0] < _LONG:
        return np.einsum("rp,rp->p", s, s).astype(object)
    # Three limbs: products stay below 2 ** 43, so a chunk's sums fit.
    mask = (1 << _LIMB) - 1
    a, b, c = s >> (2 * _LIMB), (s >> _LIMB) & mask, s & mask
    out = np.zeros(s.shape[1], object)
    for u, v, shift, times in ((a, a, 4, 1), (a, b, 3, 2), (a, c, 2, 2), (b, b, 2, 1), (b, c, 1, 2), (c, c, 0, 1)):
        out = out + np.einsum("rp,rp->p", u, v).astype(object) * (times << (shift * _LIMB))
    return out


def centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """``n * x - S``, exactly; Python integers where 64 bits do not hold the sum of two of them."""
    most = max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0
    if n * most + max(map(abs, sums), default=0) >= 1 << 61:
        return x.astype(object) * n - np.array(sums, object)
    return x * np.int64(n) - np.array(sums, np.int64)


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], _WHOLE)


def _sums(fit: DataFrame, dims: int) -> tuple[int, tuple[int, ...]]:
    def run(batches):
        n, total = 0, np.zeros(dims, object)
        for b in _chunks(batches):
            n, total = n + b.num_rows, total + column_sums(_matrix(b.column(0), dims))
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), _decimals(total)], names=["i", "n", "s"])

    rows = fit.mapInArrow(run, "i int, n long, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    got = sorted(rows.collect())  # one row per dimension
    return got[0]["n"], tuple(int(r["s"]) for r in got)


def _square_table(fit: DataFrame, n: int, sums: tuple[int, ...]) -> list[list[int]]:
    """``Q[i][j]`` for i <= j: sums of squares of centred dimension i (j = i) or of centred i plus centred j."""
    dims = len(sums)

    def run(batches):
        total = None
        for b in _chunks(batches):
            d = centred(_matrix(b.column(0), dims), n, sums)
            rows = [np.concatenate([square_sums(d[:, i : i + 1]), square_sums(d[:, i + 1 :] + d[:, i : i + 1]) if i + 1 < dims else []])
                    for i in range(dims)]
            one = np.concatenate(rows)
            total = one if total is None else total + one
        if total is not None:
            i, j = np.triu_indices(dims)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), _decimals(total)], names=["i", "j", "q"])

    rows = fit.mapInArrow(run, "i int, j int, q decimal(38,0)").groupBy("i", "j").agg(F.sum("q").alias("q"))
    table = [[0] * dims for _ in range(dims)]
    for r in rows.collect():  # one row per dimension and pair
        table[r["i"]][r["j"]] = int(r["q"])
    return table


def polarised(table: list[list[int]], n: int) -> np.ndarray:
    """The covariance matrix, every entry the nearest double of its exact value."""
    dims = len(table)
    v = np.empty((dims, dims))
    for i in range(dims):
        v[i, i] = table[i][i] / n**3
        for j in range(i + 1, dims):
            v[i, j] = v[j, i] = (table[i][j] - table[i][i] - table[j][j]) / (2 * n**3)
    return v


def _project(x: np.ndarray, n: int, sums: tuple[int, ...], values: np.ndarray, vectors: np.ndarray):
    d = centred(x, n, sums)
    return d, (d.astype(float) / n) @ vectors / np.sqrt(values)


def _identity_error(fit: DataFrame, n: int, sums: tuple[int, ...], values: np.ndarray, vectors: np.ndarray) -> float:
    k = len(values)

    def run(batches):
        total, any_row = np.zeros((k, k)), False
        for b in _chunks(batches):
            _, w = _project(_matrix(b.column(0), len(sums)), n, sums, values, vectors)
            total, any_row = total + w.T @ w, True
        if any_row:
            yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int32()), pa.array(total.ravel())], names=["at", "s"])

    rows = fit.mapInArrow(run, "at int, s double").groupBy("at").agg(F.sum("s").alias("s"))
    cov = np.zeros(k * k)
    for r in rows.collect():  # one row per pair of components
        cov[r["at"]] = r["s"] / n
    return float(np.abs(cov.reshape(k, k) - np.eye(k)).max())


def fit_whitening(spark: SparkSession, x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The map for the vectors ``x array<long>``; None when there is no vector, or all of them are equal or empty."""
    fit = stored(spark, x.select("x").distinct(), "whitening")
    sizes = fit.where(F.size("x") > 0).groupBy(F.size("x").alias("dims")).count()
    first = sizes.orderBy(F.desc("count"), F.desc("dims")).first()
    if first is None:
        return None
    fit = fit.where(F.size("x") == first["dims"])
    n, sums = _sums(fit, first["dims"])
    cov = polarised(_square_table(fit, n, sums), n)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    # Below this an eigenvalue is rounding of zero.
    real = int((values > max(values[0], 0) * len(sums) * np.finfo(float).eps).sum())
    if not real:
        return None
    keep = min(components, real)
    values, vectors = values[:keep].copy(), vectors[:, :keep].copy()
    largest = np.abs(vectors).argmax(axis=0)
    vectors *= np.sign(vectors[largest, np.arange(keep)])
    error = _identity_error(fit, n, sums, values, vectors)
    return Whitening(n, sums, values, vectors, float(np.trace(cov)), error)


def whiten(spark: SparkSession, vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` for every vector and component.

    ``vectors(vec_id, embedding)``; the fit list is each distinct integer vector once.

    * ``component`` counts from 1 by falling eigenvalue, at most ``components``; eigenvalues that are zero have none;
    * ``deviation`` is the exact sum of ``(n * x - S) ** 2`` over the dimensions, a ``decimal(38,0)``;
    * ``whitened`` has variance 1 over the fit list, ``identity_error`` is how far its covariance is from the identity;
    * rows whose vector is null or holds null or non-finite entries take no part; nor do vectors of another length than
      the one that most distinct vectors have (the longer on a tie), and empty vectors;
    * repeated rows and rows without ``vec_id`` each give their result; a table without two different vectors, and an
      empty one, give an empty result; other columns are ignored, whatever their names.
    """
    x = whole_vectors(vectors.select("vec_id", "embedding")).select("vec_id", "x")
    schema = f"vec_id {x.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation decimal(38,0), " \
             "whitened double, explained double, identity_error double"
    m = fit_whitening(spark, x, components)
    if m is None:
        return spark.createDataFrame([], schema)
    dims, k = len(m.sums), len(m.values)
    kind = to_arrow_type(x.schema["vec_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _chunks(batches):
            d, w = _project(_matrix(b.column(1), dims), m.n, m.sums, m.values, m.vectors)
            rows = np.repeat(np.arange(b.num_rows), k)
            far = square_sums(d.T)
            cols = [
                b.column(0).take(pa.array(rows)).cast(kind), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)),
                pa.array(np.full(rows.size, m.n, np.int64)), _decimals(far).take(pa.array(rows)), pa.array(w.ravel()),
                pa.array(np.tile(m.values / m.trace, b.num_rows)), pa.array(np.full(rows.size, m.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(
                cols, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.where(F.size("x") == dims).mapInArrow(run, schema)
