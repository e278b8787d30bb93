"""Whitening of vectors on their principal components, by QDWH divide and conquer.

Entries become whole numbers, ``floor(256 c)``. Each distinct vector counts once in
the covariance. Sums are exact; the covariance is summed from centred vectors in
the tasks, and only a matrix of dimension squared reaches the driver.

There the polar factor ``U`` of ``V - s I`` (QDWH iteration: QR-based, dynamically
weighted Halley) gives the projector ``(U + I) / 2`` on the eigenvectors above ``s``.
The two invariant subspaces are split again in the same way, until each is one
component; a part that holds no wanted component is left whole. The components are
broadcast and all rows are projected in numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from biomeframe.llm.common import shipped
from biomeframe.session import stored

SCALE = 256
COMPONENTS = 4
_EPS = np.finfo(float).eps
_LONG = (1 << 63) - 1


@dataclass
class Whitening:
    n: int  # distinct vectors
    sums: list[int]  # of their entries
    vectors: np.ndarray  # dimension x components, unit columns
    values: np.ndarray  # variance along each, falling
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n, where the whole part of the mean goes first, in integers."""
        whole, part = self._mean()
        return (x - whole).astype(float) - part

    def _mean(self) -> tuple[np.ndarray, np.ndarray]:
        both = [divmod(s, self.n) for s in self.sums]
        return np.array([a for a, _ in both], dtype=np.int64), np.array([b / self.n for _, b in both])

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of the rows; NaN along components without variance."""
        some = self.values > len(self.sums) * _EPS * self.trace
        scale = np.where(some, np.sqrt(np.where(some, self.values, 1.0)), np.nan)
        return self.centred(x) @ self.vectors / scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - sums)^2 over the entries of each row, exact; None above the range of a long."""
        whole, _ = self._mean()
        off = x - whole
        rest = np.array([s - self.n * int(w) for s, w in zip(self.sums, whole)], dtype=np.int64)
        most = (max(-int(off.min()), int(off.max())) + 1) * self.n if off.size else 0
        if most * most * len(self.sums) <= _LONG:
            return ((off * self.n - rest) ** 2).sum(axis=1).tolist()
        exact = ((off.astype(object) * self.n - rest) ** 2).sum(axis=1).tolist()
        return [v if v <= _LONG else None for v in exact]


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal factor of a square matrix, by the QR form of the QDWH iteration."""
    size = len(a)
    x = a / max(np.linalg.norm(a), np.finfo(float).tiny)
    low, eye = _EPS, np.eye(size)  # a lower bound of the singular values, or the least that counts
    for _ in range(30):
        d = np.cbrt(4 * max(1 - low * low, 0.0) / low**4)
        root = np.sqrt(1 + d)
        f = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - low * low) / (low * low * root), 0.0))
        g = (f - 1) ** 2 / 4
        h = f + g - 1
        q, _ = np.linalg.qr(np.vstack((np.sqrt(h) * x, eye)))
        new = g / h * x + (f - g / h) / np.sqrt(h) * (q[:size] @ q[size:].T)
        low = min(low * (f + g * low * low) / (1 + h * low * low), 1.0)
        step, x = np.linalg.norm(new - x), new
        if abs(1 - low) < 10 * _EPS and step < np.cbrt(_EPS) * np.sqrt(size):
            break
    return x


def _split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the eigenvectors of ``a`` above and below some value.

    The mean of the eigenvalues always has some on both sides; the median of the
    diagonal halves better. Of shifts that leave the parts coupled the best is taken.
    """
    size = len(a)
    diagonal, best, least = np.diag(a), None, np.inf
    spread = diagonal.max() - diagonal.min()
    shifts = [np.median(diagonal), diagonal.mean(), *(diagonal.mean() + spread * k / 16 for k in (-1, 1, -3, 3))]
    draws = np.random.default_rng(size).standard_normal((size, size))
    for shift in shifts:
        projector = (polar_factor(a - shift * np.eye(size)) + np.eye(size)) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < size:
            continue
        q = np.linalg.qr(projector @ draws[:, :rank])[0]
        q = np.linalg.qr(projector @ q, mode="complete")[0]
        above, below = q[:, :rank], q[:, rank:]
        coupled = np.linalg.norm(below.T @ a @ above)
        if coupled < least:
            best, least = (above, below), coupled
        if coupled <= 4 * size * _EPS * np.linalg.norm(a):
            break
    if best is None:  # equal eigenvalues, to rounding: any cut is one
        best = np.eye(size)[:, : size // 2], np.eye(size)[:, size // 2 :]
    return best


def _eigenvectors(a: np.ndarray, wanted: int) -> np.ndarray:
    size = len(a)
    rest = a - np.diag(np.diag(a))
    if size == 1 or np.linalg.norm(rest) <= _EPS * np.linalg.norm(a):
        return np.eye(size)[:, np.argsort(-np.diag(a), kind="stable")[:wanted]]
    parts = []
    for basis in _split(a):
        if wanted > 0:
            inner = basis.T @ a @ basis
            parts.append(basis @ _eigenvectors((inner + inner.T) / 2, wanted))
            wanted -= basis.shape[1]
    return np.hstack(parts)


def principal_components(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and unit vectors."""
    if not a.size or not np.linalg.norm(a):
        return np.zeros(min(wanted, len(a))), np.eye(len(a))[:, :wanted]
    vectors = np.linalg.qr(_eigenvectors(a / np.linalg.norm(a), min(wanted, len(a))))[0]
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _integers(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and x of the rows whose vector is there, not empty and finite throughout."""

    def finite(c: Column) -> Column:
        c = c.cast("double")
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    good = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", finite)
    rows = df.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("v")).filter(good)
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0), dtype=np.int64)


_CELLS = StructType([
    StructField("cell", IntegerType()), StructField("value", DoubleType()),
])


def _gram(x: DataFrame, rows_of) -> dict[int, float]:
    """Sums over all rows of products of entries of ``rows_of(x)``, upper triangle, by cell number."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                y = rows_of(_matrix(batch.column(0)))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            cells = np.flatnonzero(np.triu(np.ones_like(total)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cells, pa.int32()), pa.array(total.ravel()[cells], pa.float64())], names=_CELLS.names
            )

    # A matrix a task, summed cell by cell: at most dimension squared rows reach the driver.
    found = x.mapInArrow(of, _CELLS).groupBy("cell").agg(F.sum("value").alias("value")).collect()
    return {r.cell: r.value for r in found}


def _symmetric(cells: dict[int, float], size: int) -> np.ndarray:
    out = np.zeros(size * size)
    out[list(cells)] = list(cells.values())
    out = out.reshape(size, size)
    return np.triu(out) + np.triu(out, 1).T


def _sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number and exact sums of the vectors; halves of the entries are summed apart."""
    schema = StructType([
        StructField("cell", IntegerType()),
        *[StructField(c, LongType()) for c in ("n", "high", "low")],
    ])

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low = 0, np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0))
                n, high, low = n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)
        columns = np.arange(size, dtype=np.int32), np.full(size, n), high, low
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names)

    parts = fit.mapInArrow(of, schema).groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")])
    rows = sorted(parts.collect())
    return rows[0].n, [(r.high << 32) + r.low for r in rows]


def fit_whitening(
    df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> tuple[Whitening | None, float | None]:
    """Components of the distinct vectors, and the error of the whitened covariance.

    The error is the largest absolute entry of the covariance of the whitened
    distinct vectors (components with variance) minus the identity, measured in a
    pass of its own; None if no component has variance. Vectors of another length
    than the most frequent one (of several, the largest) are left out, as are null
    and empty ones and those with a null or non-finite entry. Without any vector
    the result is None. Entries beyond a long after scaling take the nearest long.

    Distinct vectors are written once to the shared folder.
    """
    shipped(df.sparkSession)
    fit = stored(_integers(df, vec_id, vector).select("x").distinct(), "vectors")
    sizes = fit.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if sizes is None:
        return None, None
    size = sizes["size"]
    fit = fit.filter(F.size("x") == size)
    n, sums = _sums(fit, size)
    model = Whitening(n, sums, np.zeros((size, 0)), np.zeros(0), 0.0)
    covariance = _symmetric(_gram(fit, model.centred), size) / n
    model.trace = float(np.trace(covariance))
    model.values, model.vectors = principal_components(covariance, components)
    if not np.isfinite(model.project(np.zeros((1, size), dtype=np.int64))).any():
        return model, None
    whitened = _symmetric(_gram(fit, model.project), len(model.values)) / n
    some = np.isfinite(np.diag(whitened))
    off = whitened[np.ix_(some, some)] - np.eye(some.sum())
    return model, float(np.abs(off).max())


def whiten(
    df: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error.

    One row for each component (numbered from 1) of each row of ``df`` that
    ``fit_whitening`` does not leave out; repeated rows and null ids stay. n is the
    number of distinct vectors, deviation the exact squared distance of n times the
    vector from their sum (null above the range of a long), whitened the coordinate
    along the component over its standard deviation (null without variance),
    explained its share of the variance (null if there is none at all).
    """
    model, error = fit_whitening(df, vec_id=vec_id, vector=vector, components=components)
    rows = _integers(df, vec_id, vector)
    schema = StructType([
        rows.schema["vec_id"], StructField("component", IntegerType()), StructField("n", LongType()),
        StructField("deviation", LongType()), StructField("whitened", DoubleType()),
        StructField("explained", DoubleType()), StructField("identity_error", DoubleType()),
    ])
    if model is None:
        return df.sparkSession.createDataFrame([], schema)
    shared = df.sparkSession.sparkContext.broadcast(model)  # dimension x components numbers

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        k = len(m.values)
        explained = [float(v / m.trace) if m.trace else None for v in m.values]
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            x = _matrix(batch.column(1))
            flat = m.project(x).ravel()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(size), k))),
                 pa.array(np.tile(np.arange(1, k + 1), size), pa.int32()),
                 pa.array(np.full(size * k, m.n), pa.int64()),
                 pa.array(m.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(size), k))),
                 pa.array(flat, pa.float64(), mask=np.isnan(flat)),
                 pa.array(explained * size, pa.float64()),
                 pa.array([error] * (size * k), pa.float64())],
                names=schema.names,
            )

    return rows.filter(F.size("x") == len(model.sums)).mapInArrow(of, schema)
