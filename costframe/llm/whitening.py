"""Embedding whitening by spectrum slicing.

Entries become integers (``STEP`` to a unit, ``SHIFT`` added), so the sums, the
covariance's numerators and each row's deviation are exact.  Spark adds up the
sums of the entries, then the products of entries centred at the rounded mean;
both come to the driver as one number a cell of the dimension or its square,
however many rows there are.

The leading eigenvalues of the covariance V are found on the driver by slicing
its spectrum: the inertia of V - s I, read off the pivots of a pivoted LDL^T
factorisation (Sylvester's law), is the number of eigenvalues above s.  Bisection
on these counts isolates each eigenvalue in an interval of its own, Rayleigh
quotient iteration started there converges cubically, and two more counts beside
the result certify that it is the k-th.  Eigenvalues that no double separates
are taken together as a subspace.

Scoring projects each row beside the scan, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costframe.llm.common import saved, table

STEP = 1024
SHIFT = 100_000
COMPONENTS = 8
#: Entries of vectors worked on at once.
ENTRIES = 1 << 20
EPS = float(np.finfo(float).eps)
CELLS = "i int, j int, total decimal(38,0)"


# ------------------------------------------------------------------ spectrum
def count_above(v: np.ndarray, s: float) -> int:
    """How many eigenvalues of the symmetric ``v`` exceed ``s``: the positive pivots of L D L^T = v - s I.

    Bunch and Parlett's pivoting: a block of two is taken only where its
    determinant is negative, so it has one positive eigenvalue.
    """
    a = v - s * np.eye(len(v))
    positive = 0
    while len(a):
        size = np.abs(a)
        p = int(np.argmax(np.diagonal(size)))
        most = size[p, p]
        np.fill_diagonal(size, -1.0)
        q, r = divmod(int(np.argmax(size)), len(a))
        if most == 0 and size[q, r] <= 0:
            break
        if most >= 0.6403882032022076 * size[q, r]:  # (1 + sqrt(17)) / 8
            positive += a[p, p] > 0
            col = np.delete(a[:, p], p)
            a = np.delete(np.delete(a, p, 0), p, 1) - np.outer(col, col) / a[p, p]
        else:
            positive += 1
            cols = np.delete(a[:, [q, r]], [q, r], 0)
            block = a[np.ix_([q, r], [q, r])]
            a = np.delete(np.delete(a, [q, r], 0), [q, r], 1) - cols @ np.linalg.solve(block, cols.T)
        a = (a + a.T) / 2
    return int(positive)


def _solved(v: np.ndarray, s: float, x: np.ndarray, scale: float) -> np.ndarray:
    """(v - s I)^-1 x, the shift moved off an eigenvalue that it hits."""
    eye = np.eye(len(v))
    for nudge in (0.0, 4 * EPS * scale, 64 * EPS * scale):
        try:
            y = np.linalg.solve(v - (s + nudge) * eye, x)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(y).all():
            return y
    return x


def _clear(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """Orthonormal columns for ``x``, without the directions already ``found``."""
    x = x / np.maximum(np.abs(x).max(0), 1e-300)
    for _ in range(2):
        for u in found:
            x = x - np.outer(u, u @ x)
        x = np.linalg.qr(x)[0]
    return x


def leading(v: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns): the first ``components`` of the positive semidefinite
    ``v``, fewer if its rank (to double precision) is less."""
    d = len(v)
    scale = min(float(np.trace(v)), float(np.abs(v).sum(1).max())) if d else 0.0
    if not scale > 0:
        return np.zeros(0), np.zeros((d, 0))
    least = d * EPS * scale
    known = {scale * (1 + 1e-9): 0}  # shift -> eigenvalues above it

    def count(s: float) -> int:
        if s not in known:
            known[s] = count_above(v, s)
        return known[s]

    rank = count(least)
    start = np.random.default_rng(5).normal(size=(d, components))
    values: list[float] = []
    found: list[np.ndarray] = []
    k = 1
    while k <= min(components, rank):
        lo = max(s for s, c in known.items() if c >= k)
        hi = min(s for s, c in known.items() if c < k)
        inside = known[lo] - known[hi]
        narrow = hi - lo <= 16 * EPS * scale
        if inside > 1 and not narrow:
            count((lo + hi) / 2)
            continue
        many = min(inside, components - k + 1)
        x = start[:, :many]
        for _ in range(3):
            x = _clear(_solved(v, (lo + hi) / 2, _clear(x, found), scale), found)
        if inside == 1:
            u = x[:, 0]
            e = float(u @ v @ u)
            for _ in range(8):  # cubic convergence: a few steps reach rounding
                if np.linalg.norm(v @ u - e * u) <= 4 * EPS * scale:
                    break
                u = _clear(_solved(v, e, u[:, None], scale), found)[:, 0]
                e = float(u @ v @ u)
            margin = max(8 * d * EPS * scale, 1e-11 * e)
            certified = lo - margin <= e <= hi + margin and (count(e - margin) >= k > count(e + margin))
            if not certified and not narrow:
                count((lo + hi) / 2)
                continue
            x = u[:, None]
        e = np.einsum("ij,ij->j", x, v @ x)
        for c in np.argsort(-e, kind="stable"):
            u = x[:, c]
            values.append(float(e[c]))
            found.append(u if u[np.argmax(np.abs(u))] > 0 else -u)
        k += many
    return np.array(values), np.column_stack(found) if found else np.zeros((d, 0))


# ------------------------------------------------------------------ exact sums
def integer_vectors(rows: DataFrame, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(ident, x): the usable vectors as arrays of long; the longest length is the dimension.

    Vectors that are null or empty, or hold null or non-finite entries, are left
    out; entries that a shorter vector lacks count as null.
    """
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    good = rows.select(F.col(ident), F.col(vector).cast("array<double>").alias("x"))
    good = good.where(F.col("x").isNotNull() & (F.size("x") > 0) & F.forall("x", entry))
    size = good.agg(F.max(F.size("x"))).first()[0] or 0
    return good.where(F.size("x") == size).select(ident, F.transform("x", lambda c: F.floor(c * STEP) + SHIFT).alias("x"))


def _matrices(col: pa.Array) -> Iterator[np.ndarray]:
    """The vectors of a batch as integer matrices of about ``ENTRIES`` entries."""
    flat, n = col.flatten().to_numpy(zero_copy_only=False), len(col)
    x = flat.reshape(n, -1) if n else flat.reshape(0, 0)
    step = max(1, ENTRIES // max(x.shape[1], 1))
    for k in range(0, n, step):
        yield x[k:k + step]


def _totals(cells: np.ndarray, count: int) -> Iterator[pa.RecordBatch]:
    """Rows (i, j, total) of a symmetric matrix of Python integers (its upper triangle), or of a vector (j = -1), and the count (i = j = -1)."""
    if cells.ndim == 1:
        i, j = np.arange(len(cells)), np.full(len(cells), -1)
    else:
        i, j = np.triu_indices(len(cells))
    got = cells[i] if cells.ndim == 1 else cells[i, j]
    total = [Decimal(int(t)) for t in got] + [Decimal(count)]
    yield pa.RecordBatch.from_arrays([pa.array(np.append(i, -1), pa.int32()), pa.array(np.append(j, -1), pa.int32()),
                                      pa.array(total, pa.decimal128(38, 0))], names=["i", "j", "total"])


def _small(values: np.ndarray) -> int:
    """The largest absolute value, as a Python integer."""
    return max(int(values.max()), -int(values.min())) if values.size else 0


def entry_sums(x: np.ndarray) -> np.ndarray:
    """Exact sums of the columns, as Python integers."""
    return (x if _small(x) * len(x) < 1 << 62 else x.astype(object)).sum(0).astype(object)


def product_sums(z: np.ndarray) -> np.ndarray:
    """Exact z^T z as Python integers: in doubles where these hold every partial sum, else in Python."""
    most = _small(z)
    step = (1 << 53) // max(most * most, 1)
    out = np.zeros((z.shape[1],) * 2, object)
    if step == 0:
        wide = z.astype(object)
        return wide.T @ wide
    for k in range(0, len(z), step):
        part = z[k:k + step].astype(float)
        out = out + (part.T @ part).astype(np.int64).astype(object)
    return out


def _added(rows: DataFrame, kernel, centre: list[int] | None) -> dict[tuple[int, int], int]:
    """The cells of ``kernel`` over all vectors: as many numbers reach the driver as the kernel has cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, count = None, 0
        for batch in batches:
            for x in _matrices(batch.column(0)):
                got = kernel(x if centre is None else x - np.array(centre, np.int64))
                cells, count = got if cells is None else cells + got, count + len(x)
        if cells is not None:
            yield from _totals(cells, count)

    cells = rows.select("x").mapInArrow(run, CELLS).groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    return {(r.i, r.j): int(r.total) for r in cells}


# ------------------------------------------------------------------ the operator
def whitened(rows: DataFrame, components: int = COMPONENTS, ident: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """For each usable vector and component: ident, component, n, deviation, whitened, explained, identity_error.

    Unusable vectors: see ``integer_vectors``.  Repeated rows and ids have rows
    of their own; null ids stay; other columns are ignored.  Components without
    variance (all vectors equal, fewer dimensions than ``components``, an empty
    table) have no rows.  Equal eigenvalues share their space: any basis of it is
    right, and the same one serves all rows.  ``deviation`` is decimal(38,0).
    """
    x = integer_vectors(rows, ident, vector)
    sums = _added(x, entry_sums, None)
    n = sums.pop((-1, -1), 0)
    d = len(sums)
    total = [sums[k, -1] for k in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in total]  # the rounded mean
    rest = [n * c - s for c, s in zip(centre, total, strict=True)]
    products = _added(x, product_sums, centre) if n else {}
    # n*n*V, exact: sums of products around the rounded mean, less that mean's own offset.
    v = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            v[i, j] = v[j, i] = (n * products[i, j] - rest[i] * rest[j]) / (n * n)
    values, vectors = leading(v, components)
    trace = float(np.trace(v)) or 1.0
    axes = vectors / np.sqrt(values) if len(values) else vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, odd = np.array(centre, np.int64), np.array([r / n for r in rest])
        for batch in batches:
            at = 0
            for m in _matrices(batch.column(1)):
                z = m - middle
                wide = _small(z) * n + n  # bounds |n*x - S|
                own = z if wide * wide * d < 1 << 62 else z.astype(object)
                far = ((own * n + np.array(rest, own.dtype)) ** 2).sum(1)
                out = ((z + odd) @ axes).ravel()
                cuts = pa.array(np.arange(len(z) + 1) * axes.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(z)), pa.array([Decimal(int(t)) for t in far], pa.decimal128(38, 0)),
                     pa.ListArray.from_arrays(cuts, pa.array(out))], names=[ident, "deviation", "whitened"])
                at += len(z)

    kind = dict(x.dtypes)[ident]
    out = saved(x.mapInArrow(run, f"`{ident}` {kind}, deviation decimal(38,0), whitened array<double>"), "whitened") if n else (
        x.select(ident, F.lit(None).cast("decimal(38,0)").alias("deviation"), F.array().cast("array<double>").alias("whitened")))
    error = identity_error(out, len(values))
    share = F.array(*[F.lit(float(e) / trace) for e in values]) if len(values) else F.array().cast("array<double>")
    return out.select(ident, "deviation", F.posexplode("whitened").alias("at", "value")).select(
        ident, (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        F.col("value").alias("whitened"), F.get(share, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def identity_error(out: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` (centred first) minus the identity."""
    if not components:
        return 0.0
    w = out.select(*[F.col("whitened")[k].alias(f"w{k}") for k in range(components)])
    mean = w.agg(*[F.avg(c).alias(c) for c in w.columns]).first()
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    got = w.agg(*[F.avg((F.col(f"w{i}") - F.lit(mean[i])) * (F.col(f"w{j}") - F.lit(mean[j]))) for i, j in pairs]).first()
    return max(abs(got[k] - (i == j)) for k, (i, j) in enumerate(pairs))


def op12_spectrum_slicing(spark, sf_dir: str) -> DataFrame:
    """``deviation`` as a long; null where 64 bits do not hold it."""
    return whitened(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))
