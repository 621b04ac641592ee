"""Whitening of embeddings on the leading components of their covariance, found by contour integration (FEAST,
Polizzi 2009).

An entry c becomes the whole number x = floor(64 c) + 1000000.  Sums and the
covariance are whole numbers too: x is centred by the whole number next to its
mean, products are summed exactly in tasks and by Spark, and the rest of the
mean is taken out in whole numbers before the one division, so the covariance
is the true one, rounded once.

The spectrum is cut into slices by inertia: the signs of the pivots of the
shifted, tridiagonal covariance count its eigenvalues above any shift.  Each
slice is a Spark task.  It projects random vectors onto the slice's
eigenvectors by a quadrature of (z - V)^-1 over a circle round the slice,
``NODES`` complex solves a round, extracts eigenpairs by Rayleigh-Ritz, and
repeats until the residual stops at rounding; it must find as many as the
inertia says.  The slices' vectors are made orthogonal by one last
Rayleigh-Ritz.  What reaches the driver or is broadcast is bounded by the
number of dimensions d: d (d + 1) / 2 covariances, and the components.

Rows whose vector is null or holds a null or non-finite entry are dropped.  A
vector shorter than the longest counts as if zeros followed.  Equal rows count
each.  Components are those with an eigenvalue above ``RANK`` times the largest:
constant dimensions, few rows or equal rows give fewer, a single row none.
Eigenvalues that are equal give some orthonormal basis of theirs.  An empty
table gives no rows.  The row's columns are in the struct ``row``, whatever
their names.  An entry of 2**46 or more cannot be told exactly and is an error.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import column, slices

COMPONENTS, SCALE, SHIFT = 32, 64, 1_000_000
NODES, SLICE, ROUNDS = 8, 6, 20
RANK = 1e-12
STEP = 1024  # vectors that a task holds as numbers at a time
_EXACT = 1 << 53


def _usable(vectors: str):
    return F.col(vectors).isNotNull() & F.forall(
        F.col(vectors), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    )


def _matrix(batch: pa.RecordBatch, dims: int | None = None) -> np.ndarray:
    """floor(64 c) of the batch's vectors, one row each, shorter ones filled with zeros."""
    lists = column(batch, "vector")
    sizes = np.asarray(lists.value_lengths(), dtype=np.int64)
    scaled = np.floor(SCALE * np.asarray(lists.flatten(), dtype=np.float64))
    if len(scaled) and np.abs(scaled).max() >= 1 << 52:
        raise ValueError("an entry is too large: 64 times it must stay below 2**52")
    width = dims if dims is not None else int(sizes.max(initial=0))
    if (sizes == width).all():
        return scaled.astype(np.int64).reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    out[owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = scaled
    return out


def _cells(names: np.ndarray, totals) -> pa.RecordBatch:
    numbers = pa.array([Decimal(int(t)) for t in totals], pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), numbers], names=["cell", "total"])


def _first_moments(batches):
    """Per task: rows (cell -1) and sums (cell = dimension) of floor(64 c)."""
    n, sums = 0, np.zeros(0, dtype=object)
    for batch in slices(batches, STEP):
        y = _matrix(batch)
        now = y.sum(axis=0).astype(object)
        if len(now) > len(sums):
            sums, now = now, sums
        sums[: len(now)] += now
        n += len(y)
    if n:
        yield _cells(np.arange(-1, len(sums)), [n, *sums])


def _products(z: np.ndarray) -> np.ndarray:
    """Exact z.T @ z."""
    most = int(np.abs(z).max(initial=0))
    if most * most * len(z) < _EXACT:
        return (z.astype(np.float64).T @ z).astype(np.int64).astype(object)
    z = z.astype(object)
    return z.T @ z


def _second_moments(centre: np.ndarray):
    upper = np.triu_indices(len(centre))

    def run(batches):
        total = None
        for batch in slices(batches, STEP):
            if batch.num_rows:
                now = _products(_matrix(batch, len(centre)) - centre)[upper]
                total = now if total is None else total + now
        if total is not None:
            yield _cells(np.arange(len(total)), total)

    return run


class Moments:
    """Number of vectors, sums and the covariance of x, exact until the one division."""

    def __init__(self, vectors: DataFrame):
        cells = "cell int, total decimal(38,0)"
        first = vectors.mapInArrow(_first_moments, cells).groupBy("cell").agg(F.sum("total").alias("total"))
        sums = {r.cell: int(r.total) for r in first.collect()}  # a number per dimension
        self.n = sums.pop(-1, 0)
        self.dims = len(sums)
        y_sums = [sums[i] for i in range(self.dims)]
        self.centre = np.array([(2 * s + self.n) // (2 * self.n) for s in y_sums], dtype=np.int64)
        self.rest = np.array([s - self.n * int(c) for s, c in zip(y_sums, self.centre)], dtype=object)
        self.sums = [s + self.n * SHIFT for s in y_sums]
        self.covariance = np.zeros((self.dims, self.dims))
        if not self.dims:
            return
        second = vectors.mapInArrow(_second_moments(self.centre), cells).groupBy("cell").agg(F.sum("total").alias("total"))
        found = {r.cell: int(r.total) for r in second.collect()}  # dims * (dims + 1) / 2 numbers
        for cell, (i, j) in enumerate(zip(*np.triu_indices(self.dims))):
            exact = self.n * found[cell] - int(self.rest[i]) * int(self.rest[j])
            self.covariance[i, j] = self.covariance[j, i] = exact / self.n**2

    def centred(self, batch: pa.RecordBatch) -> np.ndarray:
        """x - S / n."""
        return _matrix(batch, self.dims) - self.centre - (self.rest / self.n).astype(np.float64)

    def deviation(self, batch: pa.RecordBatch) -> pa.Array:
        """Sum over dimensions of (n x - S)**2, exact."""
        z = _matrix(batch, self.dims) - self.centre
        most = self.n * (int(np.abs(z).max(initial=0)) + 1)
        if most * most * max(1, self.dims) < 1 << 63:
            off = self.n * z - self.rest.astype(np.int64)
            return pa.array((off * off).sum(axis=1), pa.int64()).cast(pa.decimal128(38, 0))
        off = self.n * z.astype(object) - self.rest
        return pa.array([Decimal(sum(int(v) * int(v) for v in row)) for row in off], pa.decimal128(38, 0))


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a symmetric matrix after Householder reflections on both sides."""
    a = v.copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += norm if x[0] >= 0 else -norm
        x /= np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = 2 * (rest @ x)
        w = p - (x @ p) * x
        rest -= np.outer(x, w) + np.outer(w, x)
        a[k + 1 :, k] -= 2 * x * (x @ a[k + 1 :, k])
        a[k, k + 1 :] = a[k + 1 :, k]
    return np.diag(a).copy(), np.diag(a, -1).copy()


def count_above(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Inertia: how many eigenvalues lie above each shift, by the pivots of the shifted tridiagonal matrix."""
    tiny = np.finfo(float).tiny
    pivot = diagonal[0] - shifts
    above = (pivot > 0).astype(np.int64)
    for d, e in zip(diagonal[1:], off):
        pivot = d - shifts - e * e / np.where(pivot == 0, tiny, pivot)
        above += pivot > 0
    return above


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, bracketed by bisection on the inertia."""
    edge = np.r_[0, np.abs(off)] + np.r_[np.abs(off), 0]
    low, high = np.full(k, (diagonal - edge).min()), np.full(k, (diagonal + edge).max())
    span = high[0] - low[0]
    low, high = low - 1e-3 * span - 1e-300, high + 1e-3 * span + 1e-300
    rank = np.arange(k)
    for _ in range(60):
        middle = (low + high) / 2
        up = count_above(diagonal, off, middle) > rank
        low, high = np.where(up, middle, low), np.where(up, high, middle)
    return (low + high) / 2


def spectrum_slices(v: np.ndarray, components: int = COMPONENTS) -> tuple[int, list[tuple[float, float, int]]]:
    """(k, slices): k components are wanted, and slices (low, high, count) cover their eigenvalues, cut at wide gaps."""
    if not len(v):
        return 0, []
    diagonal, off = tridiagonal(v)
    values = leading_values(diagonal, off, len(v))
    rank = int((values > RANK * max(values[0], 0.0)).sum()) if values[0] > 0 else 0
    k = min(components, rank)
    slices_, top, at = [], None, 0
    gaps = np.r_[values[: rank - 1] - values[1:rank], values[rank - 1] - max(values[rank], 0.0) if rank < len(v) else values[rank - 1]] if rank else []
    while at < k:
        # The cut after one of the next eigenvalues that has the widest gap below it, relative to the slice's height.
        last = min(at + SLICE, rank)
        ends = np.arange(at, last)
        end = int(ends[np.argmax(np.asarray(gaps)[ends] / values[ends])])
        while end + 1 < rank and gaps[end] <= 1e-6 * values[end]:
            end += 1  # never through a cluster
        below = max(values[end + 1], 0.0) if end + 1 < len(v) else 0.0
        bottom = (values[end] + below) / 2
        if top is None:
            top = values[0] + max((values[0] - bottom) / 2, 1e-9 * values[0])
        count = int(np.subtract(*count_above(diagonal, off, np.array([bottom, top]))))
        slices_.append((float(bottom), float(top), count))
        top, at = bottom, end + 1
    return k, slices_


def contour_pairs(v: np.ndarray, low: float, high: float, count: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` eigenvalues of ``v`` in (low, high) and their unit eigenvectors (columns)."""
    n = len(v)
    scale = np.abs(v).sum(axis=1).max()
    centre, radius = (low + high) / 2, (high - low) / 2
    turns = np.exp(1j * np.pi * (np.arange(nodes) + 0.5) / nodes)
    kept, best = None, np.inf
    for size in sorted({min(n, 2 * count + 4), min(n, 4 * count + 8), n}):
        y = np.random.default_rng(n * 1009 + size).standard_normal((n, size))
        last = np.inf
        for _ in range(ROUNDS):
            y = sum((radius * t * np.linalg.solve((centre + radius * t) * np.eye(n) - v, y)).real for t in turns) / nodes
            basis = np.linalg.qr(y)[0]
            ritz, turn = np.linalg.eigh(basis.T @ v @ basis)
            y = basis @ turn
            inside = (ritz > low) & (ritz < high)
            if inside.sum() != count:
                continue
            left = np.abs(v @ y[:, inside] - y[:, inside] * ritz[inside]).max(initial=0.0) / scale
            if left < best:
                best, kept = left, (ritz[inside], y[:, inside])
            if left <= 1e-16 * n or left > 0.9 * last:
                break
            last = left
        if best <= 1e-15 * n:
            return kept
    if kept is None or best > 1e-12 * n:
        raise ArithmeticError(f"the inertia has {count} eigenvalues in ({low}, {high}), the projection found others")
    return kept


def _solve(matrix):
    """mapInArrow over slices: the eigenpairs of each."""

    def run(batches):
        for batch in batches:
            for low, high, count in zip(*(column(batch, c).to_pylist() for c in ("low", "high", "count"))):
                values, vectors = contour_pairs(matrix.value, low, high, count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values, pa.float64()), pa.array(list(vectors.T), pa.list_(pa.float64()))], names=["value", "vector"]
                )

    return run


class Components:
    """Unit eigenvectors (columns) by falling eigenvalue."""

    def __init__(self, spark, covariance: np.ndarray, components: int = COMPONENTS):
        k, cut = spectrum_slices(covariance, components)
        self.values, self.vectors = np.zeros(0), np.zeros((len(covariance), 0))
        if not k:
            return
        matrix = spark.sparkContext.broadcast(covariance)  # dims**2 numbers
        frame = spark.createDataFrame(cut, "low double, high double, count bigint").repartition(len(cut), "low")
        pairs = frame.mapInArrow(_solve(matrix), "value double, vector array<double>").collect()  # the wanted components
        if len(pairs) != sum(c for _, _, c in cut):
            raise ArithmeticError("a slice of the spectrum is missing")
        basis = np.linalg.qr(np.array([r.vector for r in sorted(pairs, key=lambda r: -r.value)]).T)[0]
        ritz, turn = np.linalg.eigh(basis.T @ covariance @ basis)
        order = np.argsort(-ritz, kind="stable")[:k]
        self.values, self.vectors = ritz[order], (basis @ turn)[:, order]


_SPREAD = "part int, n bigint, mean array<double>, squares array<double>"


def _merge(a, b):
    """(n, mean, sum of squares about it) of two groups of rows."""
    n = a[0] + b[0]
    off = b[1] - a[1]
    return n, a[1] + off * (b[0] / n), a[2] + b[2] + np.outer(off, off) * (a[0] * b[0] / n)


def _spread_row(part: int, spread) -> dict:
    n, mean, squares = spread
    return {"part": [part], "n": [n], "mean": [mean], "squares": [squares.ravel()]}


def _spread(moments: Moments, whiten: np.ndarray):
    from pyspark import TaskContext

    def run(batches):
        total = None
        for batch in slices(batches, STEP):
            if batch.num_rows:
                w = moments.centred(batch) @ whiten
                mean = w.mean(axis=0)
                now = len(w), mean, (w - mean).T @ (w - mean)
                total = now if total is None else _merge(total, now)
        if total is not None:
            row = _spread_row(TaskContext.get().partitionId(), total)
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(row.values(), kinds)], names=list(row))

    return run


def _merged(rows) -> tuple:
    total = None
    for n, mean, squares in rows:
        mean = np.asarray(mean)
        now = n, mean, np.asarray(squares).reshape(len(mean), len(mean))
        total = now if total is None else _merge(total, now)
    return total


def _merge_spreads(table: pa.Table) -> pa.Table:
    total = _merged(zip(*(table.column(c).to_pylist() for c in ("n", "mean", "squares"))))
    row = _spread_row(0, total)
    kinds = [pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
    return pa.table({name: pa.array(c, t) for (name, c), t in zip(row.items(), kinds)})


def identity_error(vectors: DataFrame, moments: Moments, whiten: np.ndarray, groups: int = 64) -> float:
    """Largest absolute entry of (covariance of the whitened vectors - identity), measured on them."""
    spreads = vectors.mapInArrow(_spread(moments, whiten), _SPREAD)
    spreads = spreads.groupBy(F.pmod("part", F.lit(groups)).alias("group")).applyInArrow(_merge_spreads, _SPREAD)
    n, _, squares = _merged((r.n, r.mean, r.squares) for r in spreads.collect())  # at most ``groups`` rows
    return float(np.abs(squares / n - np.eye(whiten.shape[1])).max(initial=0.0))


def _project(moments: Moments, whiten: np.ndarray):
    k = whiten.shape[1]

    def run(batches):
        for batch in slices(batches, STEP):
            if not batch.num_rows:
                continue
            rows = pa.array(np.repeat(np.arange(batch.num_rows), k), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "row").take(rows),
                    pa.array(np.tile(np.arange(1, k + 1), batch.num_rows), pa.int32()),
                    moments.deviation(batch).take(rows),
                    pa.array((moments.centred(batch) @ whiten).ravel(), pa.float64()),
                ],
                names=["row", "component", "deviation", "whitened"],
            )

    return run


def whiten(df: DataFrame, vectors: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: ``row`` (the columns of ``df`` but the vector), ``component`` from 1 on,
    ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``."""
    others = [F.col(f"`{c}`") for c in df.columns if c != vectors]
    name = f"`{vectors}`"
    row = F.struct(*(others or [F.lit(0).alias("none")])).alias("row")
    packed = df.filter(_usable(name)).select(row, F.col(name).cast("array<double>").alias("vector"))
    bare = packed.select("vector")
    moments = Moments(bare)
    found = Components(df.sparkSession, moments.covariance, components)
    k = len(found.values)
    scaled = found.vectors / np.sqrt(found.values)
    error = identity_error(bare, moments, scaled) if k else 0.0
    schema = packed.selectExpr("row", "1 as component", "cast(0 as decimal(38,0)) as deviation", "0D as whitened").schema
    trace = float(np.trace(moments.covariance))
    shares = F.array(*(F.lit(float(e / trace)) for e in found.values)) if k else F.array(F.lit(0.0))
    return packed.mapInArrow(_project(moments, scaled), schema).select(
        "row",
        "component",
        F.lit(moments.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("component")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
