"""Embedding whitening: blockwise QR of the centred rows, Householder bidiagonalisation, dqds for singular values, twisted factorisations for directions.

The covariance matrix is never formed: the triangular factor R of the centred rows has R'R = n * covariance, so small variances keep their digits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import materialise

ADDED = ("n", "deviation", "whitened")
BLOCK_ROWS = 4096
FAN = 32  # factors merged by one task
_EPS = 2.0**-52
_LARGEST = 2**62


@dataclass(frozen=True)
class Whitening:
    """Exact sums of the fitted rows and the directions of their covariance, by falling variance."""

    n: int
    sums: np.ndarray         # int64, one a dimension
    variances: np.ndarray    # of the kept directions
    directions: np.ndarray   # dimensions x directions, unit columns
    total: float             # sum of the variances of all dimensions
    scale: float
    offset: int

    @property
    def explained(self) -> np.ndarray:
        return self.variances / self.total if len(self.variances) else self.variances

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n times the distance from the mean, in whole numbers."""
        return self.n * x - self.sums

    def project(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) / self.n) @ (self.directions / np.sqrt(self.variances))


# ---- rows --------------------------------------------------------------------------------------


def fixed_point(column: pa.Array, scale: float, offset: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(usable rows, their lengths, entries of usable rows as whole numbers floor(scale * c) + offset, end to end).

    A row is usable if it is not null or empty and all its entries are finite.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = column.flatten()  # leaves null rows out
    values = entries.cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    usable = (sizes > 0) & (bad[ends] == bad[ends - sizes])
    kept = values[np.repeat(usable, sizes)]
    scaled = np.floor(scale * kept)
    if len(scaled) and np.abs(scaled).max() >= 2.0**52:
        raise ValueError("an entry is too large for exact sums: lower the scale")
    return usable, sizes[usable], scaled.astype(np.int64) + offset


def _matrix(batch: pa.RecordBatch, place: int, width: int, scale: float, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the wanted width: a mask over the batch and a matrix of whole numbers."""
    usable, sizes, flat = fixed_point(batch.column(place), scale, offset)
    right = sizes == width
    mask = usable.copy()
    mask[usable] = right
    return mask, flat[np.repeat(right, sizes)].reshape(-1, width)


def _fold(parts: DataFrame, merge: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """One array from many (`part`, `body`), merged FAN at a time by Spark tasks; only the last comes to the driver."""
    parts = materialise(parts)
    schema = "part bigint, body array<double>"

    def task(key: tuple, group: pa.Table) -> pa.Table:
        bodies = [np.asarray(b) for b in group.sort_by("part").column("body").to_pylist()]
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "body": pa.array([merge(bodies)], pa.list_(pa.float64()))})

    while True:
        top = parts.agg(F.max("part")).first()[0]
        if top is None:
            return None
        parts = materialise(parts.groupBy(F.expr(f"part DIV {FAN}").alias("group")).applyInArrow(task, schema))
        if top < FAN:
            return np.asarray(parts.first()["body"])


# ---- fitting -----------------------------------------------------------------------------------


def exact_sums(rows: DataFrame, vector: str, scale: float, offset: int) -> tuple[int, np.ndarray]:
    """Number of usable rows of the most frequent length (ties: the longer) and their sums a dimension."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            _, sizes, flat = fixed_point(batch.column(0), scale, offset)
            for width in np.unique(sizes).tolist():
                right = sizes == width
                part = flat[np.repeat(right, sizes)].reshape(-1, width)
                held = totals.setdefault(width, [0, np.zeros(width, np.int64)])
                held[0] += len(part)
                held[1] += part.sum(axis=0)
        for width, (n, sums) in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([width], pa.int64()), pa.array([n], pa.int64()), pa.array([sums], pa.list_(pa.int64()))], names=["width", "n", "sums"]
            )

    parts = materialise(rows.select(F.col(vector).alias("v")).mapInArrow(work, "width bigint, n bigint, sums array<bigint>"))
    best = parts.groupBy("width").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if best is None:
        return 0, np.zeros(0, np.int64)
    sums = parts.where(F.col("width") == best["width"]).select(F.posexplode("sums").alias("k", "s")).groupBy("k").agg(F.sum("s").alias("s"))
    return best["n"], np.array([r["s"] for r in sums.orderBy("k").collect()], np.int64)  # one row a dimension


def triangular_factor(rows: DataFrame, vector: str, n: int, sums: np.ndarray, scale: float, offset: int) -> np.ndarray:
    """R of the centred rows: each task reduces its rows block by block, then factors are stacked and reduced."""
    width = len(sums)

    def reduced(blocks: list[np.ndarray]) -> np.ndarray:
        return np.linalg.qr(np.concatenate(blocks), mode="r")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = np.zeros((0, width))
        for batch in batches:
            _, x = _matrix(batch, 0, width, scale, offset)
            for k in range(0, len(x), BLOCK_ROWS):
                factor = reduced([factor, (n * x[k : k + BLOCK_ROWS] - sums) / n])
        if len(factor):
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([factor.ravel()], pa.list_(pa.float64()))], names=["part", "body"]
            )

    parts = rows.select(F.col(vector).alias("v")).mapInArrow(work, "part bigint, body array<double>")
    body = _fold(parts, lambda bodies: reduced([b.reshape(-1, width) for b in bodies]).ravel())
    square = np.zeros((width, width))
    if body is not None:
        factor = body.reshape(-1, width)
        square[: len(factor)] = factor
    return square


def bidiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Householder: diagonal, superdiagonal and Q with a = U B Q'. U is not needed."""
    a, d = a.copy(), len(a)
    q = np.eye(d)

    def mirror(x: np.ndarray) -> np.ndarray | None:
        """Unit normal of the mirror that takes x to its first axis."""
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            return None
        v = x / size
        v[0] += math.copysign(1.0, v[0])
        return v / np.linalg.norm(v)

    for k in range(d):
        v = mirror(a[k:, k].copy())
        if v is not None:
            a[k:, k:] -= 2.0 * np.outer(v, v @ a[k:, k:])
        v = mirror(a[k, k + 1 :].copy()) if k + 2 < d else None
        if v is not None:
            a[k:, k + 1 :] -= 2.0 * np.outer(a[k:, k + 1 :] @ v, v)
            q[:, k + 1 :] -= 2.0 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), q


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One differential quotient-difference step with shift; None if the shift was too large."""
    qs, es, d = [], [], q[0] - shift
    if d < 0:
        return None
    for k in range(len(e)):
        top = d + e[k]
        if top == 0:
            return None if shift else (q, [*e[:k], 0.0, *e[k + 1 :]])
        ratio = q[k + 1] / top
        qs.append(top)
        es.append(e[k] * ratio)
        d = d * ratio - shift
        if not d >= 0:
            return None
    return [*qs, d], es


def squared_singular_values(diagonal: np.ndarray, beside: np.ndarray) -> list[float]:
    """dqds: squares of the singular values of an upper bidiagonal matrix, each to high relative accuracy, falling."""
    found: list[float] = []
    blocks = [((diagonal**2).tolist(), (beside**2).tolist(), 0.0)]
    tiny = _EPS * _EPS
    while blocks:
        q, e, moved = blocks.pop()
        rounds = 0
        while q:
            cut = next((k for k in range(len(e) - 1, -1, -1) if e[k] <= tiny * (moved + min(q[k], q[k + 1])) or e[k] < 1e-300), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if len(q) == 1:
                found.append(q[0] + moved)
                break
            if q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            # the trace of the inverse bounds the least value from below
            inverse = trace = 1.0 / q[0] if q[0] else math.inf
            for k in range(len(e)):
                inverse = (1.0 + e[k] * inverse) / q[k + 1] if q[k + 1] else math.inf
                trace += inverse
            shift = (1.0 - 16 * _EPS) / trace
            step = _transform(q, e, shift)
            while step is None and shift:
                shift = shift / 2 if shift > 1e-290 and rounds % 4 else 0.0
                step = _transform(q, e, shift)
            q, e = step
            moved += shift
            rounds += 1
            if rounds > 200 * len(diagonal) + 200:
                raise ArithmeticError("singular values did not settle")
    return sorted(found, reverse=True)


def twisted_vector(diagonal: np.ndarray, beside: np.ndarray, value: float, against: list[np.ndarray]) -> np.ndarray:
    """Unit eigenvector of B'B for `value`: factorisations from the top and from the bottom meet where their twist is least.

    `against` are vectors of values too close to tell apart; the twist then moves on and the vector is made orthogonal to them.
    """
    m = len(diagonal)
    q, e, cross = diagonal**2, beside**2, diagonal[:-1] * beside
    floor = max(float(q.max()), 1e-300) * 1e-300 + 5e-324
    z = np.zeros(m)
    for _ in range(4):
        down, lower, s = np.empty(m), np.empty(max(m - 1, 0)), np.empty(m)
        s[0] = -value
        for k in range(m):
            down[k] = s[k] + q[k] or floor
            if k + 1 < m:
                lower[k] = cross[k] / down[k]
                s[k + 1] = e[k] / down[k] * s[k] - value
        rising, p = np.empty(max(m - 1, 0)), np.empty(m)
        p[m - 1] = q[m - 1] - value
        for k in range(m - 2, -1, -1):
            under = e[k] + p[k + 1] or floor
            rising[k] = cross[k] / under
            p[k] = q[k] / under * p[k + 1] - value
        twist = np.abs(s + p + value)
        twist[~np.isfinite(twist)] = math.inf
        r = int(np.argsort(twist, kind="stable")[min(len(against), m - 1)])
        z[:] = 0
        z[r] = 1.0
        for k in range(r - 1, -1, -1):
            z[k] = -lower[k] * z[k + 1]
        for k in range(r, m - 1):
            z[k + 1] = -rising[k] * z[k]
        z /= np.linalg.norm(z)
        for _ in range(2):
            for other in against:
                z -= (other @ z) * other
            z /= np.linalg.norm(z)
        if against:
            return z
        b = diagonal * z
        b[:-1] += beside * z[1:]
        better = float(b @ b)  # Rayleigh quotient
        if abs(better - value) <= 4 * _EPS * value:
            return z
        value = better
    return z


def solve(factor: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Squares of the largest singular values of R, their right directions, and the sum of all squares.

    Values that rounding cannot tell from zero have no direction.
    """
    diagonal, beside, q = bidiagonal(factor)
    size = max(np.abs(diagonal).max(initial=0), np.abs(beside).max(initial=0))
    total = float(np.sum(diagonal**2) + np.sum(beside**2))
    edges = [0, *(np.flatnonzero(np.abs(beside) <= _EPS * size * 1e-2) + 1).tolist(), len(diagonal)]
    ranked = sorted(
        ((v, a, b) for a, b in zip(edges[:-1], edges[1:]) for v in squared_singular_values(diagonal[a:b], beside[a : b - 1])), key=lambda t: (-t[0], t[1])
    )
    zero = (8 * len(diagonal) * _EPS) ** 2 * ranked[0][0] if ranked else 0.0
    kept = [t for t in ranked if t[0] > zero][:count]
    vectors: list[np.ndarray] = []
    for k, (value, a, b) in enumerate(kept):
        close = [vectors[j][a:b] for j in range(k) if kept[j][1:] == (a, b) and kept[j][0] - value <= 1e-7 * value]
        z = np.zeros(len(diagonal))
        z[a:b] = twisted_vector(diagonal[a:b], beside[a : b - 1], value, close)
        vectors.append(z)
    directions = q @ np.array(vectors).T if vectors else np.zeros((len(diagonal), 0))
    return np.array([t[0] for t in kept]), directions, total


def fit_whitening(rows: DataFrame, vector: str = "embedding", components: int = 8, scale: float = 1024.0, offset: int = 100_000) -> Whitening:
    """Fit on every usable row: entries become whole numbers, sums are exact, the factor R comes from all rows.

    Rows are unusable if the vector is null, empty, holds null or non-finite entries, or has another length than most. The factor has
    dimensions^2 doubles: it fits a task and the driver up to some thousand dimensions.
    """
    n, sums = exact_sums(rows, vector, scale, offset)
    if n == 0:
        return Whitening(0, sums, np.zeros(0), np.zeros((0, 0)), 0.0, scale, offset)
    squares, directions, total = solve(triangular_factor(rows, vector, n, sums, scale, offset), components)
    return Whitening(n, sums, squares / n, directions, total / n, scale, offset)


# ---- applying ----------------------------------------------------------------------------------


def deviations(y: np.ndarray) -> pa.Array:
    """Exact sums of squares of each row, in up to 38 digits."""
    if len(y) == 0 or float(np.abs(y).max()) ** 2 * y.shape[1] < _LARGEST:
        return pa.array((y * y).sum(axis=1), pa.int64()).cast(pa.decimal128(38, 0))
    high, low = y >> 28, y & ((1 << 28) - 1)
    parts = zip((high * high).sum(axis=1).tolist(), (high * low).sum(axis=1).tolist(), (low * low).sum(axis=1).tolist())
    return pa.array([Decimal((a << 56) + (b << 29) + c) for a, b, c in parts], pa.decimal128(38, 0))


def whiten(rows: DataFrame, model: Whitening, vector: str = "embedding") -> DataFrame:
    """Usable rows with `n`, `deviation` (exact sum of squares of n * x - sums) and `whitened` (one double a component), replacing columns of these names."""
    kept = [c for c in rows.columns if c not in ADDED or c == vector]
    place, width = kept.index(vector), len(model.sums)
    source = rows.select(*[f"`{c}`" for c in kept])
    new = [T.StructField("n", T.LongType()), T.StructField("deviation", T.DecimalType(38, 0)), T.StructField("whitened", T.ArrayType(T.DoubleType()))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask, x = _matrix(batch, place, width, model.scale, model.offset)
            if not mask.any():
                continue
            w = model.project(x)
            offsets = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
            yield pa.RecordBatch.from_arrays(
                [*batch.filter(pa.array(mask)).columns, pa.array(np.full(len(w), model.n), pa.int64()), deviations(model.centred(x)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.ravel()))],
                names=[*kept, *ADDED],
            )

    return source.mapInArrow(work, T.StructType([*source.schema.fields, *new]))


def identity_error(rows: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """Largest absolute entry of the covariance of the whitened rows minus the identity, measured on all rows; 0 without components."""
    width, k = len(model.sums), len(model.variances)
    if k == 0:
        return 0.0

    def merged(parts: list[np.ndarray]) -> np.ndarray:
        """Counts, means and centred products of several parts as those of one."""
        n = sum(p[0] for p in parts)
        mean = sum(p[0] * p[1 : k + 1] for p in parts) / n
        spread = sum(p[k + 1 :].reshape(k, k) + p[0] * np.outer(p[1 : k + 1] - mean, p[1 : k + 1] - mean) for p in parts)
        return np.concatenate([[n], mean, spread.ravel()])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            _, x = _matrix(batch, 0, width, model.scale, model.offset)
            if len(x):
                w = model.project(x)
                mean = w.mean(axis=0)
                part = np.concatenate([[len(w)], mean, ((w - mean).T @ (w - mean)).ravel()])
                state = part if state is None else merged([state, part])
        if state is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([state], pa.list_(pa.float64()))], names=["part", "body"]
            )

    body = _fold(rows.select(F.col(vector).alias("v")).mapInArrow(work, "part bigint, body array<double>"), merged)
    return float(np.abs(body[k + 1 :].reshape(k, k) / body[0] - np.eye(k)).max())
