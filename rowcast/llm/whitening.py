"""Embedding whitening by a bidiagonal qd solver.

1. Tasks reduce their centred rows block by block to a triangular factor R,
   and the factors are merged sixteen by sixteen; no row travels.
2. R, whose size is the square of the vector length, is reduced to a bidiagonal
   matrix by Householder reflections.
3. dqds finds its squared singular values. The shifts are Laguerre's lower
   bound of the smallest one, so every value keeps its relative accuracy.
4. A twisted factorisation at each value gives the direction; directions of
   values that are almost equal are made orthogonal among themselves.

Rows become whole numbers before anything else, so that counts, sums and
deviations are exact, and rows are centred before they are multiplied.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowcast.llm.common import ship
from rowcast.llm.vectors import finite_rows, merged, partials

EPS = float(np.finfo(float).eps)
# Rows that go into one QR step, in entries of the block.
BLOCK_ENTRIES = 1 << 18
# Eigenvalues closer than this share of the largest are one cluster.
CLUSTER_GAP = 1e-6
# Eigenvalues below this share of the largest count as zero.
RANK_TOLERANCE = 1e-12


# ------------------------------------------------------------ the solver


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right vectors of the bidiagonal form of the
    square matrix ``r``: ``r.T @ r == v @ b.T @ b @ v.T``."""
    a, n = np.array(r, dtype=float), len(r)
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if size == 0 or size == abs(x[0]):
            return None
        u = x.copy()
        u[0] += math.copysign(size, x[0])
        return u / np.linalg.norm(u)

    for k in range(n):
        if (u := reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k < n - 1 and (u := reflector(a[k, k + 1 :])) is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ u, u)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def lower_bound(q: list[float], e: list[float]) -> float:
    """Laguerre's lower bound of the smallest eigenvalue of a positive qd array.

    ``s1`` and ``s2`` are the sums of the eigenvalues' inverses and of their
    squares; all terms added are positive.
    """
    s1 = s2 = 0.0
    d1, d2 = -1.0, 0.0
    for i, here in enumerate(q):
        x = d1 / here
        s1 -= x
        s2 += x * x - d2 / here
        if i < len(e):
            ratio = e[i] / here
            d2 = ratio * (d2 - 2 * d1 * x)
            d1 = ratio * d1 - 1.0
    n = len(q)
    if not (math.isfinite(s1) and math.isfinite(s2)) or s1 <= 0:
        return 0.0
    spread = math.sqrt(max(0.0, (n - 1) * (n * s2 - s1 * s1)))
    return n / (s1 + spread) * (1 - 16 * n * EPS)


def qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds transform; None if the shift is not below the smallest value."""
    new_q, new_e, d = [], [], q[0] - shift
    for i, link in enumerate(e):
        if d < 0:
            return None
        top = d + link
        if top <= 0:
            return None
        ratio = q[i + 1] / top
        new_q.append(top)
        new_e.append(link * ratio)
        d = d * ratio - shift
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e


def squared_singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling."""
    n = len(diagonal)
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if n == 0 or scale == 0:
        return np.zeros(n)
    # An exact zero on the diagonal stands for a value far below rounding.
    least = (EPS * EPS) ** 2
    q = [max(float(x / scale) ** 2, least) for x in diagonal]
    e = [float(x / scale) ** 2 for x in above]
    found: list[float] = []
    total, rest = 0.0, 0.0  # the shifts so far, and what their sum rounds away
    negligible = (8 * EPS) ** 2
    while q:
        if len(q) == 1:
            found.append(total + (q[0] + rest))
            break
        if e[-1] <= negligible * (total + q[-1]):
            found.append(total + (q[-1] + rest))
            q.pop()
            e.pop()
            continue
        if 1.5 * q[0] < q[-1]:
            q.reverse()
            e.reverse()
        shift = lower_bound(q, e) if min(q) > 0 else 0.0
        while (step := qd_step(q, e, shift)) is None:
            if shift == 0.0:  # only underflow can stop an unshifted step
                q = [max(x, least * EPS) for x in q]
            shift = shift * 0.5 if shift > least else 0.0
        q, e = step
        grown = total + shift
        rest += shift - (grown - total)
        total = grown
    return np.sort(np.array(found))[::-1] * scale * scale


def twisted(d: np.ndarray, l: np.ndarray, shift: float) -> tuple[np.ndarray, ...]:
    """Factors of ``L D L' - shift``: multipliers and pivots from above, those
    from below, and the pivot that each row would have as the twist."""
    n = len(d)
    tiny = EPS * EPS * max(np.abs(d).max(), abs(shift), np.finfo(float).tiny / EPS**3)
    down, pivot_down, s = np.zeros(n), np.zeros(n), np.zeros(n)
    s[0] = -shift
    for i in range(n):
        pivot_down[i] = s[i] + d[i]
        if abs(pivot_down[i]) < tiny:
            pivot_down[i] = -tiny
        if i < n - 1:
            down[i] = l[i] * d[i] / pivot_down[i]
            s[i + 1] = down[i] * l[i] * s[i] - shift
    up, pivot_up, p = np.zeros(n), np.zeros(n), np.zeros(n)
    p[n - 1] = d[n - 1] - shift
    for i in range(n - 1, 0, -1):
        pivot_up[i] = d[i - 1] * l[i - 1] * l[i - 1] + p[i]
        if abs(pivot_up[i]) < tiny:
            pivot_up[i] = -tiny
        ratio = d[i - 1] / pivot_up[i]
        up[i - 1] = l[i - 1] * ratio
        p[i - 1] = ratio * p[i] - shift
    pivot_up[0] = p[0]
    gamma = s + p + shift
    gamma[n - 1] = s[n - 1] + d[n - 1]
    return down, pivot_down, up, pivot_up, gamma


def direction(d: np.ndarray, l: np.ndarray, value: float) -> np.ndarray:
    """The unit eigenvector of ``L D L'`` at ``value``, from the twist with the
    smallest pivot."""
    down, _, up, _, gamma = twisted(d, l, value)
    n, k = len(d), int(np.argmin(np.abs(gamma)))
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def solve(d: np.ndarray, l: np.ndarray, value: float, right: np.ndarray) -> np.ndarray:
    """``(L D L' - value) x = right`` by the same twisted factorisation."""
    down, pivot_down, up, pivot_up, gamma = twisted(d, l, value)
    n, k = len(d), int(np.argmin(np.abs(gamma)))
    y = right.copy()
    for i in range(k):
        y[i + 1] -= down[i] * y[i]
    for i in range(n - 1, k, -1):
        y[i - 1] -= up[i - 1] * y[i]
    tiny = EPS * max(abs(value), np.abs(d).max()) * EPS
    pivot = np.concatenate([pivot_down[:k], [gamma[k] if abs(gamma[k]) > tiny else tiny], pivot_up[k + 1 :]])
    x = y / pivot
    for i in range(k - 1, -1, -1):
        x[i] -= down[i] * x[i + 1]
    for i in range(k, n - 1):
        x[i + 1] -= up[i] * x[i]
    return x


def right_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray, how_many: int) -> np.ndarray:
    """Right singular vectors of a bidiagonal matrix, as columns, for the first
    ``how_many`` of its squared singular ``values``."""
    if how_many == 0:
        return np.zeros((len(diagonal), 0))
    scale = np.abs(diagonal).max()
    a = np.where(np.abs(diagonal) < EPS * EPS * scale, EPS * EPS * scale, diagonal)
    d, l = a * a, above / a[:-1]
    out = np.zeros((len(a), how_many))
    at = 0
    while at < how_many:
        end = at + 1
        while end < len(values) and values[end - 1] - values[end] <= CLUSTER_GAP * values[0]:
            end += 1
        if end == at + 1:
            out[:, at] = direction(d, l, float(values[at]))
        else:
            basis = _cluster(d, l, values[at:end])
            out[:, at:end] = basis[:, : how_many - at]
        at = end
    return out


def _cluster(d: np.ndarray, l: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal eigenvectors of almost equal values: inverse iteration with
    the twisted factors on the whole cluster, then the cluster's own axes."""
    rng = np.random.default_rng(len(values))
    basis = np.linalg.qr(rng.standard_normal((len(d), len(values))))[0]
    nudge = EPS * values[0] * np.arange(1, len(values) + 1)
    for _ in range(4):
        solved = [solve(d, l, float(v), basis[:, i]) for i, v in enumerate(values + nudge)]
        basis = np.linalg.qr(np.column_stack([x / np.linalg.norm(x) for x in solved]))[0]
    image = basis.copy()  # L' basis, whose Gram matrix under D is the cluster's block
    image[:-1] += l[:, None] * basis[1:]
    inner = np.linalg.eigh((image * d[:, None]).T @ image)[1]
    return basis @ inner[:, ::-1]


# ------------------------------------------------------------ over tables


@dataclass(frozen=True)
class Whitening:
    """What :func:`fit` learns: ``n`` rows, exact ``sums`` per dimension, the
    eigenvalues of the covariance (falling), its unit ``directions`` as
    columns, and the covariance's ``trace``."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    directions: np.ndarray
    trace: float

    @property
    def matrix(self) -> np.ndarray:
        """Maps a centred row to its whitened coordinates."""
        return self.directions / np.sqrt(self.values[: self.directions.shape[1]])

    def spread(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact; raises where a long cannot hold it."""
        mean = self.sums // self.n
        near, left = x - mean, self.sums - self.n * mean
        if np.abs(near).max(initial=0) * float(self.n) >= 2.0**62:
            raise OverflowError("n * x - S exceeds a long")
        return self.n * near - left

    def deviation(self, spread: np.ndarray) -> np.ndarray:
        """Sum of squares of :meth:`spread` per row, exact."""
        if (np.square(spread, dtype=float).sum(axis=1)).max(initial=0.0) >= 2.0**63 * (1 - 1e-9):
            raise OverflowError("the sum of (n * x - S)^2 exceeds a long")
        return (spread * spread).sum(axis=1)


def _whole(column: pa.ListArray, scale: float, offset: int, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Usable rows and their entries as whole numbers."""
    rows, c = finite_rows(column, width)
    scaled = np.floor(scale * c)
    if np.abs(scaled).max(initial=0.0) + abs(offset) >= 2.0**62:
        raise OverflowError("an entry is too large for a whole number")
    return rows, scaled.astype(np.int64) + offset


def _blocks(batches: Iterator[pa.RecordBatch], at: int, scale: float, offset: int, width: int | None = None):
    """Row numbers in the batch, the batch, and the whole numbers, block by block."""
    for batch in batches:
        rows, x = _whole(batch.column(at), scale, offset, width)
        step = max(1, BLOCK_ENTRIES // max(1, x.shape[1]))
        for i in range(0, len(rows), step):
            yield batch, rows[i : i + step], x[i : i + step]


def _narrow(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    ship(vectors.sparkSession)
    return vectors.select(vectors[id_col].alias("vec_id"), vectors[vector_col].alias("v"))


def fit(vectors: DataFrame, components: int = 32, scale: float = 64.0, offset: int = 1_000_000,
        vector_col: str = "embedding") -> Whitening | None:
    """The whitening of all usable rows of ``vectors``; None without one.

    An entry ``c`` counts as the whole number ``floor(scale * c) + offset``.
    Only what grows with the vector length, not with the rows, reaches the
    driver. Directions whose eigenvalue is zero but for rounding are left out.
    """
    narrow = _narrow(vectors, vector_col, vector_col).select("v")

    def add_up(batches):
        total = None
        for _, _, x in _blocks(batches, 0, scale, offset):
            here = np.concatenate([[len(x)], x.sum(axis=0)])
            if total is not None and len(total) != len(here):
                raise ValueError(f"vectors of different lengths: {sorted({len(total) - 1, len(here) - 1})}")
            total = here if total is None else total + here
        return total

    def add(arrays):
        if len(sizes := {len(a) - 1 for a in arrays}) > 1:
            raise ValueError(f"vectors of different lengths: {sorted(sizes)}")
        return np.sum(arrays, axis=0)

    counted = merged(partials(narrow, add_up), "<i8", add, "whiten-sums")
    if counted is None:
        return None
    n, sums = int(counted[0]), counted[1:].copy()
    width = len(sums)
    centre = Whitening(n, sums, np.zeros(0), np.zeros((width, 0)), 0.0)

    def triangular(stack: list[np.ndarray]) -> np.ndarray:
        r = np.linalg.qr(np.vstack(stack), mode="r")
        return np.vstack([r, np.zeros((width - len(r), width))])

    def reduce_rows(batches):
        r = None
        for _, _, x in _blocks(batches, 0, scale, offset, width):
            r = triangular([*([] if r is None else [r]), centre.spread(x) / n])
        return r

    factor = merged(partials(narrow, reduce_rows), "<f8",
                    lambda rs: triangular([r.reshape(width, width) for r in rs]), "whiten-r")
    diagonal, above, v = bidiagonal(factor.reshape(width, width))
    squares = squared_singular_values(diagonal, above)
    rank = int((squares > RANK_TOLERANCE * squares.max(initial=0.0)).sum())
    keep = min(components, rank)
    directions = v @ right_vectors(diagonal, above, squares, keep)
    return Whitening(n, sums, squares / n, directions, float(squares.sum() / n))


def identity_error(vectors: DataFrame, model: Whitening, scale: float = 64.0, offset: int = 1_000_000,
                   vector_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity,
    measured over all rows; tasks centre their rows before they multiply them."""
    narrow = _narrow(vectors, vector_col, vector_col).select("v")
    width, m = model.directions.shape

    def both(parts):
        """Counts, means and centred products of two lists of rows as those of one."""
        n = sum(p[0] for p in parts)
        mean = sum(p[0] * p[1] for p in parts) / n
        products = sum(p[2] + p[0] * np.outer(p[1] - mean, p[1] - mean) for p in parts)
        return n, mean, products

    def pack(part):
        return np.concatenate([[part[0]], part[1], part[2].ravel()])

    def unpack(data):
        return data[0], data[1 : m + 1], data[m + 1 :].reshape(m, m)

    def gather(batches):
        so_far = None
        for _, _, x in _blocks(batches, 0, scale, offset, width):
            y = (model.spread(x) / model.n) @ model.matrix
            mean = y.mean(axis=0)
            here = (float(len(y)), mean, (y - mean).T @ (y - mean))
            so_far = here if so_far is None else both([so_far, here])
        return None if so_far is None else pack(so_far)

    data = merged(partials(narrow, gather), "<f8", lambda ps: pack(both([unpack(p) for p in ps])), "whiten-check")
    n, _, products = unpack(data)
    return float(np.abs(products / n - np.eye(m)).max(initial=0.0))


def whiten(vectors: DataFrame, components: int = 32, scale: float = 64.0, offset: int = 1_000_000,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``:
    a row per usable vector and component.

    Vectors that are null, empty or hold null or non-finite entries are left out;
    repeated rows and null ids count and are returned like any other. Equal
    eigenvalues share a space of directions, of which some orthonormal set is
    returned. Components of eigenvalue zero (fewer rows or free dimensions than
    components) are left out, as nothing can be divided by their spread. Vectors
    of different lengths raise, as do numbers that a long cannot hold. An empty
    table, or one of equal vectors, gives no rows. Other columns do not matter.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    narrow = _narrow(vectors, id_col, vector_col)
    model = fit(vectors, components, scale, offset, vector_col)
    kept = 0 if model is None else model.directions.shape[1]
    out = narrow.limit(0) if not kept else narrow
    error = identity_error(vectors, model, scale, offset, vector_col) if kept else 0.0
    width = 0 if model is None else len(model.sums)

    def project(batches):
        for batch, rows, x in _blocks(batches, 1, scale, offset, width):
            spread = model.spread(x)
            y = (spread / model.n) @ model.matrix
            offsets = np.arange(0, y.size + 1, kept, dtype=np.int32)
            yield pa.record_batch(
                [batch.column(0).take(pa.array(rows)), pa.array(model.deviation(spread)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(y.ravel()))],
                names=["vec_id", "deviation", "y"],
            )

    rows = out.mapInArrow(project, f"vec_id {kind}, deviation long, y array<double>")
    shares = [] if model is None else [float(v / model.trace) for v in model.values[:kept]]
    explained = F.array(*[F.lit(s) for s in shares]) if shares else F.array(F.lit(0.0))
    return rows.select("vec_id", "deviation", F.posexplode("y").alias("k", "whitened")).select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(0 if model is None else model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("k") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
