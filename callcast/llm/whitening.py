"""Embedding whitening by a blockwise QR, Householder bidiagonalisation and a qd solver.

1. *Integers.*  An entry c, as double, becomes the long floor(``scale`` * c) + ``offset``.
   n and the per-dimension sums S are exact.
2. *Blockwise QR.*  Every task reduces its centred rows (x - S/n, before any product)
   to one upper triangular factor, block by block; the factors are stacked in groups of
   ``fan_in`` and reduced again, round by round, until one d x d factor R is left.
   R'R is n times the covariance, yet no product of rows was formed.
3. *Bidiagonalisation.*  Householder reflections from both sides turn R into an upper
   bidiagonal B with the same singular values.
4. *dqds.*  The differential quotient-difference algorithm with shifts finds every
   singular value of B to high relative accuracy.  Off-diagonals that vanish split B.
5. *Twisted factorisations.*  For each wanted singular value s, the stationary and the
   progressive qd transform of B'B - s^2 meet at the index where the twist is smallest;
   two short recurrences from there give the vector.  More passes shift by the Rayleigh
   quotient.  Vectors of close values are made orthogonal to one another; if one was
   found before, the next best twist is taken.
6. The right reflections carry the vectors back: unit eigenvectors of the covariance.

The d x d factor is all that reaches the driver; d may be at most ``MAX_DIMS``, so its
size is bounded.  Rows are never dealt by a key, so no row can be hot.

Defined results: rows whose vector is null or holds a null or non-finite entry are
dropped, and so are vectors whose length is not the commonest one (of equally common
ones the longest) or is 0.  Repeated rows each count; a null id is an id; components whose variance is
zero up to rounding cannot be whitened and are left out; with no rows the result is empty.
An exact deviation that does not fit a long is null (``deviation_wide`` holds it up to 38
digits).  Equal variances are numbered in the order of the solver; any sign is possible.
Input columns that clash with the result columns are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from callcast.session import materialize, ship_package

SCALE, OFFSET = 1024, 100_000
MAX_DIMS = 4096
#: A variance below this share of the largest one (or of 1) is rounding.
FLAT = 1e-20
_BLOCK_ROWS = 4096
_EPS = np.finfo(float).eps


# ---------------------------------------------------------------- dense reduction on the driver (d x d)
def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and superdiagonal of B = U' R V, and the reflections that make up V (v of I - 2 v v', acting from row 1 on)."""
    a = np.array(r, dtype=float)
    n = a.shape[0]
    right: list[np.ndarray] = []

    def reflector(x: np.ndarray) -> np.ndarray:
        v = x.copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            return np.zeros_like(x)
        v[0] += np.copysign(norm, x[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        v = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k + 1 < n:
            w = reflector(a[k, k + 1 :]) if k + 2 < n else np.zeros(n - k - 1)
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ w, w)
            right.append(w)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), right


def unreflect(vectors: np.ndarray, right: list[np.ndarray]) -> np.ndarray:
    """V times the columns of ``vectors``."""
    out = vectors.copy()
    for k in range(len(right) - 1, -1, -1):
        w = right[k]
        out[k + 1 :] -= 2 * np.outer(w, w @ out[k + 1 :])
    return out


def blocks(diag: np.ndarray, off: np.ndarray) -> list[tuple[int, int]]:
    """Ranges between off-diagonals that vanish against the size of B."""
    size = max(np.abs(diag).max(initial=0.0), np.abs(off).max(initial=0.0))
    cuts = [i + 1 for i in range(len(off)) if abs(off[i]) <= _EPS * size]
    edges = [0, *cuts, len(diag)]
    return list(zip(edges[:-1], edges[1:]))


def dqds(diag: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix, largest first.

    Works on the squares q and e of its entries.  A step with shift t gives the qd
    array of B'B - t; a shift that is too large (a negative q) is tried again smaller.
    The lowest entry converges to the smallest value left, which is then split off.
    """
    q, e = (diag.astype(float) ** 2).tolist(), (off.astype(float) ** 2).tolist()
    values: list[float] = []
    todo = [(q, e, 0.0)]
    while todo:
        q, e, shifted = todo.pop()
        rounds = 0
        while q:
            n = len(q)
            if n == 1:
                values.append(q[0] + shifted)
                break
            tiny = _EPS**2 * max(q) * 1e-2
            if e[-1] <= _EPS**2 * 4 * (shifted + q[-1]) or e[-1] <= tiny * _EPS:
                values.append(q[-1] + shifted)
                q, e, rounds = q[:-1], e[:-1], 0
                continue
            cut = next((i for i in range(n - 2, -1, -1) if e[i] <= _EPS**2 * 4 * (shifted + min(q[i], q[i + 1])) or e[i] == 0.0), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], shifted))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if rounds == 0 and q[0] < q[-1]:  # graded the wrong way: work on the reversed matrix
                q, e = _flipped(q, e)
            rounds += 1
            guess = _smallest(q, e)
            for t in (guess, guess * 0.75, guess * 0.25, 0.0):
                got = _qd_step(q, e, t)
                if got is not None:
                    q, e = got
                    shifted += t
                    break
            if rounds > 60 * n:
                raise ArithmeticError("dqds did not converge")
    return np.sqrt(np.sort(np.maximum(values, 0.0))[::-1])


def _flipped(q: list, e: list) -> tuple[list, list]:
    """The qd array of the matrix read from its other end: same values (B and its reversed transpose)."""
    return q[::-1], e[::-1]


def _smallest(q: list, e: list) -> float:
    """Newton's lower bound of the smallest eigenvalue: 1 over the trace of the inverse, from the pivots of a step without shift."""
    d, inverse = q[0], 0.0
    for i in range(len(e)):
        if d <= 0.0:
            return 0.0
        inverse += 1 / d
        d = d * (q[i + 1] / (d + e[i]))
    return (1 - 1e-12) / (inverse + 1 / d) if d > 0.0 else 0.0


def _qd_step(q: list, e: list, t: float):
    """One differential qd transform with shift t, or None if a pivot turns negative."""
    d = q[0] - t
    new_q, new_e = [], []
    for i in range(len(e)):
        if d < 0:
            return None
        s = d + e[i]
        if s == 0.0:
            ratio = 0.0
            new_e.append(0.0)
        else:
            ratio = q[i + 1] / s
            new_e.append(e[i] * ratio)
        new_q.append(s)
        d = d * ratio - t
    if d < 0:
        return None
    new_q.append(d)
    return new_q, new_e


def twisted_vector(d: np.ndarray, l: np.ndarray, lam: float, rank: int = 0) -> tuple[np.ndarray, float]:
    """Unit vector of L D L' near ``lam``, and the Rayleigh correction, from the twisted factorisation with the smallest twist (or the next but ``rank``)."""
    n = len(d)
    if n == 1:
        return np.ones(1), d[0] - lam
    small = 1e-300
    s, p = np.empty(n), np.empty(n)
    up, low = np.empty(n - 1), np.empty(n - 1)
    s[0] = -lam
    for i in range(n - 1):
        plus = d[i] + s[i]
        plus = plus if abs(plus) > small else np.copysign(max(_EPS * abs(d[i]), small), plus)
        up[i] = d[i] * l[i] / plus
        s[i + 1] = up[i] * l[i] * s[i] - lam
    p[n - 1] = d[n - 1] - lam
    for i in range(n - 2, -1, -1):
        minus = d[i] * l[i] ** 2 + p[i + 1]
        minus = minus if abs(minus) > small else np.copysign(max(_EPS * abs(d[i]), small), minus)
        low[i] = d[i] * l[i] / minus
        p[i] = p[i + 1] * (d[i] / minus) - lam
    twist = s + p + lam
    twist[~np.isfinite(twist)] = np.inf
    r = int(np.argsort(np.abs(twist), kind="stable")[min(rank, n - 1)])
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -up[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -low[i] * z[i]
    norm = np.linalg.norm(z)
    return z / norm, twist[r] / norm**2


def singular_vectors(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Right singular vectors of a bidiagonal block without zero off-diagonals, for ``values`` (falling), as columns."""
    out = np.zeros((len(diag), len(values)))
    eig = values**2
    l = off / np.where(diag[:-1] == 0, _EPS**2, diag[:-1])  # B'B = L D L'
    d = np.where(diag == 0, _EPS**2, diag) ** 2
    start = 0
    for j, lam in enumerate(eig):
        if j and eig[j - 1] - lam > 1e-3 * eig[0]:
            start = j
        for rank in range(len(diag)):  # vectors of close values: orthogonal to those before, from another twist if need be
            at = lam
            z, fix = twisted_vector(d, l, at, rank)
            for _ in range(3):
                if not np.isfinite(fix) or abs(fix) <= 2 * _EPS * abs(at):
                    break
                better, again = twisted_vector(d, l, at + fix, rank)
                if not np.all(np.isfinite(better)) or abs(again) >= abs(fix):
                    break
                at, z, fix = at + fix, better, again
            for _ in range(2):
                z = z - out[:, start:j] @ (out[:, start:j].T @ z)
                norm = np.linalg.norm(z)
                if not norm > 1e-3:
                    break
                z = z / norm
            if norm > 1e-3:
                out[:, j] = z
                break
    return out


def principal_directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values of R (falling), and the first ``count`` right singular vectors as columns."""
    diag, off, right = bidiagonalise(r)
    parts = []
    for a, b in blocks(diag, off):
        values = dqds(diag[a:b], off[a : b - 1])
        parts += [(v, a, b, i) for i, v in enumerate(values)]
    parts.sort(key=lambda x: (-x[0], x[1], x[3]))
    wanted: dict[tuple[int, int], int] = {}
    for _, a, b, i in parts[:count]:
        wanted[(a, b)] = max(wanted.get((a, b), 0), i + 1)
    vectors = {}
    for (a, b), k in wanted.items():
        values = np.array([v for v, x, _, _ in parts if x == a])[:k]
        vectors[(a, b)] = singular_vectors(diag[a:b], off[a : b - 1], values)
    out = np.zeros((len(diag), min(count, len(parts))))
    for j, (_, a, b, i) in enumerate(parts[:count]):
        out[a:b, j] = vectors[(a, b)][:, i]
    return np.array([v for v, *_ in parts]) ** 2, unreflect(out, right)


# ---------------------------------------------------------------- on Spark
@dataclass(frozen=True)
class Whitener:
    n: int
    sums: list[int]
    eigenvalues: np.ndarray  # all, falling, of the covariance
    directions: np.ndarray  # d x k
    explained: np.ndarray  # share of the trace, k


def integers(rows: DataFrame, vector: str, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``rows`` whose vector is usable, with ``x``: its entries as longs, all of one length."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != F.lit(float("inf"))))
    ok = rows.where(v.isNotNull() & (F.size(v) > 0) & F.coalesce(finite, F.lit(False)))
    common = ok.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col("d").desc()).first()
    if common is None:
        return ok.limit(0).withColumn("x", F.lit(None).cast("array<bigint>"))
    if common.d > MAX_DIMS:
        raise ValueError(f"more than MAX_DIMS={MAX_DIMS} dimensions")
    x = F.transform(v, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long") + F.lit(offset).cast("long"))
    return ok.where(F.size(v) == common.d).withColumn("x", x)


def _matrix(column: pa.Array) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _batched(batches, rows: int = _BLOCK_ROWS):
    """Matrices of at most about ``rows`` rows of the first column."""
    held, size = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(_matrix(b.column(0)))
        size += b.num_rows
        if size >= rows:
            yield np.concatenate(held)
            held, size = [], 0
    if held:
        yield np.concatenate(held)


def sums(rows: DataFrame) -> tuple[int, list[int]]:
    """n and the exact sum of every dimension (partial sums as Python integers: they cannot overflow)."""

    def add(batches):
        n, total = 0, None
        for x in _batched(batches):
            part = [int(v) for v in x.astype(object).sum(axis=0)] if np.abs(x).max() > (1 << 40) else x.sum(axis=0).tolist()
            total = part if total is None else [a + b for a, b in zip(total, part)]
            n += len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"dim": pa.array(range(-1, len(total)), pa.int32()), "total": pa.array([str(v) for v in (n, *total)])})

    parts = rows.select("x").mapInArrow(add, "dim int, total string").groupBy("dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # d + 1 rows
    found = {r.dim: int(r.total) for r in parts}
    return found.get(-1, 0), [found[i] for i in range(len(found) - 1)]


def triangular_factor(rows: DataFrame, n: int, total: list[int], fan_in: int = 64) -> np.ndarray:
    """R of the QR of the centred rows: one factor per task, then rounds of ``fan_in`` factors at a time."""
    mean = np.array([s / n for s in total])
    d = len(total)

    def qr(batches):
        r = np.zeros((0, d))
        for x in _batched(batches):
            r = np.linalg.qr(np.vstack([r, x - mean]), mode="r")
        if len(r):
            yield factor(r)

    def again(batches):
        r = np.zeros((0, d))
        for b in batches:
            for raw in b.column(0).to_pylist():
                r = np.linalg.qr(np.vstack([r, np.frombuffer(raw).reshape(-1, d)]), mode="r")
        if len(r):
            yield factor(r)

    def factor(r):
        return pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], names=["r"])

    factors = materialize(rows.select("x").mapInArrow(qr, "r binary"), "whitening-factors")
    left = factors.count()
    while left > 1:
        tasks = -(-left // fan_in)
        factors = materialize(factors.repartition(tasks).mapInArrow(again, "r binary"), "whitening-factors")
        left = factors.count()
    r = np.frombuffer(factors.first().r).reshape(-1, d)
    return np.vstack([r, np.zeros((d - len(r), d))])


def fit(rows: DataFrame, components: int = 8) -> Whitener | None:
    """Learn from rows with ``x`` (see ``integers``); None if there are none."""
    ship_package(rows.sparkSession)
    n, total = sums(rows)
    if not n:
        return None
    squares, directions = principal_directions(triangular_factor(rows, n, total), components)
    e = squares / n
    trace = float(e.sum())
    usable = [j for j in range(directions.shape[1]) if e[j] > FLAT * max(e[0], 1.0)]
    k = len(usable)
    return Whitener(n, total, e, directions[:, :k], e[:k] / trace if trace else e[:k])


def deviations(x: np.ndarray, n: int, total: np.ndarray) -> list[int]:
    """Exact sum over the dimensions of (n * x - total)^2 of every row; 64-bit arithmetic where it cannot overflow."""
    if max(n * int(np.abs(x).max()), int(np.abs(total).max())) < 1 << 61:
        w = n * x - total.astype(np.int64)
        top = int(np.abs(w).max())
        if top * top * x.shape[1] < 1 << 62:
            return (w * w).sum(axis=1).tolist()
        if top < 1 << 50 and x.shape[1] <= 4096:
            high, low = w >> 25, w & ((1 << 25) - 1)
            return [(a << 50) + (b << 26) + c for a, b, c in zip((high * high).sum(axis=1).tolist(), (high * low).sum(axis=1).tolist(), (low * low).sum(axis=1).tolist())]
    w = n * x.astype(object) - total
    return (w * w).sum(axis=1).tolist()


def whiten(rows: DataFrame, model: Whitener, keep: list[str]) -> DataFrame:
    """One row per row of ``rows``: ``keep``, deviation, deviation_wide and ``white`` (array of the whitened components)."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    own = rows.select(*[F.col(f"`{c}`") for c in keep])

    def run(batches):
        m = sent.value
        mean = np.array([s / m.n for s in m.sums])
        turn = m.directions / np.sqrt(m.eigenvalues[: m.directions.shape[1]])
        big = np.array(m.sums, dtype=object)
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(len(keep)))
            dev = deviations(x, m.n, big)
            white = (x - mean) @ turn
            yield pa.RecordBatch.from_arrays(
                [
                    *b.columns[: len(keep)],
                    pa.array([v if v < 1 << 63 else None for v in dev], pa.int64()),
                    pa.array([Decimal(v) if v < 10**38 else None for v in dev], pa.decimal128(38, 0)),
                    pa.array(white.tolist(), pa.list_(pa.float64())),
                ],
                names=[*keep, "deviation", "deviation_wide", "white"],
            )

    extra = [T.StructField("deviation", T.LongType()), T.StructField("deviation_wide", T.DecimalType(38, 0)), T.StructField("white", T.ArrayType(T.DoubleType()))]
    return rows.select(*[F.col(f"`{c}`") for c in keep], "x").mapInArrow(run, T.StructType([*own.schema.fields, *extra]))


def identity_error(white: DataFrame, model: Whitener) -> float:
    """Largest entry of the whitened rows' covariance minus the identity (divisor n, centred before multiplying)."""
    k = model.directions.shape[1]

    def add(batches):
        n, mean, moment = 0, np.zeros(k), np.zeros((k, k))
        for w in _batched(batches):
            m, c = len(w), w.mean(axis=0)
            part = (w - c).T @ (w - c)
            moment = moment + part + np.outer(c - mean, c - mean) * (n * m / (n + m))
            mean = mean + (c - mean) * (m / (n + m))
            n += m
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([mean.tolist()]), pa.array([moment.ravel().tolist()])], names=["n", "mean", "moment"])

    def combine(batches):
        n, mean, moment = 0, np.zeros(k), np.zeros(k * k)
        for b in batches:
            for m, c, p in zip(*(b.column(i).to_pylist() for i in range(3))):
                c, p = np.array(c), np.array(p)
                moment = moment + p + np.outer(c - mean, c - mean).ravel() * (n * m / (n + m))
                mean = mean + (c - mean) * (m / (n + m))
                n += m
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([mean.tolist()]), pa.array([moment.tolist()])], names=["n", "mean", "moment"])

    kinds = "n long, mean array<double>, moment array<double>"
    parts = materialize(white.select("white").mapInArrow(add, kinds), "whitening-moments")
    while (left := parts.count()) > 1:  # combined in rounds, so the driver reads one row
        parts = materialize(parts.repartition(-(-left // 64)).mapInArrow(combine, kinds), "whitening-moments")
    row = parts.first()
    return float(np.abs(np.array(row.moment).reshape(k, k) / row.n - np.eye(k)).max())


def whitened_components(rows: DataFrame, vector: str = "embedding", row_id: str = "vec_id", components: int = 8) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error, deviation_wide): one row per usable row and component."""
    kind = rows.schema[row_id].dataType.simpleString()
    schema = f"`{row_id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_wide decimal(38,0)"
    x = materialize(integers(rows.select(F.col(f"`{row_id}`"), F.col(f"`{vector}`")), vector).select(F.col(f"`{row_id}`"), "x"), "whitening-rows")
    model = fit(x, components)
    if model is None or not model.directions.shape[1]:
        return rows.sparkSession.createDataFrame([], schema)
    white = materialize(whiten(x, model, [row_id]), "whitening-result")
    error = identity_error(white, model)
    shares = F.array(*[F.lit(float(v)) for v in model.explained])
    return white.select(F.col(f"`{row_id}`"), "deviation", "deviation_wide", F.posexplode("white").alias("at", "whitened")).select(
        F.col(f"`{row_id}`"), (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"), F.lit(error).alias("identity_error"), "deviation_wide",
    )
