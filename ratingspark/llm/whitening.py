"""Whitening of embeddings by a bidiagonal qd solver.

Entries c become integers floor(256 c). The fit list holds each distinct
integer vector once: n vectors with sums S. Rows of the fit list are centred
(n x - S is exact, then divided by n) and reduced block by block to triangles
by QR, triangles are joined ``FAN`` at a time in a tree, so each task holds a
few d x d triangles whatever the number of rows. The last triangle R (d x d)
is what the driver gets: R'R = n V. There Householder reflections make it
bidiagonal, dqds finds the squared singular values to high relative accuracy,
twisted factorisations of the shifted tridiagonal matrix give the vectors, and
the reflections bring them back. The projections, the deviations and the check
of the whitened covariance are again passes over the rows.

Equal vectors are found by grouping their bytes, with a map-side combine, so a
vector that a third of all rows share costs one row per task. Rows themselves
never move. The driver holds d x d numbers (d is the dimension, 64 in the test
tables; the solver is cubic in d).

Defined cases: NULL vectors and vectors with NULL, NaN or infinite entries are
dropped, as are empty ones and those of another length than most rows have
(the longer one on a tie). Entries past the range of 64-bit integers count as
its ends. A deviation past 64 bits is NULL. There are min(k, d) components; a
component without variance (e <= d^2 eps^2 of the largest, as when there are
fewer distinct vectors than components) has whitened NULL and takes no part in
identity_error; explained is NULL if nothing varies at all. Repeated rows get
equal results. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingspark.llm.common import Scratch

EPS = np.finfo(float).eps
FAN = 16       # triangles joined at a time
BLOCK = 4096   # rows reduced at a time
LIMIT = (1 << 63) - 1


# --- integer vectors ---------------------------------------------------------

def _integers(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(flat integers, offsets, usable) of a column of arrays of numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.asarray(column.value_lengths().fill_null(0))
    flat = column.flatten().cast(pa.float64())
    values = flat.fill_null(np.nan).to_numpy(zero_copy_only=False)
    good = np.isfinite(values)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    bad = np.concatenate([[0], np.cumsum(~good)])
    usable = (bad[offsets[1:]] == bad[offsets[:-1]]) & (sizes > 0)
    with np.errstate(invalid="ignore", over="ignore"):
        y = np.floor(np.where(good, values, 0.0) * 256.0)
        x = np.where(np.abs(y) < 2.0 ** 63, y, 0.0).astype(np.int64)
    x[y >= 2.0 ** 63], x[y <= -2.0 ** 63] = LIMIT, -LIMIT
    return x, offsets, usable


def _as_bytes(batches):
    """mapInArrow function: (embedding) -> (x), the integers' bytes."""
    for batch in batches:
        x, offsets, usable = _integers(batch.column("embedding"))
        rows = [x[offsets[i]:offsets[i + 1]].tobytes() for i in np.flatnonzero(usable)]
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["x"])


def _matrix(column, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, d)


def _exact(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S: as 64-bit integers where they are surely enough, else Python's."""
    largest = max((abs(int(x.max())), abs(int(x.min())))) if x.size else 0
    if n * largest + max(map(abs, sums)) < LIMIT:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return _exact(x, n, sums).astype(np.float64) / n


# --- blockwise QR ------------------------------------------------------------

def _triangle(rows: np.ndarray, d: int) -> np.ndarray:
    r = np.linalg.qr(rows, mode="r") if len(rows) else np.zeros((0, d))
    return np.vstack([r, np.zeros((d - len(r), d))]) if len(r) < d else r


def _reducer(d: int, n: int, sums: list[int]):
    """mapInArrow function: (x) -> one triangle for all rows of the task."""

    def run(batches):
        r, seen = np.zeros((0, d)), False
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            for i in range(0, len(x), BLOCK):
                r, seen = _triangle(np.vstack([r, _centred(x[i:i + BLOCK], n, sums)]), d), True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], names=["r"])

    return run


def _joiner(d: int):
    """applyInArrow function: the triangles of a group -> one."""

    def run(key, table):
        rows = np.vstack([np.frombuffer(r, np.float64).reshape(d, d) for r in table.column("r").to_pylist()])
        r = _triangle(rows, d).tobytes()
        return pa.table({"at": pa.array([key[0].as_py()], pa.int64()), "r": pa.array([r], pa.binary())})

    return run


def triangle(fit: DataFrame, d: int, n: int, sums: list[int], scratch: Scratch, fan: int = FAN) -> np.ndarray:
    """R of the centred fit list, by a tree of QR factorisations."""
    level = scratch.keep(fit.select("x").mapInArrow(_reducer(d, n, sums), "r binary")
                            .select(F.spark_partition_id().cast("bigint").alias("at"), "r"))   # one row a task
    last = level.agg(F.max("at")).first()[0]
    while last > 0:
        joined = level.select(F.expr(f"at div {fan}").alias("at"), "r").groupBy("at")
        level = scratch.keep(joined.applyInArrow(_joiner(d), "at bigint, r binary"))
        last //= fan
    return np.frombuffer(level.first()["r"], np.float64).reshape(d, d).copy()


# --- bidiagonal qd solver ----------------------------------------------------

def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, superdiagonal, right reflectors) of U' r W, W the product of
    I - 2 v v' over the reflectors."""
    a = r.copy()
    d = len(a)
    right = []

    def reflector(x):
        v = x.copy()
        size = np.linalg.norm(x)
        if size == 0 or not np.any(x[1:]):
            return np.zeros_like(v)
        v[0] += np.copysign(size, x[0])
        return v / np.linalg.norm(v)

    for k in range(d):
        v = reflector(a[k:, k])
        a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < d - 2:
            w = reflector(a[k, k + 1:])
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ w, w)
            full = np.zeros(d)
            full[k + 1:] = w
            right.append(full)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _dqds_step(q: np.ndarray, e: np.ndarray, tau: float):
    """One differential qd transform with shift ``tau``: (q, e, last d), or the
    place where it met a negative pivot in q's stead. Without a shift it
    always succeeds."""
    n = len(q)
    nq, ne = np.empty(n), np.empty(n - 1)
    d = q[0] - tau
    for i in range(n - 1):
        nq[i] = d + e[i]
        if not nq[i] > 0:
            if tau == 0:   # a zero pivot: the value 0 comes out
                nq[i] = np.finfo(float).tiny
            else:
                return None, None, None
        t = q[i + 1] / nq[i]
        ne[i] = e[i] * t
        d = d * t - tau
    nq[n - 1] = d
    return nq, ne, d


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Eigenvalues, falling, of B'B from the squares q and e of the diagonal
    and superdiagonal of B. Shifts that overshoot are taken back."""
    out = []
    todo = [(np.array(q, float), np.array(e, float), 0.0)]
    while todo:
        q, e, shift = todo.pop()
        rounds = 0
        while len(q) > 1:
            low = shift + np.minimum(q[:-1], q[1:])
            small = np.flatnonzero(e <= (100 * EPS) ** 2 * low)   # moves a value by 100 eps of its size at most
            if len(small):
                cut = small[-1] + 1
                todo.append((q[:cut], e[:cut - 1], shift))
                q, e, rounds = q[cut:], e[cut:], 0
                continue
            if rounds == 0 and 1.5 * q[0] < q[-1]:   # small values come out at the end; a reversed B has the same singular values
                q, e = q[::-1].copy(), e[::-1].copy()
            # the smaller eigenvalue of the last 2 x 2 block
            a, c, off = q[-2] + (e[-2] if len(q) > 2 else 0.0), q[-1] + e[-1], q[-2] * e[-1]
            half = (a - c) / 2
            root = np.sqrt(half * half + off)
            tau = max(0.0, c - off / (half + root) if half > 0 else c + half - root)
            for attempt in range(5):
                nq, ne, last = _dqds_step(q, e, tau)
                if last is not None and last >= 0:
                    break
                # only the last pivot is negative: tau + last is a close lower bound
                tau = 0.0 if attempt == 3 else max(0.0, tau + last) if last is not None and attempt == 0 else tau / 4
            q, e, shift = nq, ne, shift + tau
            q[-1] = max(q[-1], 0.0)
            rounds += 1
            if rounds > 100 * (len(q) + 10):
                raise ArithmeticError("dqds: no convergence")
        out.append(q[0] + shift)
    return np.sort(np.array(out))[::-1]


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """(unit vector, correction of the value) of the eigenvalue ``value`` of
    B'B: the factors from the top and from the bottom of B'B - value meet at
    the row with the smallest pivot."""
    n = len(a)
    if n == 1:
        return np.ones(1), 0.0
    tiny = np.finfo(float).tiny / EPS
    D, L = a * a, b / a[:-1]
    s, p = np.empty(n), np.empty(n)
    up, down = np.empty(n - 1), np.empty(n - 1)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + D[i]
        pivot = pivot if pivot != 0 else tiny
        up[i] = D[i] * L[i] / pivot
        s[i + 1] = up[i] * L[i] * s[i] - value
    p[-1] = D[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = D[i] * L[i] * L[i] + p[i + 1]
        pivot = pivot if pivot != 0 else tiny
        down[i] = D[i] * L[i] / pivot
        p[i] = p[i + 1] * (D[i] / pivot) - value
    gamma = s + p + value
    k = int(np.argmin(np.where(np.isfinite(gamma), np.abs(gamma), np.inf)))
    z = np.zeros(n)
    z[k] = 1.0
    with np.errstate(over="ignore", invalid="ignore"):
        for i in range(k - 1, -1, -1):
            z[i] = -up[i] * z[i + 1]
        for i in range(k, n - 1):
            z[i + 1] = -down[i] * z[i]
        size = z @ z
    return z / np.sqrt(size), gamma[k] / size


def _vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal columns for ``values`` (falling) of one unreduced block.
    Vectors of values closer than 1e-5 of the largest are made orthogonal; one
    that its neighbours nearly span is found by inverse iteration."""
    n = len(a)
    tri = np.diag(a * a) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    tri[range(1, n), range(1, n)] += b * b
    rng = np.random.default_rng(7)
    z = np.zeros((n, len(values)))
    first = 0

    def apart(v, near):
        for _ in range(2):
            v = v - near @ (near.T @ v)
        return v

    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-5 * values[0]:
            first = k
        near = z[:, first:k]
        v, gamma = twisted_vector(a, b, value)
        if abs(gamma) <= 1e-8 * value:
            v, _ = twisted_vector(a, b, value + gamma)
        v = apart(v, near) if np.all(np.isfinite(v)) else np.zeros(n)
        if np.linalg.norm(v) < 0.5:
            shifted = tri - (value + 2 * n * EPS * values[0]) * np.eye(n)
            v = rng.standard_normal(n)
            for _ in range(4):
                v = apart(v / np.linalg.norm(v), near)
                v = apart(np.linalg.solve(shifted, v), near)
        z[:, k] = v / np.linalg.norm(v)
    return z


def components(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(the k largest eigenvalues of r'r, falling; their unit eigenvectors as
    columns, each with its largest entry positive)."""
    d = len(r)
    k = min(k, d)
    scale = np.abs(r).max(initial=0.0)
    if scale == 0:
        return np.zeros(k), np.eye(d)[:, :k]
    a, b, right = bidiagonalise(r / scale)
    norm = max(np.abs(a).max(), np.abs(b).max(initial=0.0))
    a = np.where(np.abs(a) < EPS * norm, np.copysign(EPS * norm, a), a)
    cuts = [0, *(np.flatnonzero(np.abs(b) <= EPS * norm) + 1), d]
    blocks = [(lo, hi, dqds(a[lo:hi] ** 2, b[lo:hi - 1] ** 2)) for lo, hi in zip(cuts, cuts[1:])]
    least = np.sort(np.concatenate([v for _, _, v in blocks]))[-k]
    values, columns = [], []
    for lo, hi, own in blocks:
        own = own[own >= least]
        if len(own):
            z = np.zeros((d, len(own)))
            z[lo:hi] = _vectors(a[lo:hi], b[lo:hi - 1], own)
            values.append(own)
            columns.append(z)
    values, z = np.concatenate(values), np.hstack(columns)
    order = np.argsort(-values, kind="stable")[:k]
    values, z = values[order], z[:, order]
    for w in reversed(right):
        z -= 2 * np.outer(w, w @ z)
    z /= np.linalg.norm(z, axis=0)
    z *= np.sign(z[np.argmax(np.abs(z), axis=0), range(k)])
    return values * scale * scale, z


# --- the operator ------------------------------------------------------------

@dataclass
class Whitening:
    """A fitted whitening: ``n`` distinct vectors of ``d`` integers with sums
    ``sums``; eigenvalues and unit eigenvectors (columns) of their covariance,
    its trace, and the largest error of the whitened covariance."""

    n: int
    d: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def live(self) -> np.ndarray:
        """Which components have variance."""
        return self.values > (self.d * EPS) ** 2 * max(self.values.max(initial=0.0), np.finfo(float).tiny)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of integer rows on the live components."""
        return _centred(x, self.n, self.sums) @ (self.vectors[:, self.live] / np.sqrt(self.values[self.live]))


def _totals(d: int):
    """mapInArrow function: (x) -> rows and exact sums of the task."""

    def run(batches):
        n, sums = 0, [0] * d
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            if len(x):
                n += len(x)
                big = len(x) * max(abs(int(x.max())), abs(int(x.min()))) >= LIMIT
                sums = [s + int(t) for s, t in zip(sums, (x.astype(object) if big else x).sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array([-1, *range(d)], pa.int64()),
                                          pa.array([str(v) for v in (n, *sums)], pa.string())], names=["at", "total"])

    return run


def _products(model: Whitening):
    """mapInArrow function: (x) -> sums of products of whitened coordinates."""
    k = int(model.live.sum())

    def run(batches):
        total = np.zeros((k, k))
        for batch in batches:
            x = _matrix(batch.column("x"), model.d)
            for i in range(0, len(x), BLOCK):
                w = model.project(x[i:i + BLOCK])
                total += w.T @ w
        i, j = np.indices((k, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "total"])

    return run


def fit_whitening(df: DataFrame, vector: str = "embedding", k: int = 4, fan: int = FAN) -> Whitening | None:
    """The whitening of the distinct vectors of ``df``; None without any."""
    scratch = Scratch(df.sparkSession)
    column = df.select(F.col(f"`{vector}`").cast("array<double>").alias("embedding"))
    fit = scratch.keep(column.mapInArrow(_as_bytes, "x binary").groupBy("x").agg(F.count("*").alias("copies")))
    size = (fit.groupBy(F.expr("length(x) div 8").alias("d")).agg(F.sum("copies").alias("rows"))
               .orderBy(F.desc("rows"), F.desc("d")).first())
    if size is None:
        return None
    d = int(size["d"])
    fit = fit.where(F.length("x") == 8 * d).select("x")
    totals = {r["at"]: int(r["total"]) for r in fit.mapInArrow(_totals(d), "at bigint, total string").groupBy("at")
              .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()}   # d + 1 rows
    n, sums = totals[-1], [totals[i] for i in range(d)]
    r = triangle(fit, d, n, sums, scratch, fan)
    values, vectors = components(r, k)
    model = Whitening(n, d, sums, values / n, vectors, float(np.linalg.norm(r) ** 2 / n))
    if model.live.any():
        m = int(model.live.sum())
        rows = (fit.mapInArrow(_products(model), "i bigint, j bigint, total double").groupBy("i", "j")
                   .agg(F.sum("total").alias("total")).collect())
        model.identity_error = max(abs(x["total"] / n - (x["i"] == x["j"])) for x in rows if x["i"] < m)
    return model


def _apply(model: Whitening):
    """mapInArrow function: (row, embedding) -> (row, deviation, whitened)."""
    k = len(model.values)

    def run(batches):
        for batch in batches:
            x, offsets, usable = _integers(batch.column("embedding"))
            at = np.flatnonzero(usable & (np.diff(offsets) == model.d))
            x = x[(offsets[at][:, None] + np.arange(model.d)).ravel()].reshape(-1, model.d)
            gap = _exact(x, model.n, model.sums)
            if len(at) and gap.dtype != object:
                most = max(abs(int(gap.max())), abs(int(gap.min())))
                gap = gap if most * most * model.d < LIMIT else gap.astype(object)
            deviation = [int(v) if v <= LIMIT else None for v in (gap * gap).sum(axis=1)]
            white = np.full((len(at), k), np.nan)
            white[:, model.live] = model.project(x)
            flat = pa.array(white.ravel(), mask=np.tile(~model.live, len(at)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * k), flat)
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(at)), pa.array(deviation, pa.int64()),
                                              lists], names=["row", "deviation", "whitened"])

    return run


def whiten(df: DataFrame, vector: str = "embedding", k: int = 4, carry: list[str] | None = None,
           model: Whitening | None = None) -> DataFrame:
    """One row per usable row of ``df`` and component: ``row`` (a struct of
    ``carry``, all columns by default), ``component``, ``n``, ``deviation``,
    ``whitened``, ``explained``, ``identity_error``. Without a ``model`` one is
    fitted on ``df``."""
    model = model or fit_whitening(df, vector, k)
    row = F.struct(*[F.col(f"`{c}`") for c in (df.columns if carry is None else carry)]).alias("row")
    rows = df.select(row, F.col(f"`{vector}`").cast("array<double>").alias("embedding"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, deviation bigint, whitened array<double>"
    if model is None:
        out, shares, n, error = df.sparkSession.createDataFrame([], schema), [], 0, None
    else:
        out, n, error = rows.mapInArrow(_apply(model), schema), model.n, model.identity_error
        shares = [float(v / model.trace) if model.trace > 0 else None for v in model.values]
    share = F.array(*[F.lit(v).cast("double") for v in shares]).cast("array<double>")
    return out.select("row", "deviation", F.posexplode("whitened").alias("at", "white")).select(
        "row", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation",
        F.col("white").alias("whitened"), F.get(share, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))
