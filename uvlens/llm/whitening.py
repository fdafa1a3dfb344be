"""Embedding whitening (operator 11): bidiagonal qd solver.

Every entry c of a vector, as double, becomes the long floor(256 c). The fit list is
each distinct integer vector once: n of them, with sums S by dimension. Its covariance
has divisor n.

Method. 1. Blockwise QR: every task centres its rows of the fit list exactly (n x - S in
integers, then one division) and reduces blocks of them to a triangular factor R; factors
are stacked and reduced again, ``FAN`` at a time, level by level, until one d x d factor is
left. No product of rows is summed, so small eigenvalues are not lost to rounding.
2. Householder reflections bring R to an upper bidiagonal B = U'RV. 3. dqds (differential
quotient-difference steps with shifts) finds the singular values of B to high relative
accuracy; eigenvalues are their squares over n. 4. For each wanted value, a stationary and a
progressive qd factorisation of B'B - s^2 I are joined at the index where the remainder is
smallest (twisted factorisation); back substitution from there gives the vector. Vectors of
values that nearly agree are made orthogonal by further steps of inverse iteration.
5. Rows are projected and divided by the root of the eigenvalue.

Only R (d x d) reaches the driver, whatever the number of rows. The fit list is found by a
distinct aggregate, so a vector on a third of all rows is reduced before the shuffle.
Intermediate tables lie in the shared checkpoint folder.

Cases. Vectors that are null or hold null or non-finite entries take no part. Vectors of
another length than the most frequent one (ties: the longer) take no part either, nor
do empty ones. Rows that repeat an id, or have none, are all returned; equal rows get equal
results. Directions without variance are left out: a fit list of rank r gives min(k, r)
components, so a single distinct vector gives no rows. Empty table: empty result. Entries beyond
63 bits saturate. A squared deviation beyond 63 bits is null (it is exact otherwise).
Extra columns are ignored. A component's sign is fixed: its largest entry is positive.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uvlens.llm.common import materialize

SCALE, FAN, BLOCK = 256, 64, 4096
_EPS = np.finfo(float).eps
_TOL = (100 * _EPS) ** 2  # share of a squared value that a coupling may be ignored at
_LONG = 2**63


def quantize(vector: Column) -> Column:
    """floor(256 c) of every entry, as longs."""
    return F.transform(vector, lambda c: F.floor(F.lit(SCALE) * c.cast("double")).cast("bigint"))


# ---- dense solver (numpy; d x d) -------------------------------------------------------

def bidiagonalize(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right factor V of r = U B V' by Householder reflections."""
    a, d = r.astype(float).copy(), r.shape[1]
    v = np.eye(d)
    for k in range(d):
        x = a[k:, k]
        norm = np.linalg.norm(x)
        if norm:
            u = x.copy()
            u[0] += math.copysign(norm, x[0])
            u /= np.linalg.norm(u)
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k < d - 2:
            x = a[k, k + 1:]
            norm = np.linalg.norm(x)
            if norm:
                u = x.copy()
                u[0] += math.copysign(norm, x[0])
                u /= np.linalg.norm(u)
                a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ u, u)
                v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _sweep(q: list[float], e: list[float], s: float) -> tuple[list[float], list[float], float, int]:
    """One dqds step with shift ``s``: the new arrays, the smallest d and where it was."""
    n = len(q)
    qq, ee = [0.0] * n, [0.0] * (n - 1)
    d = low = q[0] - s
    at = 0
    for i in range(n - 1):
        qq[i] = d + e[i]
        t = q[i + 1] / qq[i] if qq[i] else 0.0
        ee[i] = e[i] * t
        d = d * t - s
        if not d >= low:
            low, at = d, i + 1
    qq[n - 1] = d
    return qq, ee, low, at


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the upper bidiagonal (a, b), falling."""
    out: list[float] = []
    todo = [([float(x) ** 2 for x in a], [float(x) ** 2 for x in b], 0.0)]
    while todo:
        q, e, total = todo.pop()
        while q:
            n = len(q)
            if n == 1:
                out.append(q[0] + total)
                break
            # couplings that no longer count: cut there (the last one: a value is found)
            cut = [i for i in range(n - 1) if e[i] <= _TOL * (total + min(q[i], q[i + 1]))]
            if cut:
                for i, j in zip([-1, *cut], cut):
                    todo.append((q[i + 1:j + 1], e[i + 1:j], total))
                q, e = q[cut[-1] + 1:], e[cut[-1] + 1:]
                continue
            if 1.5 * q[0] < q[-1]:  # graded the wrong way: the same values, read backwards
                q, e = q[::-1], e[::-1]
            # a guess below the smallest value: that of the last two rows, then less
            x, y, z = q[-2], q[-1], e[-1]
            half = (x + y + z) / 2
            s = x * y / (half + math.sqrt(max(half * half - x * y, 0.0))) if half else 0.0
            s *= 1 - 4 * _EPS
            for less in (0.75, 0.25, 0.0):
                qq, ee, low, at = _sweep(q, e, s)
                if low >= 0:
                    break
                # too far only at the last row: the negative remainder says by how much
                s = (s + low) * (1 - 4 * _EPS) if less == 0.75 and at == n - 1 and s + low > 0 else s * less
            else:
                qq, ee, low, at = _sweep(q, e, 0.0)
                s = 0.0
            q, e, total = [max(x, 0.0) for x in qq], ee, total + s
    return np.sort(np.array(out))[::-1]


def twisted_vector(a: np.ndarray, b: np.ndarray, value: float) -> np.ndarray:
    """Unit eigenvector of B'B for ``value``, B upper bidiagonal (a, b)."""
    n = len(a)
    tiny = max(float(np.abs(a).max(initial=0)), float(np.abs(b).max(initial=0)), 1e-300) ** 2 * 1e-200
    safe = lambda x: x if abs(x) > tiny else math.copysign(tiny, x)
    d = [safe(float(x) ** 2) for x in a]
    l = [float(b[i]) * float(a[i]) / d[i] for i in range(n - 1)]  # noqa: E741
    down, up = [0.0] * n, [0.0] * n
    mul_l, mul_u = [0.0] * max(n - 1, 0), [0.0] * max(n - 1, 0)
    down[0] = -value
    for i in range(n - 1):
        top = safe(d[i] + down[i])
        mul_l[i] = d[i] * l[i] / top
        down[i + 1] = mul_l[i] * l[i] * down[i] - value
    up[-1] = d[-1] - value
    for i in range(n - 2, -1, -1):
        low = safe(d[i] * l[i] * l[i] + up[i + 1])
        t = d[i] / low
        mul_u[i] = l[i] * t
        up[i] = up[i + 1] * t - value
    rest = [abs(down[i] + up[i] + value) for i in range(n)]
    r = int(np.nanargmin(rest))
    z = np.zeros(n)
    z[r] = 1
    for i in range(r - 1, -1, -1):
        z[i] = -mul_l[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -mul_u[i] * z[i]
    return z / np.linalg.norm(z)


def _inverse_step(a: np.ndarray, b: np.ndarray, value: float, x: np.ndarray) -> np.ndarray:
    """(B'B - value)^-1 x, by elimination with row exchanges of the tridiagonal matrix."""
    n = len(a)
    main = a * a - value
    main[1:] += b * b
    off = a[:-1] * b
    floor = _EPS * max(float(np.abs(main).max()), float(np.abs(off).max(initial=0)), 1e-300)
    rows = [[main[i], off[i] if i < n - 1 else 0.0, 0.0] for i in range(n)]  # entries from the diagonal on
    x = x.astype(float).copy()
    for i in range(n - 1):
        nxt = [off[i], rows[i + 1][0], rows[i + 1][1]]
        if abs(nxt[0]) > abs(rows[i][0]):
            rows[i], nxt = nxt, rows[i]
            x[i], x[i + 1] = x[i + 1], x[i]
        if abs(rows[i][0]) < floor:
            rows[i][0] = floor
        m = nxt[0] / rows[i][0]
        rows[i + 1] = [nxt[1] - m * rows[i][1], nxt[2] - m * rows[i][2], 0.0]
        x[i + 1] -= m * x[i]
    if abs(rows[-1][0]) < floor:
        rows[-1][0] = floor
    for i in range(n - 1, -1, -1):
        for k in (1, 2):
            if i + k < n:
                x[i] -= rows[i][k] * x[i + k]
        x[i] /= rows[i][0]
    return x / np.linalg.norm(x)


def principal(r: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest squared singular values of ``r`` and its right vectors (columns);
    fewer if the rank is smaller."""
    size = float(np.abs(r).max(initial=0))
    if not size:
        return np.zeros(0), np.zeros((r.shape[1], 0))
    a, b, v = bidiagonalize(r / size)
    values = dqds(a, b)
    values = values[values > values[0] * (len(a) * _EPS) ** 2][:k]
    # parts between zero couplings have vectors of their own
    cuts = [i + 1 for i in range(len(b)) if b[i] ** 2 <= _TOL * min(a[i] ** 2, a[i + 1] ** 2)]
    parts = list(zip([0, *cuts], [*cuts, len(a)]))
    owned = sorted(((w, p) for p in parts for w in dqds(a[p[0]:p[1]], b[p[0]:p[1] - 1])), key=lambda t: -t[0])
    z = np.zeros((len(a), len(values)))
    rng = np.random.default_rng(11)
    for i, value in enumerate(values):
        lo, hi = owned[i][1]
        aa, bb = a[lo:hi], b[lo:hi - 1]
        x = np.zeros(len(a))
        x[lo:hi] = twisted_vector(aa, bb, float(value))
        near = [j for j in range(i) if owned[j][1] == (lo, hi) and values[j] - value < 1e-3 * values[j]]
        if near:  # the factorisation alone cannot part values that nearly agree
            start = x.copy() if np.abs(z[:, near].T @ x).max() < 0.5 else np.zeros(len(a))
            if not start.any():
                start[lo:hi] = rng.normal(size=hi - lo)
            for _ in range(4):
                start -= z[:, :i] @ (z[:, :i].T @ start)
                start /= np.linalg.norm(start)
                start[lo:hi] = _inverse_step(aa, bb, float(value), start[lo:hi])
            x = start
        for _ in range(2):
            x -= z[:, :i] @ (z[:, :i].T @ x)
            x /= np.linalg.norm(x)
        z[:, i] = x
    w = v @ z
    top = np.abs(w).argmax(0)
    w = w * np.where(w[top, np.arange(len(values))] < 0, -1.0, 1.0)
    return values * size * size, w


# ---- distributed part ------------------------------------------------------------------

def _matrix(col: pa.Array, d: int) -> np.ndarray:
    """Rows of a list column of equal lengths, as an int64 matrix."""
    return np.asarray(col.flatten()).reshape(-1, d).astype(np.int64, copy=False)


def _scaled(x: np.ndarray, n: int, s: np.ndarray) -> np.ndarray:
    """n x - S, exactly: int64 where it fits, Python integers beyond."""
    most = int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))))
    if n * most + max((abs(int(v)) for v in s), default=0) < _LONG:
        return x * np.int64(n) - s.astype(np.int64)
    return x.astype(object) * n - s


def _triangle(rows: np.ndarray, d: int) -> np.ndarray:
    r = np.linalg.qr(rows, mode="r")
    out = np.zeros((d, d))
    out[:len(r)] = r
    return out


def _reduce_rows(d: int, n: int, s: np.ndarray):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, part = np.zeros((0, d)), None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                x = _matrix(batch.column(0).slice(at, BLOCK), d)
                part = batch.column(1)[0].as_py()
                r = _triangle(np.vstack([r, (_scaled(x, n, s) / n).astype(float)]), d)
        if part is not None:
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["g", "r"])
    return fn


def _reduce_factors(d: int):
    def fn(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            for x in batch.column("r").to_pylist():
                r = _triangle(np.vstack([r, np.frombuffer(x).reshape(d, d)]), d)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["g", "r"])
    return fn


@dataclass(frozen=True)
class Whitening:
    """n and sums of the fit list, eigenvalues and unit components (columns), their shares
    of the variance, and the largest error of the whitened covariance."""
    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def apply(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whitened rows, squared deviations of n x - S, and where these fit a long."""
        c = _scaled(x, self.n, np.array(self.sums, object))
        white = (c / self.n).astype(float) @ self.components / np.sqrt(self.values)
        if c.dtype != object and c.size and int(np.abs(c).max()) ** 2 * c.shape[1] < _LONG:
            return white, (c * c).sum(1), np.ones(len(c), bool)
        far = [sum(int(v) ** 2 for v in row) for row in c]
        fits = np.array([f < _LONG for f in far], bool)
        return white, np.array([f if f < _LONG else 0 for f in far], np.int64), fits


def usable(df: DataFrame, vector: str, *keep: str) -> DataFrame:
    """``keep`` and the quantized vector ``x`` of the rows that take part."""
    v = F.col(vector)
    bad = lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf"))
    return df.where(v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, bad)).select(*keep, quantize(v).alias("x"))


def fit(df: DataFrame, vector: str = "embedding", k: int = 4) -> Whitening | None:
    """The whitening of ``df``'s distinct vectors; None without usable rows."""
    rows = usable(df, vector)
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return None
    d = int(common["d"])
    distinct = materialize(rows.where(F.size("x") == d).distinct(), "fit-list")
    sums = (distinct.mapInArrow(_partial_sums(d), "i INT, s DECIMAL(38,0), n BIGINT")
            .groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).orderBy("i").collect())
    n, s = int(sums[0]["n"]), tuple(int(r["s"]) for r in sums)
    parts = distinct.select("x", F.spark_partition_id().cast("bigint").alias("g"))
    level = materialize(parts.mapInArrow(_reduce_rows(d, n, np.array(s, object)), "g BIGINT, r BINARY"), "factors")
    while (many := level.count()) > 1:
        order = F.floor(F.col("g") / FAN).alias("g")
        level = materialize(level.select(order, "r").groupBy("g").applyInArrow(_reduce_factors(d), "g BIGINT, r BINARY"),
                            "factors", math.ceil(many / FAN))
    r = np.frombuffer(level.first()["r"]).reshape(d, d)
    squares, comps = principal(r, k)
    explained = squares / (r * r).sum() if len(squares) else squares
    model = Whitening(n, s, squares / n, comps, explained)
    if not len(squares):
        return model
    got = transform_x(distinct.select(F.lit(None).cast("bigint").alias("id"), "x"), model, exploded=False)
    pairs = [(i, j) for i in range(len(squares)) for j in range(i, len(squares))]
    w = lambda i: F.col("w")[i]
    row = got.agg(*[F.covar_pop(w(i), w(j)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(row[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
    return Whitening(n, s, squares / n, comps, explained, float(error))


def _partial_sums(d: int):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, [0] * d
        for batch in batches:
            x = _matrix(batch.column(0), d)
            if np.abs(x.astype(float)).max(initial=0) * len(x) < 2.0**62:
                got = x.sum(0).tolist()
            else:
                got = x.astype(object).sum(0).tolist()
            n, s = n + len(x), [a + int(b) for a, b in zip(s, got)]
        if n:
            import decimal
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(d), pa.int32()), pa.array([decimal.Decimal(v) for v in s], pa.decimal128(38, 0)),
                 pa.array([n] * d, pa.int64())], ["i", "s", "n"])
    return fn


def transform_x(rows: DataFrame, model: Whitening, exploded: bool = True) -> DataFrame:
    """id, deviation and whitened entries ``w`` of quantized rows (id, x); exploded: one
    row a component (component from 1, whitened)."""
    d = len(model.sums)

    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                white, far, fits = model.apply(_matrix(part.column(1), d))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(far, pa.int64(), mask=~fits), pa.array(list(white), pa.list_(pa.float64()))],
                    ["id", "deviation", "w"])

    got = rows.mapInArrow(fn, "id BIGINT, deviation BIGINT, w ARRAY<DOUBLE>")
    if not exploded:
        return got
    return got.select("id", "deviation", F.posexplode("w").alias("at", "whitened"))


def whiten(df: DataFrame, vector: str = "embedding", id_col: str = "vec_id", k: int = 4) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable
    row and component up to ``k``."""
    spark = df.sparkSession
    schema = ("vec_id BIGINT, component INT, n BIGINT, deviation BIGINT, whitened DOUBLE, explained DOUBLE, "
              "identity_error DOUBLE")
    model = fit(df, vector, k)
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    rows = usable(df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).alias("v")), "v", "id")
    share = F.array(*[F.lit(float(e)) for e in model.explained])
    return transform_x(rows.where(F.size("x") == len(model.sums)), model).select(
        F.col("id").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
