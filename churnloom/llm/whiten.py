"""Whitening of embeddings: blockwise QR, a bidiagonal qd solver, twisted factorisations.

1. Vectors become whole numbers ``floor(64 * c) + 1000000``; the fit list is each distinct one once. Its
   count and its sums by dimension are exact, so rows are centred as ``(n * x - S) / n`` without cancellation.
2. Every task reduces its centred rows to the triangular factor R of their QR factorisation, batch by
   batch; the rows of these factors are reduced again in few tasks, then in one, which never
   holds more than a batch and one factor. The covariance ``R'R / n`` is never formed.
3. That R is brought to upper bidiagonal form by Householder reflections. Differential qd steps with
   shifts (dqds) give its singular values to high relative accuracy, and a twisted factorisation of
   ``B'B - s^2`` for each of them the right singular vector: a component of the covariance. Where
   values lie close together, solves with the same factorisation and orthogonalisation are repeated
   for the whole cluster.
4. All rows are projected, and the covariance of the projected fit list is measured.

Vectors that are null, empty or hold null or non-finite entries are dropped. Rows that repeat, by id or by
vector, each give rows; null ids stay null. Vectors of different lengths are whitened apart, each length with a
fit list of its own; a model has at most COMPONENTS vectors, and models are what reaches the driver. Directions in
which the fit list does not vary (up to rounding) cannot be whitened: they are no components, so one
distinct vector gives no rows, nor does an empty table. Ties between equal variances are directions
of no fixed choice; any of them is a result. Entries beyond ±2^52 count as that; a deviation beyond a long
is given as the largest long. Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnloom.llm.store import only, stored

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: tasks of the second reduction of QR rows, and entries held at a time
MERGERS = 16
BATCH_ENTRIES = 1 << 21
#: singular values closer than this, relative to their size, are worked out together
CLUSTER = 1e-3
EPS = np.finfo(float).eps
LONGEST = np.iinfo(np.int64).max


# ---- the solver ------------------------------------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal a, superdiagonal b and V with ``r = U B V'``, by Householder reflections from both sides."""
    m = np.array(r, float)
    d = m.shape[1]
    v = np.eye(d)
    for k in range(d):
        h, beta = _reflector(m[k:, k])
        m[k:, k:] -= beta * np.outer(h, h @ m[k:, k:])
        if k < d - 2:
            h, beta = _reflector(m[k, k + 1 :])
            m[k:, k + 1 :] -= beta * np.outer(m[k:, k + 1 :] @ h, h)
            v[:, k + 1 :] -= beta * np.outer(v[:, k + 1 :] @ h, h)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """h and beta so that x - beta h (h'x) has zeros behind its first entry."""
    h = np.array(x, float)
    norm = np.linalg.norm(h)
    if norm == 0 or len(h) == 1:
        return h, 0.0
    h[0] += norm if h[0] >= 0 else -norm
    return h, 2.0 / float(h @ h)


def singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Singular values of the bidiagonal (a, b), largest first, by differential qd steps with shifts.

    A step takes (q, e), the squares of a and b, to those of a bidiagonal whose squared values are
    smaller by the shift. When a square on the side has become negligible, the array falls in two;
    a part of one entry is a value, less the shifts made so far.
    """
    out: list[float] = []
    parts = [(np.square(a), np.square(b), 0.0)]
    while parts:
        q, e, total = parts.pop()
        while len(q):
            small = np.flatnonzero(e <= (EPS * EPS) * (total + np.minimum(q[:-1], q[1:])))
            if len(q) == 1:
                out.append(total + q[0])
                break
            if len(small):
                cut = int(small[-1]) + 1
                parts.append((q[:cut], e[: cut - 1], total))
                q, e = q[cut:], e[cut:]
                continue
            if q[0] < q[-1]:  # the smallest values are found at the end
                q, e = _turned(q, e)
            q, e, shift = _shifted(q, e)
            total += shift
    return np.sqrt(np.sort(np.maximum(out, 0.0))[::-1])


def _turned(q: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The array of the flipped bidiagonal: read from the end, the same squares stand for its transpose."""
    return q[::-1].copy(), e[::-1].copy()


def _shifted(q: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One step with a shift below the smallest squared value; the shift shrinks until the step stays positive."""
    # the smaller eigenvalue of the last two rows bounds the smallest one from above
    x, y, z = q[-2] + e[-1], q[-1], e[-1] * q[-1]
    root = np.hypot(x - y, 2 * np.sqrt(z))
    shift = float(max(0.0, 2 * (x * y - z) / (x + y + root))) if x + y + root > 0 else 0.0
    for _ in range(6):
        new_q, new_e, last = _step(q, e, shift)
        if new_q is not None and last >= 0:
            return new_q, new_e, shift
        if new_q is not None and last > -shift:  # failed in the last place only: what is missing there is known
            shift = (shift + last) * (1 - 4 * EPS)
        else:
            shift /= 4
    new_q, new_e, _ = _step(q, e, 0.0)
    return new_q, new_e, 0.0


def _step(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray | None, np.ndarray | None, float]:
    new_q, new_e = np.empty_like(q), np.empty_like(e)
    d = q[0] - shift
    for i in range(len(e)):
        if d < 0:
            return None, None, d
        new_q[i] = d + e[i]
        ratio = q[i + 1] / new_q[i] if new_q[i] else 0.0
        new_e[i] = e[i] * ratio
        d = d * ratio - shift if new_q[i] else q[i + 1] - shift
    new_q[-1] = d
    return new_q, new_e, d


@dataclass
class Twisted:
    """Twisted factorisation of ``B'B - value``: from both ends to the row r where the rest is smallest."""

    lower: np.ndarray
    upper: np.ndarray
    pivots: np.ndarray
    r: int

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray, value: float) -> Twisted:
        n = len(a)
        tiny = EPS * EPS * max(float(np.max(a * a)), 1e-300)
        diag, off = a * a, b / a[:-1]  # B'B = L D L' with D = a^2 and L = 1, b / a
        lower, upper = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
        down, up, s, p = np.empty(n), np.empty(n), np.empty(n), np.empty(n)
        s[0] = -value
        for i in range(n - 1):
            down[i] = diag[i] + s[i] or tiny
            lower[i] = diag[i] * off[i] / down[i]
            s[i + 1] = lower[i] * off[i] * s[i] - value
        down[-1] = diag[-1] + s[-1]
        p[-1] = diag[-1] - value
        for i in range(n - 2, -1, -1):
            if p[i + 1] == 0:  # else a cut in the array (off = 0) would divide zero by zero
                p[i + 1] = tiny
            up[i + 1] = diag[i] * off[i] ** 2 + p[i + 1] or tiny
            t = diag[i] / up[i + 1]
            upper[i] = off[i] * t
            p[i] = p[i + 1] * t - value
        rest = s + p + value
        r = int(np.argmin(np.abs(rest)))
        pivots = np.concatenate([down[:r], [rest[r] or tiny], up[r + 1 :]])
        return cls(lower, upper, pivots, r)

    def solve(self, x: np.ndarray) -> np.ndarray:
        y, n, r = np.array(x, float), len(self.pivots), self.r
        for i in range(1, r + 1):
            y[i] -= self.lower[i - 1] * y[i - 1]
        for i in range(n - 2, r - 1, -1):
            y[i] -= self.upper[i] * y[i + 1]
        return self._back(y / self.pivots)

    def vector(self) -> np.ndarray:
        """The direction that the matrix all but maps to zero."""
        y = np.zeros(len(self.pivots))
        y[self.r] = 1.0
        y = self._back(y)
        return y / np.linalg.norm(y)

    def _back(self, y: np.ndarray) -> np.ndarray:
        for i in range(self.r - 1, -1, -1):
            y[i] -= self.lower[i] * y[i + 1]
        for i in range(self.r, len(y) - 1):
            y[i + 1] -= self.upper[i] * y[i]
        return y


def right_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit right singular vectors (columns) of the bidiagonal for its singular ``values``, largest first."""
    scale = max(float(np.max(np.abs(a))), float(np.max(np.abs(b), initial=0.0)))
    a = np.where(np.abs(a) < EPS * EPS * scale, EPS * EPS * scale, a)
    out = np.zeros((len(a), len(values)))
    random = np.random.default_rng(len(a))
    start = 0
    while start < len(values):
        stop = start + 1
        while stop < len(values) and values[stop - 1] - values[stop] <= CLUSTER * values[stop - 1]:
            stop += 1
        factors = [Twisted.of(a, b, float(v) ** 2) for v in values[start:stop]]
        if stop - start == 1:
            out[:, start] = factors[0].vector()
        else:
            block = random.normal(size=(len(a), stop - start))
            for _ in range(4):
                for k, f in enumerate(factors):
                    v = block[:, k] / np.linalg.norm(block[:, k])
                    v = f.solve(v)
                    for _ in range(2):
                        v = v / np.linalg.norm(v)
                        v = v - block[:, :k] @ (block[:, :k].T @ v)
                    block[:, k] = v / np.linalg.norm(v)
            out[:, start:stop] = block
        start = stop
    return np.linalg.qr(out)[0]  # columns are orthogonal to rounding already


def components(r: np.ndarray, n: int, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(variances, directions as rows, shares of the trace) of the covariance ``r'r / n``, largest first."""
    scale = float(np.max(np.abs(r), initial=0.0))
    if not scale:
        return np.empty(0), np.empty((0, r.shape[1])), np.empty(0)
    a, b, v = bidiagonal(r / scale)
    values = singular_values(a, b)
    share = values**2 / np.sum(values**2)
    whole = min(most, int(np.sum(values > len(a) * EPS * values[0])))
    # a cluster that the last component cuts is worked out as a whole
    stop = whole
    while stop < len(values) and values[stop - 1] - values[stop] <= CLUSTER * values[stop - 1]:
        stop += 1
    z = right_vectors(a, b, values[:stop])[:, :whole]
    return (values[:whole] * scale) ** 2 / n, (v @ z).T, share[:whole]


# ---- on Spark --------------------------------------------------------------------------------


def whole_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, x, dim): entries as whole numbers, rows that take part only."""
    own = only(vectors, **{vec_id: "vec_id", embedding: "e"}).withColumn("e", F.col("e").cast("array<double>"))
    finite = F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    own = own.where(F.col("e").isNotNull() & (F.size("e") > 0)).where(finite)
    bound = F.lit(float(2**52))
    scaled = F.transform("e", lambda c: F.least(F.greatest(F.floor(F.least(F.greatest(c * float(SCALE), -bound), bound)), F.lit(-(2**52))), F.lit(2**52)) + OFFSET)
    return own.select("vec_id", scaled.alias("x"), F.size("e").alias("dim"))


def _matrix(column: pa.Array, dim: int, kind=np.int64) -> np.ndarray:
    return np.asarray(column.flatten()).astype(kind, copy=False).reshape(-1, dim)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows of one length each, not more entries at a time than BATCH_ENTRIES (one row at least)."""
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            mine = batch.filter(pa.array(dims == dim))
            step = max(1, BATCH_ENTRIES // dim)
            for k in range(0, mine.num_rows, step):
                yield dim, mine.slice(k, step)


@dataclass
class Centre:
    """Exact count and sums of the fit list of one length."""

    n: int
    sums: list[int]

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: as longs where they fit, as Python integers otherwise."""
        largest = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums))
        if largest < 2**62:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def rows(self, x: np.ndarray) -> np.ndarray:
        return self.offsets(x).astype(float) / self.n

    def deviations(self, x: np.ndarray) -> np.ndarray:
        off = self.offsets(x)
        if off.dtype != object and float(np.abs(off).max(initial=0)) ** 2 * x.shape[1] < 2**62:
            return (off * off).sum(1)
        return np.array([min(sum(int(c) ** 2 for c in row), LONGEST) for row in off], np.int64)


def centres(fit: DataFrame) -> dict[int, Centre]:
    """Count and sums by dimension for each length of vector; halves of the numbers are summed apart, so no sum overflows."""
    cells = fit.select("dim", F.posexplode("x").alias("at", "x"))
    high, low = F.shiftright("x", 24), F.col("x").bitwiseAND(F.lit((1 << 24) - 1))
    sums = cells.groupBy("dim", "at").agg(F.count("*").alias("n"), F.sum(high).alias("high"), F.sum(low).alias("low"))
    out: dict[int, Centre] = {}
    for row in sums.orderBy("dim", "at").collect():
        out.setdefault(row.dim, Centre(row.n, [])).sums.append((row.high << 24) + row.low)
    return out


def triangular(rows: Iterator[tuple[int, np.ndarray]]) -> dict[int, np.ndarray]:
    """The factor R of all rows of each length, taken a block at a time."""
    factors: dict[int, np.ndarray] = {}
    for dim, block in rows:
        held = factors.get(dim, np.empty((0, dim)))
        factors[dim] = np.linalg.qr(np.concatenate([held, block]), mode="r")
    return factors


def _as_batches(factors: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for dim, r in factors.items():
        rows = pa.ListArray.from_arrays(np.arange(0, r.size + 1, dim, dtype=np.int32), pa.array(np.ascontiguousarray(r, float).ravel()))
        yield pa.RecordBatch.from_arrays([pa.array([dim] * len(r), pa.int32()), rows], ["dim", "r"])


def fit_model(fit: DataFrame, most: int = COMPONENTS) -> dict[int, tuple[Centre, np.ndarray, np.ndarray, np.ndarray]]:
    """(centre, variances, directions, shares) for each length of vector of a fit list (x, dim)."""
    known = centres(fit)

    def first(batches):
        yield from _as_batches(triangular((dim, known[dim].rows(_matrix(b.column("x"), dim))) for dim, b in _blocks(batches)))

    def again(batches):
        yield from _as_batches(triangular((dim, _matrix(b.column("r"), dim, float)) for dim, b in _blocks(batches)))

    def solve(batches):
        for dim, r in triangular((dim, _matrix(b.column("r"), dim, float)) for dim, b in _blocks(batches)).items():
            square = np.zeros((dim, dim))
            square[: len(r)] = r
            e, directions, share = components(square, known[dim].n, most)
            yield pa.RecordBatch.from_pylist(
                [{"dim": dim, "e": e.tolist(), "directions": directions.ravel().tolist(), "share": share.tolist()}], schema=pa.schema(MODEL)
            )

    rows = "dim int, r array<double>"
    reduced = fit.mapInArrow(first, rows).repartition(MERGERS).mapInArrow(again, rows).repartition(1)
    models = reduced.mapInArrow(solve, "dim int, e array<double>, directions array<double>, share array<double>").collect()
    return {m.dim: (known[m.dim], np.array(m.e), np.array(m.directions).reshape(-1, m.dim), np.array(m.share)) for m in models}


MODEL = [("dim", pa.int32()), ("e", pa.list_(pa.float64())), ("directions", pa.list_(pa.float64())), ("share", pa.list_(pa.float64()))]


def identity_errors(fit: DataFrame, models: dict) -> dict[int, float]:
    """Largest entry of (covariance of the whitened fit list) - identity for each length of vector."""

    def moments(batches):
        for dim, b in _blocks(batches):
            centre, e, directions, _ = models[dim]
            if len(e):
                w = centre.rows(_matrix(b.column("x"), dim)) @ directions.T / np.sqrt(e)
                m = np.concatenate([w.sum(0), (w.T @ w).ravel()]).tolist()
                yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([m], pa.list_(pa.float64()))], ["dim", "m"])

    cells = fit.mapInArrow(moments, "dim int, m array<double>").select("dim", F.posexplode("m").alias("at", "m"))
    sums: dict[int, list[float]] = {}
    for row in cells.groupBy("dim", "at").agg(F.sum("m").alias("m")).orderBy("dim", "at").collect():
        sums.setdefault(row.dim, []).append(row.m)
    out = {}
    for dim, m in sums.items():
        centre, e, _, _ = models[dim]
        k = len(e)
        mean, second = np.array(m[:k]) / centre.n, np.array(m[k:]).reshape(k, k) / centre.n
        out[dim] = float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())
    return out


def whiten(vectors: DataFrame, *, most: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """A row for each vector and component: its exact deviation from the mean and its whitened coordinate."""
    own = whole_vectors(vectors, vec_id, embedding)
    kind = own.schema["vec_id"].dataType.simpleString()
    fit = stored(own.select("dim", "x").distinct(), "fit")
    models = fit_model(fit, most)
    errors = identity_errors(fit, models)

    def project(batches):
        for dim, b in _blocks(batches):
            centre, e, directions, share = models[dim]
            k = len(e)
            if not k:
                continue
            x = _matrix(b.column("x"), dim)
            whitened = centre.rows(x) @ directions.T / np.sqrt(e)
            n = len(x)
            at = pa.array(np.repeat(np.arange(n), k))
            columns = [
                b.column("vec_id").take(at),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                pa.array(np.full(n * k, centre.n)),
                pa.array(np.repeat(centre.deviations(x), k)),
                pa.array(whitened.ravel()),
                pa.array(np.tile(share, n)),
                pa.array(np.full(n * k, errors[dim])),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return own.mapInArrow(project, f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
