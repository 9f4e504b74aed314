"""Whitening of vectors by the leading principal components of all of them.

An entry c becomes the whole number x = floor(64 * c) + 1,000,000. Spark adds up the vectors (exact whole numbers), then
the products of their distances from the rounded mean (exact as well; what the rounding left is taken off afterwards), so
that the covariance is the same on any partitioning. The driver holds this matrix alone, dimensions squared: Householder
reflections make it tridiagonal, bisection on Sturm counts finds the leading eigenvalues, and inverse iteration their
vectors, made orthogonal again inside clusters of near eigenvalues. The projection is broadcast; a further pass over all
rows measures how far the covariance of the projected vectors is from the identity.

Vectors that are null, empty, or hold a null or a non-finite number take no part; an empty table gives no rows. Every other row counts,
repeated and null ids included, and returns. Vectors of different lengths are whitened apart, each length among its own.
Entries beyond 2^52 / 64 saturate there. Components without variance (at most 1e-12 of the first one's) have null
as `whitened` and count as explaining 0, or null where no component has any; `identity_error` covers the others, and is null without
one. `deviation` is null where it exceeds 64 bits. Other columns are not read."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import Shared, ship

ship(__name__)

COMPONENTS = 32
SCALE = 64
SHIFT = 1_000_000
LARGEST = 1 << 52  # of scaled entries: whole numbers up to here are exact as doubles
NO_VARIANCE = 1e-12
NEAR = 1e-3  # eigenvalues closer than this share of the matrix's norm form a cluster
ROUNDS = 6  # of inverse iteration
HALF = 10**18  # sums travel as two decimals, value = high * HALF + low


def usable(rows: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    vector = F.col(vector_column)
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(vector.isNotNull() & (F.size(vector) > 0) & ~odd).select(
        F.col(id_column).alias("vec_id"), vector.cast("array<double>").alias("v")
    )


def by_length(column) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Of an Arrow list column: (length, row numbers, whole numbers x) for each length."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False) * SCALE)
    whole = np.clip(flat, -LARGEST, LARGEST).astype("i8") + SHIFT
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    return [(int(d), at, whole[starts[at][:, None] + np.arange(d)]) for d in np.unique(sizes) for at in [np.flatnonzero(sizes == d)]]


def exact_sum(x: np.ndarray) -> np.ndarray:
    """Column sums as Python's whole numbers."""
    most = int(np.abs(x).max(initial=0)) * len(x)
    return (x if most < 1 << 62 else x.astype(object)).sum(axis=0).astype(object)


def exact_products(y: np.ndarray) -> np.ndarray:
    """Sum of the rows' outer products as Python's whole numbers."""
    most = int(np.abs(y).max(initial=0)) ** 2
    if most >= 1 << 53:
        y = y.astype(object)
        return y.T @ y
    block, total = max(1, (1 << 53) // max(most, 1)), 0
    for i in range(0, len(y), block):
        part = y[i : i + block].astype("f8")
        total = total + (part.T @ part).astype("i8").astype(object)
    return total


def halves(values: list[int]) -> list:
    import pyarrow as pa

    high, low = zip(*(divmod(v, HALF) for v in values)) if values else ((), ())
    return [pa.array([str(v) for v in part], pa.string()) for part in (high, low)]


def whole(r) -> int:
    return int(r.high) * HALF + int(r.low)


def added(parts: DataFrame, *keys: str) -> list:
    amount = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), amount("high"), amount("low")).collect()


def sums(vectors: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per length: the number of vectors and their exact sums per dimension."""

    def task(batches):
        import pyarrow as pa

        total: dict = {}
        for batch in batches:
            for d, at, x in by_length(batch.column(0)):
                n, s = total.get(d, (0, 0))
                total[d] = n + len(at), s + exact_sum(x)
        for d, (n, s) in total.items():
            ints = lambda x: pa.array(x, pa.int64())
            yield pa.RecordBatch.from_arrays([ints([d] * d), ints(range(d)), ints([n] * d), *halves(list(s))], names=["d", "i", "n", "high", "low"])

    found: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(added(vectors.select("v").mapInArrow(task, "d long, i long, n long, high string, low string"), "d", "i"), key=lambda r: (r.d, r.i)):
        found.setdefault(r.d, (r.n, []))[1].append(whole(r))
    return found


class Centre:
    """The rounded mean of n vectors, and n times what the rounding left."""

    def __init__(self, n: int, total: list[int]):
        self.n, self.total = n, total
        middle = [(2 * s + n) // (2 * n) for s in total]
        self.middle = np.array(middle, "i8")
        self.rest = [s - n * m for s, m in zip(total, middle)]

    def distance(self, x: np.ndarray) -> np.ndarray:
        """x - S / n"""
        return (x - self.middle).astype("f8") - np.array([r / self.n for r in self.rest])

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n * x - S)^2 of each row, exact."""
        y = x - self.middle
        most = (self.n * int(np.abs(y).max(initial=0)) + self.n) ** 2 * max(1, y.shape[1])
        if most < 1 << 63:
            z = self.n * y - np.array(self.rest, "i8")
            return (z * z).sum(axis=1).tolist()
        z = y.astype(object) * self.n - np.array(self.rest, object)
        return [int(s) if s < 1 << 63 else None for s in (z * z).sum(axis=1)]


def covariance(vectors: DataFrame, centres: dict[int, Centre]) -> dict[int, np.ndarray]:
    """Per length: the covariance matrix, divisor n, each entry the nearest double."""
    shared = Shared(vectors.sparkSession, centres)

    def task(batches):
        import pyarrow as pa

        centres, total = shared.get(), {}
        for batch in batches:
            for d, _, x in by_length(batch.column(0)):
                total[d] = total.get(d, 0) + exact_products(x - centres[d].middle)
        for d, products in total.items():
            i, j = np.triu_indices(d)
            ints = lambda x: pa.array(x, pa.int64())
            yield pa.RecordBatch.from_arrays([ints([d] * len(i)), ints(i), ints(j), ints([0] * len(i)), *halves(list(products[i, j]))],
                                             names=["d", "i", "j", "n", "high", "low"])

    found = {d: np.zeros((d, d)) for d in centres}
    for r in added(vectors.select("v").mapInArrow(task, "d long, i long, j long, n long, high string, low string"), "d", "i", "j"):
        c = centres[r.d]
        found[r.d][r.i, r.j] = found[r.d][r.j, r.i] = (c.n * whole(r) - c.rest[r.i] * c.rest[r.j]) / c.n**2
    return found


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """Diagonal, off-diagonal and the reflections that lead there."""
    a, mirrors = matrix.copy(), []
    n = len(a)
    beside = np.zeros(max(0, n - 1))
    for k in range(n - 2):
        x = a[k + 1 :, k]
        if not x[1:].any():
            beside[k] = x[0]
            mirrors.append(None)
            continue
        v = x / np.abs(x).max()
        length = np.linalg.norm(v)
        beside[k] = -np.copysign(length * np.abs(x).max(), x[0])
        v[0] += np.copysign(length, v[0])
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        mirrors.append(v)
    if n > 1:
        beside[n - 2] = a[n - 1, n - 2]
    return np.diag(a).copy(), beside, mirrors


def sturm_counts(diagonal: np.ndarray, beside: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each point: the negative pivots of T - at."""
    squares = beside**2
    tiny = np.finfo("f8").tiny / np.finfo("f8").eps * max(1.0, squares.max(initial=0))
    count, pivot = np.zeros(len(at), "i8"), np.ones(len(at))
    for i, x in enumerate(diagonal):
        pivot = x - at - (squares[i - 1] / pivot if i else 0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, beside: np.ndarray, k: int) -> np.ndarray:
    """The k largest, falling, by bisection of the interval that Gershgorin's circles allow."""
    n = len(diagonal)
    reach = np.abs(np.concatenate(([0], beside))) + np.abs(np.concatenate((beside, [0])))
    margin = 4 * np.finfo("f8").eps * (np.abs(diagonal).max() + reach.max())
    low, high = np.full(k, (diagonal - reach).min() - margin), np.full(k, (diagonal + reach).max() + margin)
    below = n - 1 - np.arange(k)  # eigenvalues smaller than the wanted one
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return middle
        above = sturm_counts(diagonal, beside, middle) > below
        high, low = np.where(open_ & above, middle, high), np.where(open_ & ~above, middle, low)


def solved(diagonal: np.ndarray, beside: np.ndarray, value: float, right: np.ndarray, least: float) -> np.ndarray:
    """x of (T - value) x = right, by elimination with row exchanges; pivots near zero become `least`."""
    n = len(diagonal)
    d, up, further, x = (diagonal - value).tolist(), [*beside.tolist(), 0.0], [0.0] * n, right.tolist()
    nonzero = lambda pivot: pivot if abs(pivot) > least else least
    for i, low in enumerate(beside.tolist()):
        if abs(d[i]) >= abs(low):
            d[i] = nonzero(d[i])
            factor = low / d[i]
            d[i + 1] -= factor * up[i]
            x[i + 1] -= factor * x[i]
        else:
            factor, old = d[i] / low, up[i]
            d[i], up[i], further[i] = low, d[i + 1], up[i + 1]
            d[i + 1], up[i + 1] = old - factor * up[i], -factor * further[i]
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
    for i in range(n - 1, -1, -1):
        taken = (up[i] * x[i + 1] if i + 1 < n else 0.0) + (further[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = (x[i] - taken) / nonzero(d[i])
    return np.array(x)


def eigenvectors(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors of the tridiagonal matrix, one row per value (falling)."""
    size = np.abs(diagonal).max() + 2 * np.abs(beside).max(initial=0) or 1.0
    eps = np.finfo("f8").eps
    start = np.random.default_rng(0)
    found, first = np.zeros((len(values), len(diagonal))), 0
    for j, value in enumerate(values):
        if j and values[j - 1] - value > NEAR * size:
            first = j
        cluster = found[first:j]
        x = start.uniform(0.5, 1, len(diagonal))
        for _ in range(ROUNDS):
            # members of a cluster are asked for a little apart, so that equal values are told apart
            x = solved(diagonal, beside, value - (j - first) * eps * size, x / np.linalg.norm(x), eps * size)
            for _ in range(2):
                x -= cluster.T @ (cluster @ x)
            if np.linalg.norm(x) < 1:  # lies in the cluster's own span: start anew
                x = start.uniform(-1, 1, len(diagonal))
                x -= cluster.T @ (cluster @ x)
        found[j] = x / np.linalg.norm(x)
    return found


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    scale = np.abs(matrix).max(initial=0) or 1.0
    diagonal, beside, mirrors = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diagonal, beside, k)
    vectors = eigenvectors(diagonal, beside, values)
    for i, v in reversed(list(enumerate(mirrors))):
        if v is not None:
            part = vectors[:, i + 1 :]
            part -= 2 * np.outer(part @ v, v)
    return values * scale, vectors.T


class Whitener:
    """Centre and projection of the vectors of one length."""

    def __init__(self, centre: Centre, matrix: np.ndarray, k: int):
        self.centre, self.trace = centre, float(np.trace(matrix))
        values, self.components = leading(matrix, min(k, len(matrix)))
        self.varied = values > NO_VARIANCE * max(values[0], np.finfo("f8").tiny)
        self.values = np.where(self.varied, values, 0.0)
        self.projection = self.components / np.where(self.varied, np.sqrt(np.where(self.varied, values, 1.0)), np.inf)

    def project(self, x: np.ndarray) -> np.ndarray:
        """One row per vector; 0 for components without variance."""
        return self.centre.distance(x) @ self.projection

    def explained(self) -> list[float | None]:
        return [float(v / self.trace) if self.varied.any() else None for v in self.values]


def learn(vectors: DataFrame, k: int = COMPONENTS) -> dict[int, Whitener]:
    centres = {d: Centre(n, total) for d, (n, total) in sums(vectors).items()}
    return {d: Whitener(centres[d], matrix, k) for d, matrix in covariance(vectors, centres).items()}


def identity_errors(vectors: DataFrame, whiteners: dict[int, Whitener]) -> dict[int, float | None]:
    """Per length: the largest entry of |covariance of the projected vectors - identity|, measured on all of them."""
    shared = Shared(vectors.sparkSession, whiteners)

    def task(batches):
        import pyarrow as pa

        whiteners, total = shared.get(), {}
        for batch in batches:
            for d, _, x in by_length(batch.column(0)):
                w = whiteners[d].project(x)[:, whiteners[d].varied]
                w = np.hstack((np.ones((len(w), 1)), w))
                total[d] = total.get(d, 0) + w.T @ w
        for d, products in total.items():
            i, j = np.triu_indices(len(products))
            columns = [pa.array([d] * len(i), pa.int64()), pa.array(i, pa.int64()), pa.array(j, pa.int64()), pa.array(products[i, j], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["d", "i", "j", "p"])

    parts = vectors.select("v").mapInArrow(task, "d long, i long, j long, p double")
    found: dict[int, dict] = {d: {} for d in whiteners}
    for r in parts.groupBy("d", "i", "j").agg(F.sum("p").alias("p")).collect():
        found[r.d][r.i, r.j] = r.p / whiteners[r.d].centre.n
    mean = lambda m, i: m[0, i]
    error = lambda m, i, j: abs(m[i, j] - mean(m, i) * mean(m, j) - (i == j))
    return {d: max((error(m, i, j) for i, j in m if i), default=None) for d, m in found.items()}


def whiten(rows: DataFrame, k: int = COMPONENTS, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, n, deviation, the whitened vector (`whitened`), `explained` per component and identity_error of each usable row."""
    vectors = usable(rows, id_column, vector_column)
    spark = rows.sparkSession
    whiteners = learn(vectors, k)
    shared = Shared(spark, whiteners)

    def task(batches):
        import pyarrow as pa

        whiteners = shared.get()
        for batch in batches:
            for d, at, x in by_length(batch.column(1)):
                w = whiteners[d].project(x)
                varied = np.broadcast_to(whiteners[d].varied, w.shape)
                flat = pa.array(w.ravel(), pa.float64(), mask=~varied.ravel())
                offsets = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
                columns = [batch.column(0).take(pa.array(at)), pa.array([d] * len(at), pa.int64()),
                           pa.array(whiteners[d].centre.deviation(x), pa.int64()), pa.ListArray.from_arrays(offsets, flat)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "d", "deviation", "whitened"])

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    projected = vectors.mapInArrow(task, f"vec_id {id_type}, d long, deviation long, whitened array<double>")
    errors = identity_errors(vectors, whiteners)
    facts = [(d, w.centre.n, w.explained(), errors[d]) for d, w in whiteners.items()]
    per_length = spark.createDataFrame(facts, "d long, n long, explained array<double>, identity_error double")
    return projected.join(F.broadcast(per_length), "d").select("vec_id", "n", "deviation", "whitened", "explained", "identity_error")


def by_component(whitened: DataFrame) -> DataFrame:
    """One row per vector and component, numbered from 1."""
    each = whitened.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("i", "whitened"))
    return each.select("vec_id", (F.col("i") + 1).alias("component"), "n", "deviation", "whitened", F.get("explained", F.col("i")).alias("explained"), "identity_error")
