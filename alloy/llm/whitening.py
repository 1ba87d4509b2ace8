"""Embedding whitening, its components found by FEAST contour integration.

Spark adds up the covariance of the vectors, a matrix of the vectors' width.
Its largest eigenvalues are first fenced in by inertia counts: by Sylvester's
law the signs of the pivots of an LDLᵀ factorisation of V - σI say how many
eigenvalues lie above σ, so bisection finds intervals with a known number of
them.  For each interval a contour around it in the complex plane is
integrated: the weighted solutions of (zI - V) Q = Y at the quadrature's
points project Y onto the eigenvectors inside.  Rayleigh-Ritz on that
subspace gives Ritz pairs, which are the next Y, until as many pairs have
converged inside the interval as the inertia count demands.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alloy.llm.common import map_arrow, pick, stored

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
MAX_WIDTH = 2048  # the matrix comes to the driver: 32 MB at that width
NODES = 16  # points of the quadrature on the upper half of a contour
TOLERANCE = 1e-13  # residual of a Ritz pair, for a matrix of norm 1
LEAST_SHARE = 1e-11  # of the trace; an eigenvalue below is taken for 0


# ------------------------------------------------------------------ eigenvalues

def positives(a: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are above 0: LDLᵀ by Bunch and Parlett's pivoting."""
    a, n, count = a.copy(), len(a), 0
    alpha = (1 + 17 ** 0.5) / 8
    k = 0
    while k < n:
        rest = np.abs(a[k:, k:])
        on = np.diagonal(rest)
        i = int(on.argmax())
        off = rest - np.diag(on)
        p, q = np.unravel_index(int(off.argmax()), off.shape)
        if on[i] == 0 and off[p, q] == 0:
            return count  # only zeros are left
        if on[i] >= alpha * off[p, q]:
            _swap(a, k, k + i)
            d, col = a[k, k], a[k + 1:, k].copy()
            count += d > 0
            a[k + 1:, k + 1:] -= np.outer(col, col) / d
            k += 1
        else:
            p, q = sorted((int(p), int(q)))
            _swap(a, k, k + p)
            _swap(a, k + 1, k + q)
            block, cols = a[k:k + 2, k:k + 2].copy(), a[k + 2:, k:k + 2].copy()
            count += 1  # its determinant is below 0: one of each sign
            a[k + 2:, k + 2:] -= cols @ np.linalg.solve(block, cols.T)
            k += 2
    return count


def _swap(a: np.ndarray, i: int, j: int) -> None:
    if i != j:
        a[[i, j]] = a[[j, i]]
        a[:, [i, j]] = a[:, [j, i]]


def above(v: np.ndarray, sigma: float) -> int:
    """How many eigenvalues of ``v`` are above ``sigma``."""
    return int(positives(v - sigma * np.eye(len(v))))


def intervals(v: np.ndarray, k: int, most: int = 8) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues inside): intervals that hold the ``k`` largest eigenvalues of ``v`` and few others.

    Norm of ``v`` at most 1.  An interval holds at most ``most`` eigenvalues
    unless they agree to ten digits.
    """
    top, bottom = 1.0 + 2 ** -20, -1.0 - 2 ** -19
    low, high, n = bottom, top, len(v)
    while n != k and high - low > 1e-10:  # the lower end: in a gap below the k-th, if there is one
        mid = (low + high) / 2
        c = above(v, mid)
        low, high, n = (mid, high, c) if c >= k else (low, mid, n)
    out, todo = [], [(low, top, n)]
    while todo:
        a, b, n = todo.pop()
        if not n:
            continue
        if n <= most or b - a <= 1e-10:
            out.append((a, b, n))
            continue
        mid = (a + b) / 2
        c = above(v, mid) - above(v, b)
        todo += [(a, mid, n - c), (mid, b, c)]
    return out


def feast(v: np.ndarray, low: float, high: float, n: int, rounds: int = 40,
          nodes: int = NODES, seed: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` eigenvalues of ``v`` in (low, high] and their eigenvectors.

    ``n`` is the inertia count; an error is raised if fewer or more pairs
    converge.
    """
    d = len(v)
    y = np.random.default_rng(seed).standard_normal((d, min(d, 2 * n + 8)))
    centre, radius = (low + high) / 2, (high - low) / 2
    x, weight = np.polynomial.legendre.leggauss(nodes)
    turn = np.exp(1j * np.pi / 2 * (1 - x))
    found = -1
    for _ in range(rounds):
        q = np.zeros_like(y)
        for t, w in zip(turn, weight, strict=True):  # the lower half is the conjugate of the upper
            q += w / 2 * (radius * t * np.linalg.solve((centre + radius * t) * np.eye(d) - v, y.astype(complex))).real
        u, s, _ = np.linalg.svd(q, full_matrices=False)
        u = u[:, s > 1e-14 * s[0]]
        values, small = np.linalg.eigh(u.T @ v @ u)  # Rayleigh-Ritz
        y = u @ small
        inside = (values > low) & (values <= high)
        bad = np.linalg.norm(v @ y - y * values, axis=0)
        found = int((inside & (bad <= TOLERANCE * d ** 0.5)).sum())
        if found == n == int(inside.sum()):
            return values[inside], y[:, inside]
    raise ArithmeticError(f"{found} of {n} eigenvalues in ({low}, {high}] converged")


def largest(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    scale = float(np.abs(v).sum(axis=1).max())
    if not scale:
        return np.zeros(0), np.zeros((len(v), 0))
    v = v / scale
    parts = [feast(v, a, b, n)[1] for a, b, n in intervals(v, min(k, len(v)))]
    u, _ = np.linalg.qr(np.concatenate(parts, axis=1))  # those of all intervals, once more by Rayleigh-Ritz
    values, small = np.linalg.eigh(u.T @ v @ u)
    order = np.argsort(-values)[:k]
    return values[order] * scale, u @ small[:, order]


# ------------------------------------------------------------------ Spark

@dataclass(frozen=True)
class Whitening:
    """n vectors with sums S; unit components as columns with their eigenvalues; the covariance's trace."""
    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float


def scaled(embeddings: DataFrame, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(x, vec_id): x is floor(scale * entry) + shift; rows with a NULL vector, NULL or non-finite entries go."""
    e = F.col("embedding")
    bad = F.exists(e, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    x = F.transform(e, lambda c: F.floor(c.cast("double") * scale) + shift)
    return pick(embeddings, "vec_id", "embedding").where(e.isNotNull() & ~bad).select(x.alias("x"), "vec_id")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    col = batch.column(0)
    return np.asarray(col.flatten(), np.int64).reshape(batch.num_rows, -1)


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a task and width: width, n, sums."""
    found: dict[int, list] = {}
    for batch in batches:
        widths = np.diff(np.asarray(batch.column(0).offsets))
        for d in np.unique(widths):
            part = _matrix(batch.filter(pa.array(widths == d)))
            at = found.setdefault(int(d), [0, np.zeros(d, np.int64)])
            at[0] += len(part)
            at[1] += part.sum(axis=0)
    for d, (n, s) in found.items():
        yield pa.record_batch([pa.array([d], pa.int32()), pa.array([n], pa.int64()),
                               pa.array([s.tolist()], pa.list_(pa.int64()))], ["width", "n", "sums"])


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n in doubles, the whole part of S / n taken off in whole numbers."""
    return (x - sums // n) - (sums % n) / n


def _products(n: int, sums: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(sums), len(sums)))
        for batch in batches:
            y = _centred(_matrix(batch), n, sums)
            total += y.T @ y
        if total.any():
            yield pa.record_batch([pa.array(range(len(sums)), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))],
                                  ["i", "row"])
    return run


def fit_whitening(embeddings: DataFrame, components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT,
                  max_width: int = MAX_WIDTH) -> Whitening | None:
    """The components of all vectors that ``scaled`` keeps; None without vectors or entries.

    Vectors of different widths, or wider than ``max_width``, raise an
    error.  Two passes over the table; width² sums come to the driver.
    """
    x = scaled(embeddings, scale, shift)
    sums = stored(map_arrow(x.select("x"), _sum, "width int, n long, sums array<long>"), "whitening-sums")
    widths = sums.groupBy("width").agg(F.sum("n").alias("n")).limit(2).collect()
    if len(widths) > 1:
        raise ValueError(f"vectors of different widths: {widths[0]['width']}, {widths[1]['width']}")
    if not widths or not widths[0]["width"]:
        return None
    d, n = widths[0]
    if d > max_width:
        raise ValueError(f"vectors of {d} entries: more than {max_width}")
    found = sums.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).collect()
    s = np.array([r["s"] for r in sorted(found)], np.int64)
    rows = map_arrow(x.select("x"), _products(n, s), "i int, row array<double>")
    cells = rows.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    v = np.zeros((d, d))
    for i, j, value in cells:
        v[i, j] = value / n
    v = (v + v.T) / 2
    trace = float(np.trace(v))
    values, u = largest(v, min(components, d))
    keep = values > LEAST_SHARE * trace
    return Whitening(n, s, values[keep], u[:, keep], trace)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum of (n x - S)² of each row, exact; None beyond a long."""
    far = np.abs(_centred(x, n, sums)).max(initial=0) * n
    if far ** 2 * x.shape[1] < 2 ** 62:
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    total = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, sums, strict=True)) for row in x]
    return [t if t < 2 ** 63 else None for t in total]


def _project(model: Whitening):
    times = model.components / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch)
            white = _centred(x, model.n, model.sums) @ times
            yield pa.record_batch(
                [batch.column(1), pa.array(_deviations(x, model.n, model.sums), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(white) + 1) * white.shape[1], pa.int32()),
                                          pa.array(white.ravel(), pa.float64()))], ["vec_id", "deviation", "whitened"])
    return run


def whiten(embeddings: DataFrame, model: Whitening, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """(vec_id, deviation, whitened: array) of every vector that ``scaled`` keeps."""
    x = scaled(embeddings, scale, shift)
    kind = x.schema["vec_id"].dataType.simpleString()
    return map_arrow(x, _project(model), f"vec_id {kind}, deviation long, whitened array<double>")


def identity_error(white: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity."""
    cells = [F.covar_pop(F.col("whitened")[i], F.col("whitened")[j]).alias(f"v{i}_{j}") for i in range(k) for j in range(i + 1)]
    got = white.agg(*cells).first()
    return max((abs(got[f"v{i}_{j}"] - (i == j)) for i in range(k) for j in range(i + 1)), default=0.0)


def whitened_components(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    ``embeddings``: vec_id, embedding.  Rows whose vector is NULL or holds
    NULL or non-finite entries go; all others are fitted and returned, with
    repeated rows and NULL ids as they are.  component counts from 1 by
    falling eigenvalue; directions in which the vectors don't differ
    (eigenvalue 0) are no components, so that a table of one vector, of equal
    vectors or of none gives no rows.  deviation is NULL beyond a long.
    Entries are up to 2^40 in size.  Other columns are not read.
    """
    spark = embeddings.sparkSession
    kind = embeddings.schema["vec_id"].dataType.simpleString()
    model = fit_whitening(embeddings, components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, "
                                         "explained double, identity_error double")
    white = stored(whiten(embeddings, model), "whitened")
    error = identity_error(white, len(model.values))
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    return (white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation",
                    "whitened", explained[F.col("at")].alias("explained"), F.lit(error).alias("identity_error")))
