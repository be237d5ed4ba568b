"""Whitening of embeddings by the leading eigenvectors of their covariance, found by Jacobi-Davidson.

The covariance matrix is never formed: the solver only asks for its products with a few vectors, and
each product is one distributed pass over centred rows. Everything else happens in a search space of
a few dozen vectors on the driver, whose size depends on the dimension alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import materialize
from .vectors import EXACT, is_finite, largest, matrix, padded, whole

Apply = Callable[[np.ndarray], np.ndarray]


def _orthonormal(vectors: np.ndarray, against: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``vectors`` add to ``against``."""
    out = np.empty((len(vectors), 0))
    for column in vectors.T:
        size = np.linalg.norm(column)
        column = column / size if size > 0 else column
        for _ in range(3):
            for base in (against, out):
                column = column - base @ (base.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-8:
                break
            column = column / left
        else:
            out = np.column_stack([out, column])
    return out


def minres(apply: Apply, shifts: np.ndarray, right: np.ndarray, away: np.ndarray, steps: int, goal: float) -> np.ndarray:
    """Solutions of ``(P (A - shift) P) t = r``, a column for each shift, P projecting from ``away``.

    All columns advance together, so that a step is one product with A, whatever their number. Ends
    when every residual has fallen to ``goal`` of its start, or after ``steps``.
    """

    def project(x: np.ndarray) -> np.ndarray:
        return x - away @ (away.T @ x)

    def over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros_like(a), where=b != 0)

    right = project(right)
    t, start = np.zeros_like(right), np.linalg.norm(right, axis=0)
    v_old, v = np.zeros_like(right), over(right, np.broadcast_to(start, right.shape).copy())
    w_old, w = np.zeros_like(right), np.zeros_like(right)
    beta, eta = np.zeros_like(start), start.copy()
    c_old, c = np.ones_like(start), np.ones_like(start)
    s_old, s = np.zeros_like(start), np.zeros_like(start)
    for _ in range(steps):
        u = project(apply(v) - v * shifts)
        alpha = (v * u).sum(axis=0)
        u = project(u - alpha * v - beta * v_old)
        beta_new = np.linalg.norm(u, axis=0)
        beta_new[beta_new <= 1e-14 * np.abs(start)] = 0
        delta = c * alpha - c_old * s * beta
        rho1 = np.hypot(delta, beta_new)
        rho2, rho3 = s * alpha + c_old * c * beta, s_old * beta
        c_old, s_old, c, s = c, s, over(delta, rho1), over(beta_new, rho1)
        w_old, w = w, over(v - rho3 * w_old - rho2 * w, np.broadcast_to(rho1, v.shape).copy())
        t = t + c * eta * w
        eta = -s * eta
        v_old, v, beta = v, over(u, np.broadcast_to(beta_new, u.shape).copy()), beta_new
        if np.all(np.abs(eta) <= goal * start):
            break
    return project(t)


def jacobi_davidson(
    apply: Apply, d: int, k: int, size: float, precision: float = 16 * np.finfo(float).eps, inner: int = 6, rounds: int = 200,
    seed: int = 11,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and eigenvectors of a positive semidefinite matrix.

    ``apply`` multiplies the matrix with a few columns; ``size`` is a bound of its norm, such as its
    trace. Pairs whose residual is at most ``precision * size`` are locked and projected from what
    follows. A larger value that turns up later is found too: locking goes on until the best free
    value lies below the locked ones.
    """
    k = min(k, d)
    # Spare vectors cost no further passes, and with them fewer rounds are needed.
    width, most = min(d, k + 12), min(d, 6 * (k + 12))
    tolerance = precision * size
    locked, values = np.empty((d, 0)), np.empty(0)
    space = _orthonormal(np.random.default_rng(seed).standard_normal((d, width)), locked)
    image = apply(space)
    goal = 0.5
    for _ in range(rounds):
        if not space.shape[1]:
            break
        small = space.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        rest = image - space * theta
        rest -= locked @ (locked.T @ rest)
        size_of = np.linalg.norm(rest, axis=0)
        done = 0
        while done < len(theta) and size_of[done] <= tolerance:
            if len(values) >= k and theta[done] <= np.sort(values)[-k]:
                break
            done += 1
        if done:
            locked, values = np.column_stack([locked, space[:, :done]]), np.concatenate([values, theta[:done]])
            space, image, theta, rest, size_of = space[:, done:], image[:, done:], theta[done:], rest[:, done:], size_of[done:]
        if len(values) >= k and (not len(theta) or theta[0] <= np.sort(values)[-k] + tolerance):
            break
        if locked.shape[1] + space.shape[1] >= d:
            # The space is whole: what is left of the residuals is rounding.
            locked, values = np.column_stack([locked, space]), np.concatenate([values, theta])
            break
        if space.shape[1] + 2 * (k + 4) > most and most < d:
            space, image, theta, rest = (x[..., :width] for x in (space, image, theta, rest))
        open_ = max(1, min(k + 4 - len(values), len(theta)))
        away = np.column_stack([locked, space[:, :open_]])
        steps = minres(apply, theta[:open_], -rest[:, :open_], away, inner, goal)
        goal = max(goal / 4, 1e-4)
        # With the residuals beside the corrections, so that a failed inner solve still gains ground.
        new = _orthonormal(np.column_stack([steps, rest[:, :open_]]), np.column_stack([locked, space]))
        new = new[:, : d - locked.shape[1] - space.shape[1]]
        # Found directions drift from the locked ones by rounding only; products are linear, so
        # only the new ones have to be computed.
        space, image = np.column_stack([space, new]), np.column_stack([image, apply(new)]) if new.shape[1] else image
        if not new.shape[1]:
            fresh = _orthonormal(np.random.default_rng(seed + len(values) + 1).standard_normal((d, 1)), away)
            space, image = np.column_stack([space, fresh]), np.column_stack([image, apply(fresh)])
    else:
        raise ArithmeticError(f"{k - len(values)} eigenpairs did not converge in {rounds} rounds")
    order = np.argsort(-values, kind="stable")[:k]
    return values[order], locked[:, order]


@dataclass(frozen=True)
class Whitening:
    """What the fit found. ``sums`` are exact; ``vectors`` has a column for each component."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def _totals(width: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * width
        for batch in batches:
            rows = matrix(batch.column("x"), width)
            exact = rows if largest(rows) * len(rows) < 1 << 62 else rows.astype(object)
            sums = [a + int(b) for a, b in zip(sums, exact.sum(axis=0))]
            n += len(rows)
        columns = [pa.array([-1, *range(width)], pa.int32()), pa.array([str(n), *map(str, sums)])]
        yield pa.RecordBatch.from_arrays(columns, names=["pos", "total"])

    return run


def _folded(rows: DataFrame, width: int, height: int, columns: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of ``part(rows)`` over all rows, in one pass: each task adds up its rows, the rest is a sum
    by position whose size depends on the shape alone."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, columns))
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                total += part(matrix(batch.column("x").slice(start, 4096), width))
        out = [pa.array(np.arange(height, dtype=np.int32)), *(pa.array(x) for x in total.T)]
        yield pa.RecordBatch.from_arrays(out, names=["pos", *(f"s{i}" for i in range(columns))])

    schema = ", ".join(["pos int", *(f"s{i} double" for i in range(columns))])
    sums = [F.sum(f"s{i}").alias(f"s{i}") for i in range(columns)]
    out = np.zeros((height, columns))
    for row in rows.mapInArrow(run, schema).groupBy("pos").agg(*sums).collect():
        out[row[0]] = row[1:]
    return out


def fit_whitening(rows: DataFrame, width: int, components: int = 4) -> Whitening:
    """Fits on every row of ``rows``, a stored table of padded whole vectors ``x``, all distinct.

    The passes read the table again and again, so it should be stored. Eigenvalues that are zero to
    double precision have no component, so fewer than ``components`` may come out, or none.
    """
    parts = rows.mapInArrow(_totals(width), "pos int, total string").groupBy("pos")
    totals = dict(parts.agg(F.sum(F.col("total").cast("decimal(38,0)"))).collect())
    n = int(totals.get(-1) or 0)
    sums = tuple(int(totals.get(i) or 0) for i in range(width))
    nothing = Whitening(n, sums, np.empty(0), np.empty((width, 0)), 0.0, 0.0)
    if n == 0 or width == 0:
        return nothing
    mean = np.array([s / n for s in sums])
    spread = _folded(rows, width, 1, 1, lambda x: np.square(x - mean).sum().reshape(1, 1))
    trace = float(spread[0, 0]) / n
    if trace == 0:
        return nothing

    def apply(vectors: np.ndarray) -> np.ndarray:
        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ vectors)

        return _folded(rows, width, width, vectors.shape[1], part) / n

    values, vectors = jacobi_davidson(apply, width, components, trace)
    kept = values > 1e-12 * trace
    values, vectors = values[kept], vectors[:, kept]
    # Either sign would do; the largest entry is made positive.
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    k, map_ = len(values), vectors / np.sqrt(values)
    centre = _folded(rows, width, 1, k, lambda x: ((x - mean) @ map_).sum(axis=0, keepdims=True))[0] / n

    def square(x: np.ndarray) -> np.ndarray:
        white = (x - mean) @ map_ - centre
        return white.T @ white

    error = np.abs(_folded(rows, width, k, k, square) / n - np.eye(k)).max()
    return Whitening(n, sums, values, vectors, trace, float(error))


def _whitened(fit: Whitening, width: int):
    mean = np.array([s / max(fit.n, 1) for s in fit.sums])
    map_ = fit.vectors / np.sqrt(fit.values)
    k, bound = len(fit.values), max(map(abs, fit.sums), default=0)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"), width)
            most = fit.n * largest(x) + bound
            exact = x if width * most * most < 1 << 63 else x.astype(object)
            sums = np.array(fit.sums, dtype=exact.dtype)
            deviation = np.square(fit.n * exact - sums).sum(axis=1) if width else np.zeros(len(x), np.int64)
            white = (x - mean) @ map_
            out = [
                batch.column("id").take(pa.array(np.repeat(np.arange(len(x)), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array([str(int(v)) for v in deviation for _ in range(k)], pa.string()),
                pa.array(white.ravel()),
            ]
            yield pa.RecordBatch.from_arrays(out, names=["id", "component", "deviation", "whitened"])

    return run


def whiten(
    vectors: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error), a row for each usable vector
    and component, numbered by falling eigenvalue.

    Entries become ``floor(scale * entry)``, an entry outside the range of long the nearest long. Null
    vectors and those with null or non-finite entries are left out; vectors shorter than the longest
    count as followed by zeros. Each distinct vector counts once in the fit, so groups of copies weigh
    no more than single rows, and all their rows are whitened. ``deviation`` is exact, a decimal of 38
    digits. Rows that repeat an id, or have none, are rows like others; other columns are not looked
    at. An empty table, and one whose vectors are all equal, has no component and gives no rows; vectors that
    span fewer than ``components`` dimensions give as many as they span.
    """
    usable = vectors.filter(is_finite(vector_col)).select(F.col(id_col).alias("id"), whole(vector_col, scale).alias("x"))
    rows, width = padded(usable, "x")
    fit = fit_whitening(materialize(rows.select("x").distinct(), "distinct_vectors"), width, components)
    kind = vectors.schema[id_col].dataType.simpleString()
    out = rows.mapInArrow(_whitened(fit, width), f"id {kind}, component int, deviation string, whitened double")
    shares = F.array(*[F.lit(float(v / fit.trace)) for v in fit.values]) if len(fit.values) else F.array(F.lit(0.0))
    return out.select(
        F.col("id").alias(id_col),
        "component",
        F.lit(fit.n).cast("long").alias("n"),
        F.col("deviation").cast("decimal(38,0)").alias("deviation"),
        "whitened",
        F.element_at(shares, F.col("component")).alias("explained"),
        F.lit(fit.identity_error).alias("identity_error"),
    )
