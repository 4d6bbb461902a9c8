"""Whitening of vectors by their leading principal components.

Entries become whole numbers x = floor(64 c) + 1000000. Each distinct x vector
counts once in the fit: equal vectors meet in one group after a partial
reduction in every task, so a vector that many rows repeat is one row per task
by then. Sums and centred products are added up in tasks and merged by entry
of the matrix; the driver gets one row of dim (dim + 1) / 2 numbers in all.

The covariance is reduced there to tridiagonal form by Householder reflections.
Its leading eigenvalues are bisected by Sturm counts (how many pivots of
T - x I are negative) and their vectors found by inverse iteration; vectors of
a cluster of near eigenvalues are orthogonalised against each other after each
step. Turned back by the reflections they are sent out, at most 16 rows, and
every task projects its own vectors.

Rows whose vector is NULL, or holds NULL or non-finite entries, or entries of
magnitude 2^46 and more (64 c is not exact beyond), are dropped. Vectors of
different lengths are different spaces: each length has its own fit. Components
whose eigenvalue is not above rounding (dim * 2^-52 of the largest) have no
scale and no rows: so have empty vectors, and a fit list of one vector. Equal
eigenvalues leave their vectors free within the space they span. Rows that
repeat a vec_id, or lack it, have rows of their own; only vec_id and embedding
are read; an empty table gives no rows. A deviation beyond a long is NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.session import stored_copy

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 46)
#: Vectors that a task takes into one matrix product.
ROWS = 4_096
#: Neighbours closer than this share of the norm are one cluster.
CLUSTER = 1e-3


def whole_numbers(embedding: str = "embedding") -> Column:
    """The vector as whole numbers, NULL where it is to be dropped."""
    vector = F.col(embedding).cast("array<double>")
    sound = F.forall(vector, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)) & ~F.isnan(c))
    return F.when(sound, F.transform(vector, lambda c: F.floor(F.lit(float(SCALE)) * c) + F.lit(SHIFT)))


# -- eigenvalues of a symmetric matrix ------------------------------------------------------------


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(d, e, q) with q.T @ a @ q tridiagonal: diagonal d, next to it e."""
    a, n = np.array(a, np.float64), len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1 :, k]
        size = np.linalg.norm(x)
        if np.linalg.norm(x[1:]) <= 1e-300 or size == 0:
            continue
        v = x.copy()
        v[0] += size if x[0] >= 0 else -size
        v /= np.linalg.norm(v)
        # a <- h a h with h = 1 - 2 v v', on the rows and columns from k + 1 on
        p = a[k + 1 :, k:] .T @ v
        a[k + 1 :, k:] -= 2 * np.outer(v, p)
        p = a[k:, k + 1 :] @ v
        a[k:, k + 1 :] -= 2 * np.outer(p, v)
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diagonal(a).copy(), np.diagonal(a, -1).copy(), q


def below(d: np.ndarray, e: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each x (Sturm count)."""
    x = np.asarray(x, np.float64)
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    count, pivot = np.zeros(len(x), np.int64), np.ones(len(x))
    for k in range(len(d)):
        pivot = d[k] - x - (e[k - 1] ** 2 / pivot if k else 0.0)
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading_values(d: np.ndarray, e: np.ndarray, most: int) -> np.ndarray:
    """The ``most`` largest eigenvalues, falling, all bisected together."""
    n = len(d)
    reach = np.concatenate([np.abs(e), [0.0]]) + np.concatenate([[0.0], np.abs(e)])
    low, high = np.full(most, (d - reach).min()), np.full(most, (d + reach).max())
    high += np.abs(high) * 1e-15 + 1e-300
    wanted = n - 1 - np.arange(most)  # the k-th largest has so many below it
    for _ in range(200):
        middle = (low + high) / 2
        done = (middle <= low) | (middle >= high)
        if done.all():
            break
        left = below(d, e, middle) > wanted
        high, low = np.where(left & ~done, middle, high), np.where(left | done, low, middle)
    return (low + high) / 2


def _solve(d: np.ndarray, e: np.ndarray, x: float, right: np.ndarray) -> np.ndarray:
    """(T - x I) y = right, by elimination with row exchanges; a vanishing pivot becomes tiny."""
    n = len(d)
    least = np.finfo(float).eps * max(np.abs(d).max(), np.abs(e).max(initial=0.0), 1e-300)
    b = right.copy()
    u, up, up2 = (d - x).copy(), np.append(e, 0.0), np.zeros(n)
    lower = e.copy()
    for k in range(n - 1):
        if abs(lower[k]) > abs(u[k]):
            u[k], lower[k] = lower[k], u[k]
            up[k], u[k + 1] = u[k + 1], up[k]
            if k + 2 < n:
                up2[k], up[k + 1] = up[k + 1], 0.0
            b[k], b[k + 1] = b[k + 1], b[k]
        if abs(u[k]) < least:
            u[k] = least
        m = lower[k] / u[k]
        u[k + 1] -= m * up[k]
        if k + 2 < n:
            up[k + 1] -= m * up2[k]
        b[k + 1] -= m * b[k]
    if abs(u[-1]) < least:
        u[-1] = least
    for k in range(n - 1, -1, -1):
        if k + 1 < n:
            b[k] -= up[k] * b[k + 1]
        if k + 2 < n:
            b[k] -= up2[k] * b[k + 2]
        b[k] /= u[k]
        if abs(b[k]) > 1e200:
            b /= 1e200  # only the direction counts
    return b


def leading_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of falling ``values`` as columns, by inverse iteration."""
    n, norm = len(d), max(np.abs(d).max(), np.abs(e).max(initial=0.0), 1e-300)
    out, cluster, shift = np.zeros((n, len(values))), 0, np.inf
    rng = np.random.default_rng(n)
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * norm:
            cluster = k
        # equal shifts would find one vector again and again
        shift = min(value, shift - 4 * np.finfo(float).eps * norm) if k > cluster else value
        x = rng.standard_normal(n)
        for _ in range(6):
            x = _solve(d, e, shift, x / np.linalg.norm(x))
            x /= np.linalg.norm(x)
            for _ in range(2):  # twice, or rounding leaves a rest
                x -= out[:, cluster:k] @ (out[:, cluster:k].T @ x)
            x /= np.linalg.norm(x)
        out[:, k] = x
    return out


def leading(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, and their vectors as columns."""
    most = min(most, len(a))
    if not np.any(a):  # nothing varies, or there is nothing
        return np.zeros(most), np.eye(len(a))[:, :most]
    d, e, q = tridiagonal(a)
    values = leading_values(d, e, most)
    return values, q @ leading_vectors(d, e, values)


# -- the fit over all vectors ---------------------------------------------------------------------


@dataclass
class Whitening:
    """The fit of one length: ``sums`` of the n vectors, exact; components as columns."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return _mean(self.n, self.sums)

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n x - S)^2, exact; None beyond a long."""
        low, high = int(x.min(initial=0)), int(x.max(initial=0))
        widest = max((max(abs(self.n * low - s), abs(self.n * high - s)) for s in self.sums), default=0)
        if widest < 1 << 31 and len(self.sums) * widest**2 < 1 << 63:
            away = self.n * x - np.array(self.sums, np.int64)
            return (away * away).sum(axis=1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def _mean(n: int, sums: list[int]) -> np.ndarray:
    # the whole part and the rest apart: sums may be beyond what a double holds
    return np.array([s // n + (s % n) / n for s in sums])


def _stack(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), np.int64).reshape(len(vectors), -1)


def _products(rows: DataFrame, dim: int, width: int, centred) -> np.ndarray:
    """The sum of y y' over all rows, y = centred(x) of ``width`` entries."""
    upper = np.triu_indices(width)

    def add(batches):
        total = np.zeros((width, width))
        for pdf in batches:
            for at in range(0, len(pdf), ROWS):
                y = centred(_stack(pdf["x"].iloc[at : at + ROWS]))
                total += y.T @ y
        yield pd.DataFrame({"at": np.arange(len(upper[0])), "v": total[upper]})

    got = rows.where(F.size("x") == dim).select("x").mapInPandas(add, "at long, v double").groupBy("at").agg(
        F.sum("v").alias("v")
    ).toPandas()
    out = np.zeros((width, width))
    at = got["at"].to_numpy()
    out[upper[0][at], upper[1][at]] = got["v"].to_numpy()
    return out + np.triu(out, 1).T


def fit(vectors: DataFrame, most: int = COMPONENTS) -> dict[int, Whitening]:
    """The fit of each length. ``vectors``: x, arrays of whole numbers; repeated ones count once."""
    distinct = stored_copy(vectors.select("x").where(F.size("x") > 0).distinct(), "whitening-distinct")
    entry = distinct.select(F.size("x").alias("dim"), F.posexplode("x").alias("at", "v"))
    sums = entry.groupBy("dim", "at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).collect()
    out = {}
    for dim in sorted({r["dim"] for r in sums}):
        own = sorted((r["at"], int(r["s"]), r["n"]) for r in sums if r["dim"] == dim)
        n, totals = own[0][2], [s for _, s, _ in own]
        mean = _mean(n, totals)
        covariance = _products(distinct, dim, dim, lambda x, mean=mean: x - mean) / n
        values, components = leading(covariance, most)
        used = values > max(0.0, values[0]) * dim * np.finfo(float).eps
        trace = float(np.trace(covariance))
        found = Whitening(n, totals, values[used], components[:, used], values[used] / (trace or 1.0))
        if used.any():
            white = _products(distinct, dim, int(used.sum()), found.project) / n
            found.identity_error = float(np.abs(white - np.eye(len(white))).max())
        out[dim] = found
    return out


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a
    row per row of ``vectors`` (vec_id, embedding) and component."""
    rows = vectors.select("vec_id", whole_numbers().alias("x")).where("x is not null")
    shared = vectors.sparkSession.sparkContext.broadcast(fit(rows, most))

    def project(batches):
        for pdf in batches:
            for dim, part in pdf.groupby(pdf["x"].map(len)):
                own = shared.value.get(int(dim))
                k = len(own.values) if own else 0
                for at in range(0, len(part) if k else 0, ROWS):
                    some = part.iloc[at : at + ROWS]
                    x = _stack(some["x"])
                    yield pd.DataFrame({
                        "vec_id": some["vec_id"].repeat(k).array, "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(some)),
                        "n": own.n, "deviation": pd.array(own.deviations(x), "Int64").repeat(k),
                        "whitened": own.project(x).ravel(), "explained": np.tile(own.explained, len(some)),
                        "identity_error": own.identity_error,
                    })

    return rows.select(F.col("vec_id").cast("long"), "x").mapInPandas(
        project, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
