"""Whitening of vectors by their principal components.

The covariance of the distinct vectors is gathered by many tasks as integers (moments about an integer centre near the
mean), so it is exact whatever the order of the sums. Its eigenvectors are computed once in float32 and then corrected by
Ogita and Aishima's iteration: matrix products in higher precision give, for every pair of columns, the rotation that makes
them orthonormal and the matrix diagonal; convergence is quadratic. Columns whose eigenvalues lie too close together for that
are a cluster: the matrix is restricted to their span, solved there anew, and the columns are turned by its eigenvectors.
The covariance of the whitened vectors is measured, not assumed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskframe.llm.common import ready, written
from maskframe.llm.topk import usable

#: entries of floor(scale * c) beyond this (in absolute value) take no part: sums and deviations would not fit a long
LARGEST = 1 << 40


def refined(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One Ogita-Aishima step for the symmetric ``a`` and near eigenvectors ``x`` (columns): (better columns, eigenvalues,
    gap below which a pair of eigenvalues is one cluster)."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ a @ x
    s = (s + s.T) / 2  # the rotations of a pair must differ in sign to the last place, or a small gap blows the rest up
    value = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(np.diag(s))
    top = np.abs(value).max(initial=0)
    near = 2 * (np.sqrt((off * off).sum()) + top * np.sqrt((r * r).sum()))
    near = max(near, np.sqrt(np.finfo(a.dtype).eps) * top)  # below this gap a rotation would be made of rounding errors
    gap = value[None, :] - value[:, None]
    apart = np.abs(gap) > near
    turn = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ turn, value, near


def clustered(value: np.ndarray, near: float) -> list[np.ndarray]:
    """Groups (of two columns or more) of eigenvalues whose neighbours lie within ``near``."""
    order = np.argsort(value, kind="stable")
    cuts = np.nonzero(np.diff(value[order]) > near)[0] + 1
    return [g for g in np.split(order, cuts) if len(g) > 1]


def eigenpairs(a: np.ndarray, high: type = np.longdouble, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the symmetric ``a`` (in ``high`` precision), falling.

    Starts from float32; a cluster is solved on its own span in double precision, the matrix shifted to the cluster's mean
    and scaled to its size, so that differences far below float32's are resolved. Stops when the columns are
    orthonormal and the matrix diagonal to a few units in the last place of ``high``; columns that share an eigenvalue to that precision are any
    orthonormal basis of their space.
    """
    n = len(a)
    a = (a.astype(high) + a.T.astype(high)) / 2
    size = np.abs(a).max(initial=0)
    if not n or not size:
        return np.zeros(n, high), np.eye(n, dtype=high)
    a = a / size
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(high)
    fine, last = 16 * n * np.finfo(high).eps, np.inf
    for _ in range(rounds):
        new, value, near = refined(a, x)
        for g in clustered(value, near):
            # an orthonormal basis of the span; what the matrix is there, less its mean, is solved apart
            y = new[:, g]
            for _ in range(3):
                y = y @ (1.5 * np.eye(len(g), dtype=high) - 0.5 * (y.T @ y))
            mean = (value[g]).mean()
            t = y.T @ (a @ y) - mean * (y.T @ y)
            wide = np.abs(t).max()
            if wide > fine * fine:
                w = np.linalg.eigh(((t + t.T) / (2 * wide)).astype(np.float64))[1].astype(high)
                new[:, g] = y @ (w @ (1.5 * np.eye(len(g), dtype=high) - 0.5 * (w.T @ w)))
        # columns of a cluster may be any basis that fits; what counts is how far they are from diagonal form
        x = new
        r, s = np.eye(n, dtype=high) - x.T @ x, x.T @ a @ x
        left = max(np.abs(r).max(), np.abs(s - np.diag(np.diag(s))).max())
        if left <= fine or left >= last and left < 1e-15:
            break
        last = left
    value = np.diag(x.T @ a @ x) / np.diag(x.T @ x)
    x = x / np.sqrt((x * x).sum(0))
    order = np.argsort(-value, kind="stable")
    return value[order] * size, x[:, order]


def prepared(rows: DataFrame, scale: int, shift: int, key: str, vector: str) -> DataFrame:
    """(id, absent, x): the rows that take part, entries as long; ``absent`` marks a null id."""
    x = F.transform(F.col(vector), lambda v: F.floor(F.lit(float(scale)) * v.cast("double")).cast("long"))
    kept = ready(rows).filter(usable(F.col(vector))).select(F.col(key).cast("long").alias("id"), x.alias("x"))
    kept = kept.filter(~F.exists("x", lambda v: (v > LARGEST) | (v < -LARGEST)))
    return kept.select(F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNull().alias("absent"), F.transform("x", lambda v: v + F.lit(shift)).alias("x"))


def summed(df: DataFrame, body: Callable[[np.ndarray], list[np.ndarray]], exact: bool = True) -> list:
    """Sums, place by place, of the numbers that ``body`` makes of every batch of ``df``'s vectors ``x``: one row per task, then
    a grouped sum by place (of integers of any size if ``exact``, else of doubles). One number per place reaches the driver."""

    def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for b in batches:
            for lo in range(0, len(b), 4096):
                part = np.concatenate([np.ravel(t) for t in body(np.stack(b["x"].iloc[lo : lo + 4096].to_numpy()))])
                part = part.astype(object) if exact else part
                total = part if total is None else total + part
        if total is not None:
            yield pd.DataFrame({"v": [list(map(str, total)) if exact else total]})

    each = df.select("x").mapInPandas(task, "v array<string>" if exact else "v array<double>").select(F.posexplode("v").alias("place", "v"))
    got = each.groupBy("place").agg(F.sum(F.col("v").cast("decimal(38,0)" if exact else "double")).alias("v")).collect()
    return [int(r["v"]) if exact else r["v"] for r in sorted(got)]


class Fit:
    """Number and sums of the fit list, its exact covariance, and the components kept."""

    def __init__(self, n: int, sums: list[int], covariance: np.ndarray, most: int):
        self.n, self.sums = n, sums
        value, x = eigenpairs(covariance)
        trace = np.trace(covariance)
        # directions without variance (beyond rounding) cannot be scaled to one
        live = value > 1e-13 * len(value) * max(value.max(initial=0), 0)
        self.value, self.vectors = value[live][:most], x[:, live][:, :most]
        self.explained = (self.value / trace).astype(np.float64).tolist() if trace else []

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: int64 where that holds it, else Python integers."""
        far = self.n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, self.sums))
        return x * self.n - np.array(self.sums, np.int64) if far < 1 << 62 else x.astype(object) * self.n - np.array(self.sums, object)

    def whiten(self, x: np.ndarray) -> np.ndarray:
        d = (self.deviations(x) / self.n).astype(np.float64)
        return d @ (self.vectors / np.sqrt(self.value)).astype(np.float64)


def covariance(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance (divisor n) of the vectors ``x`` of ``fit``: exact integer moments about the rounded mean, corrected
    exactly for its distance from the mean, rounded once."""
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], np.int64)
    d = len(sums)

    def moments(x: np.ndarray) -> list[np.ndarray]:
        y = x - centre
        top = int(np.abs(y).max(initial=0))
        if top * top * len(y) < 1 << 53:  # every sum is an integer that a double holds
            f = y.astype(np.float64)
            return [(f.T @ f).astype(np.int64)]
        y = y.astype(object)
        return [y.T @ y]

    flat = summed(fit, moments)
    first = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]
    out = np.zeros((d, d), np.longdouble)
    for i in range(d):
        for j in range(i + 1):
            exact = Fraction(n * flat[i * d + j] - first[i] * first[j], n * n)
            whole = exact.numerator // exact.denominator
            out[i, j] = out[j, i] = np.longdouble(whole) + np.longdouble(float(exact - whole))
    return out


def whiten(rows: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(``key``, component, n, deviation, whitened, explained, identity_error): a row per usable row and component.

    Entries become floor(``scale`` * c) + ``shift``. Rows whose vector is null or empty or has null or non-finite entries take
    no part, nor do those with entries beyond ``LARGEST``, nor (vectors of several lengths cannot share a covariance) those of
    another length than the most frequent one, the longer of equally frequent ones. The fit list holds each distinct vector
    once: n of them, sums S. Null and repeated ids are rows like any other. ``deviation`` is the sum of (n * x - S)^2 (null where
    it exceeds a long), ``whitened`` the projection of x - S / n on the component's unit eigenvector over the root of its
    eigenvalue, ``explained`` the eigenvalue's share of the trace, ``identity_error`` the largest entry of the measured covariance
    of the fit list's whitened vectors less the identity. Components without variance are left out, so a table of equal
    vectors, and an empty one, give no row.
    """
    spark = rows.sparkSession
    empty = spark.createDataFrame([], f"`{key}` long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    every = prepared(rows, scale, shift, key, vector)
    lengths = every.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.desc("d")).first()
    if lengths is None:
        return empty
    d = lengths["d"]
    every = every.filter(F.size("x") == d)
    fit = written(every.select("x").distinct(), "distinct-vectors")
    n = fit.count()
    sums = summed(fit, lambda x: [x.sum(0)])
    model = Fit(n, sums, covariance(fit, n, sums), components)
    k = len(model.value)
    if not k:
        return empty

    def products(x: np.ndarray) -> list[np.ndarray]:
        w = model.whiten(x)
        return [w.T @ w, w.sum(0)]

    flat = np.array(summed(fit, products, exact=False))
    mean = flat[k * k :] / n
    error = float(np.abs(flat[: k * k].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())

    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lo in range(0, len(b), 4096):
                part = b.iloc[lo : lo + 4096]
                x = np.stack(part["x"].to_numpy())
                far = model.deviations(x)
                if far.dtype == object or int(np.abs(far).max()) ** 2 * d >= 1 << 63:
                    total = (far.astype(object) ** 2).sum(1)
                    deviation = pd.array([v if v < 1 << 63 else None for v in total], dtype="Int64")
                else:
                    deviation = (far * far).sum(1)
                yield pd.DataFrame({"id": part["id"], "absent": part["absent"], "deviation": deviation, "whitened": list(model.whiten(x))})

    out = every.mapInPandas(answer, "id long, absent boolean, deviation long, whitened array<double>")
    out = out.select("id", "absent", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return out.select(
        F.when(~F.col("absent"), F.col("id")).alias(key),
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*[F.lit(e) for e in model.explained]), F.col("place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
