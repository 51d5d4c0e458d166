"""Whitening of embeddings with components found by FEAST contour integration.

Spark adds up the sums and the centred products of the distinct integer
vectors; what reaches the driver is one number a pair of dimensions. Inertia
counts cut the upper end of the covariance's spectrum into slices of few
eigenvalues. Each slice is a task of its own: a quadrature of complex shifted
solves around the slice projects a random block onto its eigenvectors,
Rayleigh-Ritz extracts them, and the slice's inertia count says whether any is
missing. Rows are projected in Arrow batches beside the scan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, finite_vectors

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Entries are held to this before they become integers, so that they stay exact as doubles.
LARGEST = float(1 << 52)
#: Eigenvalues in a slice, points of the quadrature on half a contour, rounds of one slice.
SLICE, POINTS, ROUNDS = 8, 8, 30
#: A residual under this share of the largest eigenvalue's bound ends the rounds.
RESIDUAL = 4e-15
#: Components whose share of the variance is smaller hold rounding errors only and are left out.
LEAST_SHARE = 1e-11


# -- spectrum of a symmetric matrix ------------------------------------------------------------


def count_below(v: np.ndarray, shift: float) -> int:
    """Eigenvalues of v under `shift`: negative pivots of v - shift * I in a symmetric factorisation with 1 x 1 and 2 x 2 pivots."""
    a = v - shift * np.eye(len(v))
    negative = 0
    while len(a):
        off = np.abs(np.triu(a, 1))
        i, j = np.unravel_index(off.argmax(), off.shape)
        r = int(np.abs(np.diag(a)).argmax())
        if abs(a[r, r]) >= 0.6404 * off[i, j]:
            pivot = a[r, r]
            if pivot == 0:
                return negative
            negative += pivot < 0
            rest = np.delete(np.arange(len(a)), r)
            column = a[rest, r]
            a = a[np.ix_(rest, rest)] - np.outer(column, column) / pivot
        else:
            negative += 1
            rest = np.delete(np.arange(len(a)), (i, j))
            columns = a[np.ix_(rest, (i, j))]
            a = a[np.ix_(rest, rest)] - columns @ np.linalg.solve(a[np.ix_((i, j), (i, j))], columns.T)
        a = (a + a.T) / 2
    return int(negative)


def slices(v: np.ndarray, wanted: int, most: int = SLICE) -> list[tuple[float, float, int]]:
    """(low, high, eigenvalues between) of stretches that hold the `wanted` largest eigenvalues, the lowest stretch first.

    A stretch holds at most `most`, unless they can't be told apart.
    """
    d = len(v)
    top = float(np.abs(v).sum(axis=1).max(initial=0.0)) * 1.01
    if not top > 0:
        return []
    least = top * 1e-13

    def cut(low: float, n_low: int, high: float, n_high: int) -> list[tuple[float, float, int]]:
        """n_low and n_high: eigenvalues under either end."""
        if n_low == n_high or d - n_high >= wanted:
            return []
        if n_high - n_low <= most or high - low < least:
            return [(low, high, n_high - n_low)]
        middle = (low + high) / 2
        n = count_below(v, middle)
        return cut(low, n_low, middle, n) + cut(middle, n, high, n_high)

    return cut(-0.01 * top, 0, top, d)


def in_slice(v: np.ndarray, low: float, high: float, count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of v between low and high, ascending, and their unit eigenvectors as columns."""
    d, bound = len(v), float(np.abs(v).sum(axis=1).max())
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    angles = np.pi * (nodes + 1) / 2
    centre, radius = (low + high) / 2, (high - low) / 2
    inverses = [(w / 2, radius * np.exp(1j * t), np.linalg.inv((centre + radius * np.exp(1j * t)) * np.eye(d) - v)) for t, w in zip(angles, weights, strict=True)]
    size = min(d, count + count // 2 + 4)
    while True:
        block = np.random.default_rng(seed).normal(size=(d, size))
        best = np.inf
        for _ in range(ROUNDS):
            projected = sum(w * (z * (inverse @ block)).real for w, z, inverse in inverses)
            q = np.linalg.qr(projected)[0]
            values, turn = np.linalg.eigh(q.T @ v @ q)
            block = q @ turn
            inside = (values >= low) & (values < high)
            off = np.linalg.norm(v @ block[:, inside] - block[:, inside] * values[inside], axis=0).max(initial=0.0)
            if inside.sum() == count and (off <= RESIDUAL * bound or off > 0.5 * best):
                return values[inside], block[:, inside]
            best = min(best, off) if inside.sum() == count else np.inf
        if size == d:
            raise ArithmeticError(f"{int(inside.sum())} of {count} eigenvalues found between {low} and {high}")
        size = min(d, 2 * size)


def principal(df: DataFrame, v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The `wanted` largest eigenvalues of v, falling, and their eigenvectors as columns; slices are tasks of df's session."""
    spark = df.sparkSession
    parts = slices(v, wanted)
    if not parts:
        return np.zeros(0), np.zeros((len(v), 0))
    shared = spark.sparkContext.broadcast(v)

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for low, high, count in batch.itertuples(index=False):
                values, vectors = in_slice(shared.value, low, high, count)
                yield pd.DataFrame({"value": values, "vector": list(vectors.T)})

    tasks = spark.createDataFrame(parts, "low double, high double, count int").repartition(len(parts))
    found = tasks.mapInPandas(solve, "value double, vector array<double>").collect()
    q = np.linalg.qr(np.array([r.vector for r in found]).T)[0]
    values, turn = np.linalg.eigh(q.T @ v @ q)
    vectors = (q @ turn)[:, ::-1][:, :wanted]
    return values[::-1][:wanted], vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None], 0) < 0, -1, 1)


# -- the operator ------------------------------------------------------------------------------


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id and x of the rows whose vector has only finite entries and the commonest length."""
    whole = lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-LARGEST)), F.lit(LARGEST))) + F.lit(SHIFT)
    return finite_vectors(vectors, "vec_id").select("vec_id", F.transform("embedding", whole).alias("x"))


class Centre:
    """Sums of n vectors: what takes the mean off exact integers."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n, self.sums = n, sums
        self.whole = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = np.array([s % n / n for s in sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole) - self.rest

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S) ** 2; None where that is no long."""
        if self.n * (np.abs(x - self.whole).max(initial=0) + 1) < np.sqrt(2**62 / x.shape[1]):
            off = self.n * (x - self.whole) - np.array([s % self.n for s in self.sums])
            return (off * off).sum(axis=1).tolist()
        exact = [sum((self.n * c - s) ** 2 for c, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [s if s < 2**63 else None for s in exact]


def products(rows: DataFrame, values, n_values: int) -> np.ndarray:
    """Sum of the outer products of values(x), a row of `n_values` numbers for each row of rows(x)."""
    high, low = np.tril_indices(n_values)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((n_values, n_values))
        for batch in batches:
            if len(batch):
                y = values(np.stack(batch["x"].to_list()))
                total += y.T @ y
        yield pd.DataFrame({"i": high, "j": low, "v": total[high, low]})

    out = np.zeros((n_values, n_values))
    for r in rows.select("x").mapInPandas(add, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.v
    return out


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of every row of vectors(vec_id, embedding).

    Entries become integers; each distinct vector of these counts once for the
    mean and the covariance, but every row is whitened, repeated ones too.
    Rows take no part whose vector is null, empty, holds null or non-finite
    entries or has not the commonest length. A component with no variance is
    left out, so fewer vectors than components give fewer components, one
    distinct vector or an empty table none. A deviation beyond a long is null.
    """
    rows = durable(integers(vectors))
    fit = durable(rows.select("x").distinct())
    found = fit.select(F.posexplode("x").alias("i", "c")).groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("c").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    d = len(found)
    centre = Centre(found[0].n if d else 1, [int(r.s) for r in found])
    covariance = products(fit, centre.centred, d) / centre.n
    values, basis = principal(rows, covariance, min(components, d))
    trace = float(np.trace(covariance))
    kept = values > LEAST_SHARE * trace
    values = values[kept]
    basis = basis[:, kept] / np.sqrt(values)
    k = len(values)
    off = np.abs(products(fit, lambda x: centre.centred(x) @ basis, k) / centre.n - np.eye(k)).max(initial=0.0)
    shared = rows.sparkSession.sparkContext.broadcast((centre, basis))

    @F.pandas_udf("struct<deviation: long, whitened: array<double>>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        about, turn = shared.value
        for batch in batches:
            x = np.stack(batch.to_list()) if len(batch) else np.zeros((0, d), dtype=np.int64)
            yield pd.DataFrame({"deviation": pd.Series(about.deviation(x), dtype="Int64"), "whitened": list(about.centred(x) @ turn)})

    def of_component(numbers: np.ndarray) -> Column:
        return F.element_at(F.array(*(F.lit(float(x)) for x in numbers)).cast("array<double>"), F.col("component"))

    each = rows.select("vec_id", project("x").alias("p")).select("vec_id", "p.deviation", F.posexplode("p.whitened").alias("at", "whitened"))
    return each.withColumn("component", F.col("at") + 1).select(
        "vec_id", "component", F.lit(centre.n).cast("long").alias("n"), "deviation", "whitened",
        of_component(values / trace if k else values).alias("explained"), F.lit(float(off)).alias("identity_error"),
    )
