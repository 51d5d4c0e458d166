from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyweave.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>, query_id string"


def brute(rows, every, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    out = {}
    for i in sorted({int(i) for i in ids if i % every == 0}):
        score = (x[np.flatnonzero(ids == i)[0]] * x).sum(axis=1)
        other = np.flatnonzero(ids != i)
        order = other[np.lexsort((ids[other], -score[other]))][:k]
        out[i] = [(int(ids[j]), pytest.approx(score[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_against_brute_force_with_copies(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(400 + i, rows[5][1]) for i in range(150)]
    bad = [(900, None), (901, [0.0] * 8), (902, [float("nan")] * 8), (903, [1.0, None] * 4), (904, [float("inf")] * 8), (905, [1.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows + bad], SCHEMA).repartition(4)
    assert found(N.nearest(df, every=10, k=6)) == brute(rows, 10, 6)
    old, N.BALLS_TOGETHER, N.BLOCK_ROWS = (N.BALLS_TOGETHER, N.BLOCK_ROWS), 2, 64
    try:
        assert found(N.nearest(df, every=50, k=3)) == brute(rows, 50, 3)
    finally:
        N.BALLS_TOGETHER, N.BLOCK_ROWS = old


def test_thousands_of_ties_and_doubles(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, float(rng.integers(1, 10**6)) / 7, 0.1]) for i in range(3000)]
    rows[0] = (0, [1 / 3, 0.0, 1e-9])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = found(N.nearest(df.withColumn("rank", F.lit(1)), every=3000, k=20))[0]
    assert [v for v, _ in got] == list(range(1, 21)) and all(s == 1 / 3 * 1.0 + 1e-9 * 0.1 for _, s in got)


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], ""), (1, [2.0, 0.0], ""), (20, [1.0, 1.0], "")], SCHEMA)
    assert found(N.nearest(df)) == {0: [(1, 2.0), (20, 1.0)], 20: [(1, 2.0), (0, 1.0)]}
    assert N.nearest(df.limit(0)).count() == 0


def test_windows_alone_find_clustered_neighbours(spark):
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(40, 16)) * 5
    rows = [(i, (centres[i % 40] + 0.1 * rng.normal(size=16)).tolist()) for i in range(1600)]
    df = spark.createDataFrame([(i, v, "") for i, v in rows], SCHEMA)
    got, want = found(N.nearest(df, every=40, k=5, window=64, complete=False)), brute(rows, 40, 5)
    hits = [len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 5 for q in want]
    assert np.mean(hits) >= 0.5


def test_hilbert_curve_steps_to_neighbours():
    cells = np.array([(a, b) for a in range(8) for b in range(8)])
    keys = N.hilbert_keys(cells, 3)
    assert sorted(keys.tolist()) == list(range(64))
    path = cells[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_repeated_rows_count_once(spark):
    rng = np.random.default_rng(12)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200 + i, rows[7][1]) for i in range(8)]
    repeated = rows * 2 + [rows[7]] * 30
    df = spark.createDataFrame([(i, v, "") for i, v in repeated], SCHEMA).repartition(3)
    assert found(N.nearest(df, every=10, k=5)) == brute(rows, 10, 5)


def test_exact_ties_go_to_the_smaller_ids():
    ids = np.arange(400)[::-1].copy()
    rows = np.stack([np.ones(400), np.random.default_rng(3).integers(1, 9, size=400)], axis=1).astype(float)
    got = N.best(np.array([7]), np.array([[1.0, 0.0]]), ids, rows, 5)
    assert got["vec_id"].tolist() == [0, 1, 2, 3, 4]
    twice = N.best(np.array([7]), np.array([[1.0, 0.0]]), np.repeat(ids, 60), np.repeat(rows, 60, axis=0), 5)
    assert twice["vec_id"].tolist() == [0, 1, 2, 3, 4]
