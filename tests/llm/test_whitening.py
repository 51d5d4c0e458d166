from __future__ import annotations

import math

import numpy as np
import pytest

from tallyweave.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, component int, n string"


def spectrum(kind, d, rng):
    if kind == "even":
        return rng.random(d)
    if kind == "equal":
        return np.full(d, 3.0)
    if kind == "triples":
        return np.repeat(rng.random(d // 3 + 1), 3)[:d]
    if kind == "flat":
        return np.r_[np.ones(d // 2), np.zeros(d - d // 2)]
    if kind == "steep":
        return 10.0 ** -rng.integers(0, 9, d)
    return 1 + 1e-9 * rng.random(d)


@pytest.mark.parametrize("kind", ["even", "equal", "triples", "flat", "steep", "close"])
def test_slices_and_contours_find_every_eigenvalue(kind):
    rng = np.random.default_rng(3)
    for d in (1, 2, 7, 40, 90):
        turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
        v = (turn * spectrum(kind, d, rng)) @ turn.T
        v = (v + v.T) / 2
        true = np.linalg.eigvalsh(v)
        for shift in rng.random(4):
            assert W.count_below(v, shift) == (true < shift).sum()
        wanted = min(16, d)
        parts = W.slices(v, wanted)
        found = [W.in_slice(v, *part) for part in parts]
        assert [len(values) for values, _ in found] == [count for _, _, count in parts]
        if not parts:
            assert true.max() <= 0
            continue
        values = np.concatenate([x for x, _ in found])
        assert np.abs(np.sort(values)[::-1][:wanted] - true[::-1][:wanted]).max() < 1e-13 * max(true.max(), 1e-300)
        for x, vectors in found:
            assert np.abs(v @ vectors - vectors * x).max() < 1e-12 * true.max()
    assert W.slices(np.zeros((5, 5)), 3) == []


def brute(rows, components=16):
    finite = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = [len(v) for _, v in finite]
    length = max(set(lengths), key=lambda n: (lengths.count(n), n))
    x = [(i, tuple(math.floor(float(np.float32(c)) * 64) + 1_000_000 for c in v)) for i, v in finite if len(v) == length]
    fit = np.array(sorted({v for _, v in x}))
    n, sums = len(fit), fit.sum(axis=0)
    covariance = np.cov(fit.T, bias=True).reshape(length, length)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    kept = values > 1e-9 * np.trace(covariance)
    y = (np.array([v for _, v in x]) - sums / n) @ vectors[:, kept] / np.sqrt(values[kept])
    deviation = [int(((n * np.array(v) - sums) ** 2).sum()) for _, v in x]
    return n, [(i, a, b) for (i, _), a, b in zip(x, deviation, y, strict=True)], values[kept] / np.trace(covariance)


def check(df, rows, components=16):
    n, want, explained = brute(rows, components)
    got = {}
    for r in df.collect():
        assert r.n == n and abs(r.identity_error) < 1e-8
        got.setdefault((r.vec_id, r.deviation), []).append((r.component, r.whitened, r.explained))
    k = len(explained)
    assert len(got) == len({(i, a) for i, a, _ in want})
    signs = np.zeros(k)
    for i, deviation, y in want:
        own = sorted(got[i, deviation])
        times = len(own) // k
        assert [c for c, _, _ in own] == [c for c in range(1, k + 1) for _ in range(times)]
        found = np.array([w for _, w, _ in own[::times]])
        assert np.allclose([e for _, _, e in own[::times]], explained, rtol=1e-9)
        assert np.allclose(np.abs(found), np.abs(y), atol=1e-6)
        signs = np.where(np.abs(y) > 1e-3, np.where(signs == 0, np.sign(found * y), signs), signs)
        assert (np.abs(found - signs * y)[np.abs(y) > 1e-3] < 1e-6).all()
    assert sum(map(len, got.values())) == k * len(want)


def test_against_plain_algebra(spark):
    rng = np.random.default_rng(6)
    rows = [(i, (rng.normal(size=24) * np.linspace(3, 0.5, 24)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)] + [(5, rows[5][1]), (None, rows[6][1])]
    bad = [(901, None), (902, []), (903, [float("nan")] * 24), (904, [None] * 24), (905, [float("inf")] * 24), (906, [1.0] * 23)]
    df = spark.createDataFrame([(i, v, 5, "clash") for i, v in rows + bad], SCHEMA).repartition(5)
    check(W.whiten(df), rows)
    check(W.whiten(df, components=3), rows, 3)


def test_fewer_vectors_than_components(spark):
    rows = [(i, [float(i), float(i * i), 1.0, 0.0]) for i in range(4)]
    df = spark.createDataFrame([(i, v, None, None) for i, v in rows], SCHEMA)
    check(W.whiten(df), rows)
    assert W.whiten(df.filter("vec_id = 1")).count() == 0
    assert W.whiten(df.limit(0)).count() == 0


def test_deviations_beyond_a_long():
    centre = W.Centre(2, [2 * (1 << 52), 10])
    x = np.array([[0, 5], [1 << 52, 5], [(1 << 52) + 3, 7]])
    assert centre.deviation(x) == [None, 0, 36 + 16]
    assert W.Centre(3, [6, 9]).deviation(np.array([[2, 3], [1, 4]])) == [0, 18]


def test_huge_entries(spark):
    df = spark.createDataFrame([(i, [1e30 if i == 0 else 0.0, float(i)], None, None) for i in range(3)], SCHEMA)
    got = W.whiten(df).collect()
    assert {r.vec_id for r in got} == {0, 1, 2} and all(r.deviation is None for r in got if r.vec_id == 0)
