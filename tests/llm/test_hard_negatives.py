from __future__ import annotations

import math

import numpy as np
import pytest

from tallyweave.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, rank string"


def brute(rows, every=100, positives=5, negatives=5, least=80):
    rows = sorted({(i, tuple(math.floor(float(np.float32(c)) * 256) for c in v), label) for i, v, label in rows})
    out = []
    for i, x, label in rows:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), j, own) for j, y, own in rows)
        for p, pid, _ in [r for r in scored if r[2] == label and r[1] != i][:positives]:
            near = [r for r in scored if r[2] != label and least * -p <= 100 * -r[0] <= 100 * -p][:negatives]
            out += [(i, pid, k + 1, j, -p, -s) for k, (s, j, _) in enumerate(near)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([(i, v, label, "clash") for i, v, label in rows], SCHEMA).repartition(4)
    got = H.mine(df, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


@pytest.mark.parametrize("width", [3, 64, 100])
def test_intervals_hold_the_score(width):
    rng = np.random.default_rng(width)
    x = (rng.normal(size=(300, width)) * rng.choice([1, 30, 500], size=(300, 1))).astype(np.int64)
    x[:3] = 0
    words, align, rest = H.encode(x)
    assert (np.diff(rest, axis=1) <= 1e-9).all() and (align <= rest[:, :-1] + 1e-9).all()
    for q in x[::37]:
        asked = H.Asked(q)
        middle, wide, score = np.zeros(300), np.zeros(300), x @ q
        for k in range(H.CODES):
            unit = np.where(np.unpackbits(words[:, k].view(np.uint8), axis=1, bitorder="little"), 1, -1) / np.sqrt(asked.width)
            turned = H.rotation(asked.width, k) @ H.widened(q[None])[0]
            exact = unit @ turned
            assert (np.abs(asked.product(words[:, k], k) - exact) <= asked.parts[k][3] + 1e-9 * (1 + asked.norm)).all()
            middle, wide = middle + align[:, k] * asked.product(words[:, k], k), wide + align[:, k] * asked.parts[k][3]
            half = wide + asked.norm * (rest[:, k + 1] + H.SLACK * rest[:, 0])
            assert (np.abs(score - middle) <= half + 1e-6).all()


def test_filter_drops_most_rows():
    rng = np.random.default_rng(1)
    v = rng.normal(size=(4000, 64))
    x = np.floor(256 * v / np.linalg.norm(v, axis=1)[:, None]).astype(np.int64)
    import pandas as pd

    words, align, rest = H.encode(x)
    rows = pd.DataFrame({"vec_id": range(4000), "label": 0, "x": list(x), "words": list(words.view(np.int64).reshape(4000, -1)), "align": list(align), "rest": list(rest)})
    block = H.Block(rows)
    left = block.narrowed(np.arange(1, 4000), H.Asked(x[0]), lambda low, high: high >= H.kth_largest(low, 5))
    assert len(left) < 2000


def test_against_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=20) + 0.4).astype(np.float32).tolist(), int(rng.integers(0, 3))) for i in range(400)]
    rows += [(1000 + i, rows[20][1], i % 3) for i in range(90)] + rows[20:40] + [(40, rows[41][1], 1), (-50, rows[3][1], 0)]
    bad = [(901, None, 1), (902, [1.0] * 20, None), (903, [float("nan")] * 20, 1), (904, [None] * 20, 0), (905, [1.0] * 19, 0), (None, [1.0] * 20, 0), (906, [], 0)]
    for every, options in ((10, {}), (50, {"positives": 2, "negatives": 3, "least_hundredths": 95})):
        assert mined(spark, rows + bad, every=every, **options) == brute(rows, every=every, **{"least" if k == "least_hundredths" else k: v for k, v in options.items()})


def test_blocks_and_groups(spark, monkeypatch):
    monkeypatch.setattr(H, "LARGEST_BLOCK", 64 * 8)
    monkeypatch.setattr(H, "GROUP_ANCHORS", 3)
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-2, 3, size=8).astype(float).tolist(), int(i % 7 == 0)) for i in range(200)]
    assert mined(spark, rows, every=20) == brute(rows, every=20)


def test_one_vector_one_label_few_rows_none(spark):
    rows = [(i, [0.5, 0.5], i % 2) for i in range(300)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, [(i, [1.0, i / 9], 4) for i in range(30)], every=10) == []
    assert mined(spark, [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.9, 0.0], 2), (3, [-1.0, 0.0], 1)]) == [(0, 1, 1, 2, 65536, 58880)]
    assert mined(spark, []) == []


def test_large_components(spark):
    rows = [(i, [1e6 * (i + 1), 3.0], i % 2) for i in range(0, 400, 50)]
    assert mined(spark, rows) == brute(rows)
