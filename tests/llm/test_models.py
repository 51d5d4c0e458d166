from __future__ import annotations

import random
import zlib

import numpy as np

from tallyweave.llm import language_id as L
from tallyweave.llm import toxicity as X


def words(rng, parts, n):
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(n))


def test_toxicity_end_to_end(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 9 == 0
        text = words(rng, ["al", "be", "co", "du"], 30) + (" STUPID! loser" if toxic else "")
        rows.append((i, text, "x"))
        if i % 3 == 0:
            labels.append((i, int(toxic)))
    rows += [(9000, None, "x"), (9001, "", "x"), (None, "stupid loser", "x"), (9002, "fine " * 20_000, "x"), (9003, "ok " * 9 + "Stupid loser", "x"), (9003, "ok " * 9 + "Stupid loser", "x")]
    labels += [(5, None), (None, 1), (0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = X.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = [(r.doc_id, r.s) for r in docs.select("doc_id", X.toxicity(docs, model).alias("s")).collect()]
    assert all((s >= 0.5) == (i is None or i == 9003 or (i < 900 and i % 9 == 0)) for i, s in got)
    assert len({s for i, s in got if i in (9000, 9001)}) == 1


def test_toxicity_keeps_rare_signs():
    rng = np.random.default_rng(6)
    clean = lambda: rng.choice(2000, size=30, replace=False)
    sign = lambda i: np.append(clean(), 5000 + i % 60).astype(np.uint32)
    positive = [sign(i) for i in range(2400)]
    unlabelled = [sign(i // 10) if i % 10 == 0 else clean().astype(np.uint32) for i in range(4800)]
    model = X.fit_nnpu([np.sort(x) for x in positive], [np.sort(x) for x in unlabelled], 0.1)
    score = lambda x: model.bias + sum(model.weights.get(int(f), 0.0) for f in x)
    assert np.mean([score(sign(i)) > 0 for i in range(300)]) > 0.95
    assert np.mean([score(clean()) > 0 for _ in range(300)]) < 0.02


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    model = X.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r.s < 0.5 for r in docs.select(X.toxicity(docs, model).alias("s")).collect())
    assert docs.limit(0).select(X.toxicity(docs, model)).count() == 0


def test_marginals_against_enumeration():
    rng = np.random.default_rng(0)
    old, L.CHUNK = L.CHUNK, 3
    try:
        lengths = np.array([1, 5, 7, 3])
        e, t = rng.normal(size=(16, 3)), rng.normal(size=(3, 3))
        got, at = L.marginals(e, lengths, t), 0
        for n in lengths:
            own = np.zeros((n, 3))
            for path in np.ndindex(*[3] * n):
                score = sum(e[at + k, s] for k, s in enumerate(path)) + sum(t[a, b] for a, b in zip(path, path[1:])) + np.log(np.exp(t[:, path[0]]).sum())
                own[np.arange(n), path] += np.exp(score)
            assert np.allclose(got[at : at + n], own / own.sum(axis=1, keepdims=True))
            at += n
    finally:
        L.CHUNK = old


def test_language_end_to_end(spark):
    rng = random.Random(2)
    parts = {"xx": ["ka", "ko", "ki"], "yy": ["éla", "élo", "ren"], "zz": ["scht", "ung", "ver"]}
    rows = [(i, words(rng, parts[lang], 25), lang) for i in range(240) for lang in [list(parts)[i % 3]]]
    rows += [(900, None, "xx"), (901, "123 | !!", "yy"), (902, "", None), (903, words(rng, parts["yy"], 5) + " " + words(rng, parts["zz"], 40), None), (None, rows[0][1], None), (904, "kaka " * 30_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(docs)
    got = {r.doc_id: r.f for r in docs.select("doc_id", L.language(docs, model).alias("f")).collect()}
    held = [(i, lang) for i, _, lang in rows[:240] if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([got[i].lang == lang for i, lang in held]) >= 0.95
    assert [(got[i].lang, got[i].score) for i in (900, 901, 902)] == [("und", 0.0)] * 3
    assert got[903].lang == "zz" and 0.5 < got[903].score < 1 and got[None].lang == "xx" and got[904].lang == "xx"
    empty = L.train(docs.limit(0))
    assert docs.select(L.language(docs, empty).alias("f")).first().f.lang == "und"


def test_transition_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(4)
    old, L.CHUNK = L.CHUNK, 3
    try:
        lengths = np.array([1, 5, 0, 7, 2])
        n = int(lengths.sum())
        e, t, truth = rng.normal(size=(n, 3)), rng.normal(size=(3, 3)), rng.integers(0, 3, n)

        def likelihood(t):
            total, at = 0.0, 0
            for k in lengths[lengths > 0]:
                start = np.log(np.exp(t).sum(axis=0))  # of any label before the first
                own = lambda path: sum(e[at + i, s] for i, s in enumerate(path)) + start[path[0]] + sum(t[a, b] for a, b in zip(path, path[1:]))  # noqa: B023, E731
                total += own(truth[at : at + k]) - np.log(sum(np.exp(own(path)) for path in np.ndindex(*[3] * k)))
                at += k
            return total

        ahead, _, own_and_later = L.messages(e, lengths, t)
        got = L.transition_gap(ahead, own_and_later, truth, lengths, t)
        for i, j in np.ndindex(3, 3):
            step = np.zeros((3, 3))
            step[i, j] = 1e-5
            assert abs(got[i, j] - (likelihood(t + step) - likelihood(t - step)) / 2e-5) < 1e-6
    finally:
        L.CHUNK = old


def test_risk_gradient_is_that_of_the_clamped_risk():
    rng = np.random.default_rng(3)
    clamped = set()
    for prior in (0.1, 0.9):
        p = np.arange(30) < 12
        out = rng.normal(size=30) + 4 * (prior > 0.5) * p

        def risk(out):
            lose = lambda x: np.logaddexp(0, x)
            rest = lose(out[~p]).mean() - prior * lose(out[p]).mean()  # noqa: B023
            clamped.add(bool(rest < 0))
            return prior * lose(-out[p]).mean() + max(0.0, rest)  # noqa: B023

        got = X.risk_gradient(out, p, prior)
        for i in range(30):
            step = np.zeros(30)
            step[i] = 1e-6
            assert abs(got[i] - (risk(out + step) - risk(out - step)) / 2e-6) < 1e-7
    assert clamped == {False, True}


def test_toxicity_score_is_that_of_the_plain_sum(spark):
    """Each distinct sign of a text counts once, wherever in a text of any length it stands."""
    sign = lambda kind, s: zlib.crc32(kind + s.encode())
    weights = {sign(b"w", "bad"): 1.5, sign(b"w", "worse"): 0.75, sign(b"w", "fine"): 0.25, sign(b"w", "élan"): 2.0} | {sign(b"p", "worst"[:n]): 0.125 * n for n in X.PREFIXES}
    model = X.Model(bias=-2.0, weights=weights, prior=0.1)
    texts = [None, "", "123 !?", "bad", "BAD, bad. (bad)", "worse", "worsening", "fine " * 200_000 + "élan", "x" * 300_000 + " bad", "un-bad b-ad ba", "worst worse"]

    def plain(text):
        found = set()
        for token in (text or "").lower().split():
            word = "".join(c for c in token if c.isalpha())
            found |= ({sign(b"w", word)} | {sign(b"p", word[:n]) for n in X.PREFIXES if len(word) > n}) if word else set()
        return 1 / (1 + np.exp(2.0 - sum(weights.get(f, 0.0) for f in found)))

    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, score int").repartition(3)
    got = {r.doc_id: r.s for r in docs.select("doc_id", X.toxicity(docs, model).alias("s")).collect()}
    assert all(abs(got[i] - plain(t)) < 1e-12 for i, t in enumerate(texts)) and len({round(s, 6) for s in got.values()}) > 4
