from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from tallyweave.llm import jaccard_join as J


def brute(rows, threshold=0.8):
    sets = {}
    for k, (i, t) in enumerate(rows):
        if t is not None:
            w = t.lower().split()
            sets[k] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = Counter()
    for a in sets:
        for b in sets:
            if a < b:
                x, y = sets[a], sets[b]
                if (x == y) or (x and y and len(x & y) >= threshold * len(x | y)):
                    links[a] += 1
                    links[b] += 1
                    parent[max(top(a), top(b))] = min(top(a), top(b))
    smallest = {}
    for k in sets:
        known = [i for i in (smallest.get(top(k)), rows[k][0]) if i is not None]
        smallest[top(k)] = min(known, default=None)
    return sorted((rows[k][0] is None, rows[k][0] or 0, smallest[top(k)] if k in sets else rows[k][0], links[k]) for k in range(len(rows)))


def test_against_brute_force(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcde", k=4))
    rows, n = [], 0
    for _ in range(12):
        base = [word() for _ in range(rng.choice([3, 6, 40, 200]))]
        for _ in range(rng.randint(1, 6)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((n := n + 1, " ".join(copy)))
    rows += [(n + 1 + i, rows[0][1]) for i in range(40)]
    rows += [(9001, ""), (9002, "  "), (9003, None), (9004, None), (None, rows[0][1]), (9005, "One two"), (9006, "one  TWO"), (9007, "z " * 30_000)]
    big = [word() for _ in range(300)]
    for i in range(60):
        copy = list(big)
        copy[i * 5] = word()
        rows.append((10_000 + i, " ".join(copy)))
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, class_id string").repartition(6)
    old, J.BLOCK = J.BLOCK, 16
    try:
        got = sorted((r.doc_id is None, r.doc_id or 0, r.class_id, r.n_links) for r in J.near_duplicates(docs).collect())
    finally:
        J.BLOCK = old
    assert got == brute(rows)


def test_rows_that_share_an_id_are_apart(spark):
    a, b = "a a1 a2 a3 a4 a5", "b b1 b2 b3 b4 b5"
    rows = [(3, a, "x"), (5, a, "y"), (5, b, "y"), (7, b, "z"), (7, "c", "z"), (None, a, "q"), (None, "d", "q"), (8, None, "n"), (8, None, "n"), (9, "e", "v"), (9, "e", "u")]
    docs = spark.createDataFrame([(*r, "w", 1, 2) for r in rows], "doc_id long, text string, source string, key string, own int, id int")
    got = sorted((str(r.doc_id), r.text or "", r.class_id) for r in J.near_duplicates(docs).join(docs.select("doc_id", "text").distinct().withColumnRenamed("doc_id", "i"), F.col("doc_id").eqNullSafe(F.col("i"))).filter("text is not null").collect() if r.doc_id in (3, 9))
    assert set(got) == {("3", a, 3), ("9", "e", 9)}
    kept = sorted((str(r.doc_id), r.text or "", r.source) for r in J.one_of_each(docs).collect())
    assert kept == sorted([("3", a, "x"), ("5", b, "y"), ("7", "c", "z"), ("None", "d", "q"), ("8", "", "n"), ("8", "", "n"), ("9", "e", "u")])
    assert J.one_of_each(docs).columns == docs.columns and J.one_of_each(docs.limit(0)).count() == 0


def test_repeated_rows_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "q")], "doc_id long, text string")
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in J.near_duplicates(docs).collect()) == [(1, 1, 1), (1, 1, 1), (2, 2, 0)]
    assert J.near_duplicates(docs.limit(0)).count() == 0


def test_pruning_keeps_what_may_reach_the_threshold():
    fewest = J.least_matches(0.8, 1e-6)
    assert fewest[0] == 0 and all(a <= b for a, b in zip(fewest, fewest[1:]))
    assert 30 < fewest[96] < 77


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "one long, two long")
    got = {r.id: r.label for r in J.components(edges).collect()}
    assert all(got[i] == 0 for i in range(61)) and got[101] == got[100] == 100


def test_blocks_follow_the_length_of_texts(spark, monkeypatch):
    """A bucket of long texts is cut into more blocks, with the same links."""
    rng = random.Random(12)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(400)]
    rows = []
    for i in range(24):
        words = list(base)
        for k in rng.sample(range(400), i % 6):
            words[k] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, f"short text number {i} of some") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted(map(tuple, J.near_duplicates(docs).collect()))
    monkeypatch.setattr(J, "BLOCK_SHINGLES", 900)
    members = spark.createDataFrame([(1, 24, 9600, i) for i in range(24)], "key long, n long, total long, id long")
    assert J.block_pairs(members).select("a", "b").distinct().count() > 20
    assert sorted(map(tuple, J.near_duplicates(docs).collect())) == want


def test_repeated_rows_with_a_map_column(spark):
    docs = spark.createDataFrame([(1, "one text of five words", k % 3) for k in range(9)] + [(2, None, 5)], "doc_id long, text string, k int")
    docs = docs.withColumn("m", F.create_map(F.lit("k"), F.array("k")))
    got = sorted(J.one_of_each(docs).collect(), key=lambda r: r.doc_id)
    assert [(r.doc_id, r.k, r.m) for r in got] == [(1, 0, {"k": [0]}), (2, 5, {"k": [5]})]
