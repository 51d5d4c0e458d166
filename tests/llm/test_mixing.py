from __future__ import annotations

import random
from collections import Counter
from fractions import Fraction
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from tallyweave.llm import mixing as M

SCHEMA = "doc_id long, text string, source string"


def fair_queue(rows, repeats=2, share=1.5, weights=(3, 1, 2)):
    """Entries of (doc_id, source, size, text) with how often a plain fair queue takes each, and the targets.

    One entry after the other leaves the source whose next entry would finish
    first, until one does not fit.
    """
    share = Fraction(share)
    copies, queues = Counter(), {}
    for i, text, source in rows:
        text = text or ""
        copies[i, source, text] += 1
        key = f"{'' if i is None else i}:{md5(text.encode()).hexdigest()}:{copies[i, source, text]}:{M.SEED}"
        queues.setdefault(source, []).append((md5(key.encode()).hexdigest()[:16], i if i is not None else -(2**63), len(text.split(" ")) - text.split(" ").count(""), text))
    order = sorted(queues, key=lambda s: (s is None, s or ""))
    totals = {s: sum(e[2] for e in queues[s]) for s in order}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target, budget, left = {}, share * sum(totals.values()), set(order)
    while left:
        level = budget / sum(weight[s] for s in left)
        held = {s for s in left if level * weight[s] > repeats * totals[s]}
        for s in held or left:
            target[s] = Fraction(repeats * totals[s]) if held else level * weight[s]
        left -= held or left
        budget -= sum(target[s] for s in held)
    waiting = {s: [e for e in sorted(queues[s]) if e[2]] * repeats for s in order}
    at, spent, taken, used = dict.fromkeys(order, 0), 0, Counter(), dict.fromkeys(order, 0)
    while True:
        ready = [((used[s] + waiting[s][at[s]][2]) / target[s], k, s) for k, s in enumerate(order) if at[s] < len(waiting[s])]
        if not ready:
            break
        s = min(ready)[2]
        entry = waiting[s][at[s]]
        if spent + entry[2] > sum(target.values()):
            break
        spent, at[s], used[s] = spent + entry[2], at[s] + 1, used[s] + entry[2]
        taken[s, entry] += 1
    each = Counter((None if e[1] == -(2**63) else e[1], s, e[2], taken[s, e]) for s in order for e in queues[s])
    return each, totals, target, used


def check(spark, rows, n_parts=5, **options):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(n_parts)
    want, totals, target, used = fair_queue(rows, **options)
    plan = M.mix(docs, **options).collect()
    assert Counter((r.doc_id, r.source, r["size"], r.times) for r in plan) == want
    for r in plan:
        assert r.source_size == totals[r.source] and abs(r.target - float(target[r.source])) < 1e-6 * max(1, r.target)
        assert 1 <= r.copy <= r.copies
    return used, target


def test_against_a_plain_fair_queue(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("w" * rng.choice([0, 1, 5, 40])), rng.choice(["a", "a", "a", "b", "c", "é", None])) for i in range(400)]
    rows += [(None, "x y", "a"), (7, None, "b"), (7, "q q", "b"), (7, "q q", "b"), (7, "r r", "b"), (7, "q q", "c")]
    used, target = check(spark, rows)
    assert all(abs(used[s] - target[s]) <= 40 for s in target)
    check(spark, rows, 2)


@pytest.mark.parametrize("doc_id", [5, None])
def test_repeated_rows_come_near_their_target(spark, doc_id):
    """A third of all rows and a whole source are copies of one row."""
    rows = [(doc_id, "one two three four five six seven eight nine ten", "a")] * 100
    rows += [(1000 + i, "w " * (1 + i % 7), "b" if i % 2 else "c") for i in range(300)]
    used, target = check(spark, rows)
    assert all(abs(used[s] - target[s]) <= 10 for s in target)


def test_documents_larger_than_their_target(spark):
    """Nothing ends the search early, however late an entry finishes."""
    used, _ = check(spark, [(i, "w " * 300, s) for i, s in enumerate("abc")], share=11 / 32, weights=(1,))
    assert sorted(used.values()) == [0, 0, 300]
    check(spark, [(1, "w " * 5000, "a"), *((2 + i, "w w", "b") for i in range(50))], share=0.5)


def test_end_of_the_mix_in_small_ranges(spark, monkeypatch):
    monkeypatch.setattr(M, "FEW", 3)
    monkeypatch.setattr(M, "RANGES", 4)
    monkeypatch.setattr(M, "BUCKET_ROWS", 4)
    rng = random.Random(9)
    rows = [(i, "w " * rng.choice([1, 3, 20]), rng.choice("abcdef")) for i in range(150)] + [(3, "same here", "a")] * 30
    check(spark, rows)
    check(spark, [(i, "w", chr(97 + i)) for i in range(20)], share=0.7)


def test_mixed_documents_carry_every_row(spark):
    rows = [(i, "w " * (1 + i % 5), "s" if i % 3 else None) for i in range(60)] + [(7, "q q", "t")] * 25 + [(None, "q q", "t")] * 9
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], SCHEMA + ", mixed_row int").repartition(6)
    docs = docs.withColumn("m", F.create_map(F.lit("a"), "mixed_row"))
    plan = M.mix(docs)
    want = Counter()
    for r in plan.collect():
        want[r.doc_id, r.source, r["size"]] += r.times
    mixed = M.mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = mixed.collect()
    assert Counter((r.doc_id, r.source, len(r.text.split())) for r in got) == +want
    assert max(Counter(r.mixed_row for r in got).values()) <= 2
    copies = Counter(r.mixed_row for r in got if r.doc_id == 7 and r.source == "t")
    assert Counter(copies.values()) + Counter({0: 25 - len(copies)}) == Counter(r.times for r in plan.collect() if r.doc_id == 7 and r.source == "t") + Counter({0: 0})


def test_empty_and_wordless(spark):
    assert M.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    got = M.mix(spark.createDataFrame([(1, None, None), (2, "", "a")], SCHEMA)).collect()
    assert [(r.times, r.target) for r in got] == [(0, 0.0), (0, 0.0)]
    assert M.mixed_documents(spark.createDataFrame([(1, None, None)], SCHEMA)).count() == 0
