from __future__ import annotations

import random
import zlib
from collections import defaultdict

import pytest

from tallyweave.llm import sharding as S


def test_balance_groups_and_slots(spark):
    rng = random.Random(2)
    rows = [(i, "".join(rng.choices("abcdé ", k=rng.choice([10, 60, 300])))) for i in range(700)]
    rows += [(1000 + i, "same text " * 3) for i in range(300)]
    rows += [(2000 + 2 * g + k, f"pair {g} " * 5) for g in range(60) for k in range(2)]
    rows += [(None, None), (None, "x"), (5, None), (3, rows[3][1]), (9000, "long " * 600)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, shard int").repartition(5)
    placed = S.place_documents(docs, n_shards=8).cache()
    out = placed.collect()
    told = S.cut_edges(docs, placed).first()
    shards_of = defaultdict(list)
    for r in out:
        if r["size"] > 16 or r.text_crc32:
            shards_of[r.text_crc32, r["size"]].append(r.shard)
    edges = [(a, b) for own in shards_of.values() for i, a in enumerate(own) for b in own[:i]]
    assert (told.edges, told.cut) == (len(edges), sum(a != b for a, b in edges))
    assert told.cut < 0.6 * told.edges  # by key alone seven in eight would be cut
    want = sorted((i is None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"], r.text_crc32) for r in out) == want
    size, slots, groups = defaultdict(int), defaultdict(list), defaultdict(set)
    for r in out:
        size[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        groups[r.text_crc32, r["size"]].add(r.shard)
    mean = sum(size.values()) / 8
    assert set(size) == set(range(8)) and max(abs(v - mean) for v in size.values()) < 0.02 * mean
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    pairs = [groups[zlib.crc32(t.encode()), len(t.encode()) + 16] for i, t in rows if i and 2000 <= i < 3000]
    assert sum(len(p) > 1 for p in pairs) <= 0.1 * len(pairs)


def test_pairs_only_stay_together(spark):
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcdef ", k=rng.randint(40, 400))) for _ in range(1500)]
    rows = [(2 * i + k, t) for i, t in enumerate(texts) for k in range(2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    placed = S.place_documents(docs, n_shards=8).cache()
    told = S.cut_edges(docs, placed).first()
    size = S.loads(placed, 8)
    assert told.edges == 1500 and told.cut <= 0.02 * told.edges
    assert sum(size) == sum(len(t) + 16 for _, t in rows) and max(abs(v - sum(size) / 8) for v in size) < 0.005 * sum(size) / 8


def test_very_uneven_sizes(spark):
    """Documents larger than a shard stand alone, all other shards are even."""
    rng = random.Random(6)
    sizes = [int(200 * rng.paretovariate(1.1)) + 1 for _ in range(2000)]
    sizes = [min(n, sum(sizes) // 25) for n in sizes]
    rows = [(i, f"{i} " + "x" * n) for i, n in enumerate(sizes)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    with pytest.warns(UserWarning, match="larger than a shard"):
        out = S.place_documents(docs).collect()
    size, members = defaultdict(int), defaultdict(int)
    for r in out:
        size[r.shard] += r["size"]
        members[r.shard] += 1
    assert len(out) == 2000 and set(size) == set(range(40))
    alone = {s for s in size if members[s] == 1}
    rest = [v for s, v in size.items() if s not in alone]
    mean = sum(rest) / len(rest)
    assert 0 < len(alone) < 20 and all(size[s] > mean for s in alone)
    assert max(abs(v - mean) for v in rest) < 0.01 * mean


def test_rows_of_one_id(spark):
    """A third of the rows are one row; another third has no id."""
    rows = [(7, "the same row")] * 400 + [(None, f"text {i} " * (1 + i % 9)) for i in range(400)] + [(100 + i, "w " * (i % 50)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    placed = S.place_documents(docs, n_shards=10).cache()
    size = S.loads(placed, 10)
    mean = sum(size) / 10
    assert placed.count() == 1200 and max(abs(v - mean) for v in size) < 0.02 * mean
    assert sorted((r.doc_id is None, r.doc_id or 0, r["size"]) for r in placed.collect()) == sorted((i is None, i or 0, len(t.encode()) + 16) for i, t in rows)


def test_native_plan_small_and_empty(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    out = S.place_documents(docs)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.slot for r in out.collect()) in ([0, 0], [0, 1])
    assert S.place_documents(docs.limit(0)).count() == 0
