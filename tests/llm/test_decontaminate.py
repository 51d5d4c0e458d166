from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from tallyweave.llm import decontaminate as D
from tallyweave.llm.decontaminate import is_contaminated, scan_documents

ITEM = " ".join(f"w{i}" for i in range(20))
BENCH = [(1, ITEM), (2, "Short Item!"), (3, None), (4, "..."), (5, "héllo über"), (6, "short item")]


def scan(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    return {r.doc_id: r for r in scan_documents(docs, bench, **options).withColumn("bad", is_contaminated()).collect()}


TEXTS = [
    "Lead: " + ITEM.upper().replace(" ", ", ") + " tail",
    " ".join(f"w{i}" for i in range(12)),
    " ".join(f"w{i}" for i in range(2, 15)),
    "a SHORT\nitem here", "", None, "x " * 20000 + "short item", "héllo, ÜBER", "HÉLLO über", "shortitem",
]


def test_windows_offsets_and_rule(spark):
    for options in ({}, {"automaton_bytes": 100}):
        got = scan(spark, TEXTS, **options)
        assert [got[i].scan.n_hit for i in range(len(TEXTS))] == [20, 0, 13, 2, 0, 0, 2, 0, 0, 0]
        assert got[0].scan["items"] == ["1"] and got[3].scan["items"] == ["2", "6"]
        s = got[0].scan.spans[0]
        assert TEXTS[0][s.start : s.stop] == ITEM.upper().replace(" ", ", ")
        assert [got[i].bad for i in range(len(TEXTS))] == [True, False, True, True, False, False, False, False, False, False]
        assert got[6].scan.n_words == 20002 and got[5].scan.n_words == 0 and got[0].n_words == "mine"


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, ITEM)], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert scan_documents(docs, bench).first().scan.n_hit == 0
    assert scan_documents(docs.limit(0), spark.createDataFrame(BENCH, "item_id long, text string")).count() == 0


def test_non_ascii_words_keep_their_case(spark):
    docs = spark.createDataFrame([(1, "say héllo über now")], "doc_id long, text string")
    r = scan_documents(docs, spark.createDataFrame(BENCH, "item_id long, text string")).select(F.col("scan.n_hit").alias("n")).first()
    assert r.n == 2


def lowered(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plainly(texts, items, window=13):
    """(n_words, n_hit, ids) of each text: every window held against every place."""
    out = []
    for text in texts:
        found, hit, ids = lowered(text), set(), set()
        for item_id, item in items:
            own = lowered(item)
            k = min(window, len(own))
            for a in range(len(own) - k + 1 if own else 0):
                for b in range(len(found) - k + 1):
                    if found[b : b + k] == own[a : a + k]:
                        hit.update(range(b, b + k))
                        ids.add(str(item_id))
        out.append((len(found), len(hit), sorted(ids)))
    return out


def test_one_automaton_and_many_against_plain_search(spark, monkeypatch):
    rng = random.Random(4)
    spell = lambda n: " ".join(rng.choice(["a", "B,", "c.", "é", "1"]) for _ in range(n))
    items = [(k, spell(rng.choice([2, 4, 6, 30]))) for k in range(12)] + [(3, "a a a a"), (None, "b c b"), (99, None), (98, "!?")]
    texts = [spell(rng.choice([0, 3, 20, 60])) for _ in range(40)] + [None, items[3][1]] * 3
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, scan_key string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(D, "STRETCH_WORDS", 7)
    monkeypatch.setattr(D, "BUCKET_ROWS", 5)
    named = [("" if i is None else i, t) for i, t in items]
    for window, size in ((4, 1 << 20), (4, 150), (13, 250)):
        rows = scan_documents(docs, bench, "found", window=window, automaton_bytes=size).collect()
        got = {r.doc_id: r for r in rows}
        assert len(rows) == len(texts)
        for i, (n_words, n_hit, ids) in enumerate(plainly(texts, named, window)):
            r = got[i].found
            assert (r.n_words, r.n_hit, r["items"]) == (n_words, n_hit, ids), (texts[i], window, size)
            assert sum(len(lowered(texts[i][s.start : s.stop])) for s in r.spans) == n_hit and got[i].scan_key == "x"


def test_one_very_long_item(spark):
    """No automaton gets more than its bytes and one stretch, so symbols never run out, whatever a single item holds."""
    n, most = 120_000, 1 << 18
    bench = spark.createDataFrame([(1, " ".join(map(str, range(n)))), (2, "7 7 7")], "item_id long, text string")
    items, groups = D.dealt(bench, D.WINDOW, most)
    sizes = {r.group: r.bytes for r in items.groupBy("group").agg(F.sum(F.octet_length("text") + 16).alias("bytes")).collect()}
    assert sizes.keys() == set(range(groups)) and groups > 2 and max(sizes.values()) < most + 8 * D.STRETCH_WORDS
    # the shortest distinct words: 36 of one character, 36 ** 2 of two, ...; with their spaces
    assert (D.AUTOMATON_BYTES + 8 * D.STRETCH_WORDS) / 5 + 36 + 36**2 + 36**3 + 62_000 < 0x110000 - 0x801
    at = [0, 5, D.STRETCH_WORDS - 3, 77_777, n - 13]
    docs = spark.createDataFrame([(i, "x " + " ".join(map(str, range(a, a + 13))) + " y") for i, a in enumerate(at)] + [(9, "1 2 3"), (10, None)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: r.scan for r in scan_documents(docs, bench, automaton_bytes=most).collect()}
    assert [got[i].n_hit for i in (0, 1, 2, 3, 4, 9, 10)] == [13] * 5 + [0, 0]
    assert [got[i].n_words for i in (0, 9, 10)] == [15, 3, 0]


def test_very_long_text(spark):
    text = "w0 w1 " * 300_000 + ITEM + " z" * 1_000_000
    r = scan(spark, [text])[0]
    assert (r.scan.n_words, r.scan.n_hit, r.bad) == (1_600_020, 20, False)
