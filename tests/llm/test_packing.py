from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyweave.llm import packing as P


def best_fit(counts, window):
    """Free places of the windows that plain best-fit decreasing fills, one document after the other."""
    left = []
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            room = [(x, i) for i, x in enumerate(left) if x >= size]
            if room:
                left[min(room)[1]] -= size
            else:
                left.append(window - size)
    return sorted(left)


def padding(counts, window, least_gap):
    """Padding of a plan; checks that every token lies in one place and that windows have no holes."""
    rules, n = P.plan(counts, window, least_gap)
    windows, pieces = {}, {}
    for of, low, high, at, size, first, each, place in rules:
        for rank in range(low, high):
            k = rank - low
            windows.setdefault(first + k // each, []).append((place + k % each * size, size))
            pieces.setdefault((of, rank), []).append((at, size))
    assert pieces.keys() == {(of, rank) for of, c in counts.items() for rank in range(c)}
    for spans, total in [(v, k[0]) for k, v in pieces.items()] + [(v, None) for v in windows.values()]:
        upto = 0
        for start, size in sorted(spans):
            assert start == upto
            upto += size
        assert upto == total if total else upto <= window
    assert windows.keys() == set(range(n))
    used = [sum(s for _, s in v) for v in windows.values()]
    return sum(window - u for u in used if u & (u - 1))


def test_plan_is_best_fit_decreasing():
    rng = random.Random(5)
    for _ in range(200):
        window = rng.choice([8, 13, 64, 100])
        counts = {rng.randint(1, window - 1): rng.randint(1, rng.choice([2, 9, 60])) for _ in range(rng.randint(0, 12))}
        opened = P.OpenWindows(window)
        for size in sorted(counts, reverse=True):
            opened.place(P.Run(size, 0, size, 0, counts[size]))
        assert sorted(x for x, lots in enumerate(opened.lots) for lot in lots for _ in range(lot.n)) == best_fit(counts, window)
        assert padding(counts, window, 10**6) >= padding(counts, window, 1)


@pytest.mark.parametrize("counts", [{1500: 4000}, {1100: 3}, {2047: 900, 1030: 700}, {1: 5}, {1030 + k: 1 + k % 3 for k in range(1000)}, {}])
def test_gaps_are_filled(counts):
    total = sum(k * c for k, c in counts.items())
    assert padding(counts, P.WINDOW, P.LEAST_GAP) <= 0.005 * total


def test_words_are_encoded_as_in_their_text():
    rng = random.Random(11)
    letters = [*"aAbZ'0 9\t\n\x0b\x1c\x85\xa0é\u0301\u0338ΣσİßÅ\u212b漢한<|>.,;:!?-=", "<|endoftext|>", "<|ENDOFTEXT|>", "'ll", "'S", "it's,", "\u2028", "\u200b"]
    encoder, words = Tokenizer.from_file(P.TOKENIZER), P.WordIds(open(P.TOKENIZER, encoding="utf-8").read())
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 16))) for _ in range(20_000)]
    texts += ["".join(rng.choices([*"abcDE", *map(chr, range(0xC0, 0x100))], k=6)) for _ in range(5_000)]
    texts += ["a" * 500 + " b", "a" * 500 + ","]
    for text in texts:
        assert np.frombuffer(words.ids(text), "<u4").tolist() == encoder.encode(text, add_special_tokens=False).ids, text
    assert max(map(len, words)) <= P.LONGEST_KEPT


def packed(spark, rows, **options):
    docs = spark.createDataFrame([(i, t, "mine", 7) for i, t in rows], "doc_id long, text string, ids string, rank int").repartition(3)
    return P.pack(docs, **options).withColumn("crc", F.crc32("ids"))


def test_round_trip(spark):
    rng = random.Random(8)
    vocabulary = ["Alpha", "beta,", "it's", "x1", "ÀÉ", "漢字", "é", "İI", "<|endoftext|>", "...", "\x1c", "\x85", "Σς"]
    rows = [(i, " \n\t".join(rng.choices(vocabulary, k=rng.choice([1, 3, 30, 200])))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "no id"), (502, "a" * 30_000), (503, "word " * 9_000), (7, "again"), (7, "again"), (2**60 + 1, "x")]
    encoder = Tokenizer.from_file(P.TOKENIZER)
    want = sorted((i is None, i or 0, [*encoder.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows)
    for options in ({}, {"window": 64, "least_gap": 1}):
        pieces = packed(spark, rows, **options).cache()
        got = pieces.collect()
        window, total = options.get("window", P.WINDOW), sum(len(w) for _, _, w in want)
        by_id, by_sequence = {}, {}
        for r in got:
            ids = np.frombuffer(r.ids, "<u4").tolist()
            assert len(ids) == r.length > 0 and r.crc == zlib.crc32(bytes(r.ids))
            by_id.setdefault(r.doc_id, []).append((r.start, ids))
            by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        texts = {}
        for _, i, ids in ((n, None if n else i, ids) for n, i, ids in want):
            texts.setdefault(i, []).append(ids)
        for i, each in texts.items():
            joined = sorted(by_id[i], key=lambda p: p[0])
            if len(each) == 1:
                assert sum((ids for _, ids in joined), []) == each[0]
                assert [s for s, _ in joined] == np.cumsum([0, *(len(ids) for _, ids in joined)])[:-1].tolist()
            else:
                assert sorted(x for _, ids in joined for x in ids) == sorted(x for ids in each for x in ids)
        padded = 0
        for spans in by_sequence.values():
            upto = 0
            for offset, length in sorted(spans):
                assert offset == upto
                upto += length
            assert upto <= window
            padded += upto if upto & (upto - 1) == 0 else window
        assert total <= padded <= 1.02 * total
        full = P.sequences(pieces).withColumn("padded", P.padded_length(F.col("length"), window))
        r = full.agg(F.sum("length").alias("n"), F.sum(F.octet_length("ids")).alias("bytes"), F.sum("padded").alias("padded")).first()
        assert (r.n, r.bytes, r.padded) == (total, 4 * total, padded)
        pieces.unpersist()


def test_empty_table_and_one_hot_length(spark):
    assert packed(spark, []).count() == 0
    pieces = packed(spark, [(i, "same words here") for i in range(400)], window=9, least_gap=1).collect()
    assert sum(r.length for r in pieces) == 1600 and len({r.sequence_id for r in pieces}) <= 184
