from __future__ import annotations

import tiktoken
from pyspark.sql import functions as F

from tallyweave.llm import token_counts as T

TEXTS = ["", None, "hello world", "hello world", "a" * 30_000, "Ünï códe 12345 !!", "x " * 5000, " \n\t "]


def test_lengths_and_histogram_against_brute_force(spark):
    import base64

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(T.VOCABULARY, "rb").read().splitlines())}
    encoding = tiktoken.Encoding("own", pat_str=T.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = [len(encoding.encode_ordinary(t)) if t else 0 for t in TEXTS]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "n_tokens long, text string")
    lengths = rows.select(T.encoded_length(spark, F.col("text")).alias("n_tokens"))
    assert sorted(r.n_tokens for r in lengths.collect()) == sorted(want)
    histogram = T.length_histogram(lengths).cache()
    for r in histogram.collect():
        assert r.docs == want.count(r.n_tokens)
        assert r.docs_upto == sum(w <= r.n_tokens for w in want) and r.docs_beyond == sum(w > r.n_tokens for w in want)
        assert r.tokens_upto == sum(w for w in want if w <= r.n_tokens)
        assert r.truncated_tokens == sum(min(w, r.n_tokens) for w in want)
    limits = [0, 3, 100, 10**9]
    assert {r.limit: (r.tokens, r.docs_cut) for r in T.truncated_totals(histogram, limits).collect()} == {x: (sum(min(w, x) for w in want), sum(w > x for w in want)) for x in limits}
    assert {r.quantile: r.n_tokens for r in T.quantile_lengths(histogram, [0.5, 1.0]).collect()} == {0.5: sorted(want)[3], 1.0: max(want)}


def test_long_white_space_is_cut_as_the_pattern_cuts_it():
    with open(T.VOCABULARY, "rb") as file:
        vocabulary = file.read()
    cut, whole = T._encoding(vocabulary, T.PATTERN), T._encoding(vocabulary, T.WHOLE)
    for space in (" ", "\n", " \n\t", "\u00a0", "\u2003 ", "\x85"):
        run = space * (3000 // len(space))
        for text in (run, f"a{run}", f"a{run}b", f"{run}!x", f"a {run}7{run}'s{run}", f"{run}\x1c{run}é"):
            assert T.count_tokens(text, cut, whole) == len(cut.encode_ordinary(text))


def test_million_spaces(spark):
    texts = [" " * 1_000_000, "\n" * 3_000_000 + "x", "a" * 1_000_000, "ab 12 \n" * 200_000]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(T.encoded_length(spark, F.col("text")).alias("n"))
    assert all(r.n > 100_000 for r in rows.collect())


def test_blocks_and_empty(spark):
    old, T.BLOCK = T.BLOCK, 2
    rows = spark.range(50).select((F.col("id") % 7).alias("n_tokens"))
    got = {r.n_tokens: r.truncated_tokens for r in T.length_histogram(rows).collect()}
    T.BLOCK = old
    assert got == {k: sum(min(i % 7, k) for i in range(50)) for k in range(7)}
    assert T.length_histogram(rows.limit(0)).count() == 0
