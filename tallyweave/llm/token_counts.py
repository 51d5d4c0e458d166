"""Exact length histogram of encoded documents, with suffix sums over lengths.

Encoding runs in Arrow batches beside the scan; from there on one row per
distinct length is all that is shuffled. Suffix sums are taken in two levels
(blocks of lengths, then lengths in a block), so no task needs all lengths.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the byte-level BPE cuts a text before merging (fixed by the vocabulary).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Takes any text as one piece.
WHOLE = r"[\s\S]+"
#: Distinct lengths that share a block of the suffix sums.
BLOCK = 4096


#: A run of white space (as the pattern's \\s has it) that is too long for the pattern's look-ahead, which recurses.
LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{2000,}")


@lru_cache(maxsize=2)
def _encoding(vocabulary: bytes, pattern: str):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(text: str, cut, whole) -> int:
    """Tokens of a text; `whole` takes what it gets as one piece.

    A long run of white space before a word is one piece without its last
    character, which goes with the word; at the end of the text all of it is
    one piece. These are the pattern's own cuts.
    """
    total, at = 0, 0
    for run in LONG_SPACE.finditer(text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        total += len(cut.encode_ordinary(text[at : run.start()])) + len(whole.encode_ordinary(text[run.start() : stop]))
        at = stop
    return total + len(cut.encode_ordinary(text[at:]))


def encoded_length(spark: SparkSession, text: Column, vocabulary_path: str = VOCABULARY, pattern: str = PATTERN) -> Column:
    """Number of tokens of the whole text; 0 for null and empty texts.

    The vocabulary (a file of a fixed size, under 1 MB) is read on the driver and broadcast.
    """
    with open(vocabulary_path, "rb") as file:
        shared = spark.sparkContext.broadcast(file.read())

    @F.pandas_udf("long")
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cut, whole = _encoding(shared.value, pattern), _encoding(shared.value, WHOLE)
        for batch in batches:
            yield pd.Series([count_tokens(t, cut, whole) if t else 0 for t in batch], dtype="int64")

    return lengths(text)


def length_histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """One row per distinct length, with what answers any question on context limits.

    Returns n_tokens, docs, tokens (of these documents), docs_upto and
    tokens_upto (of lengths up to this one), docs_beyond, tokens_beyond,
    truncated_tokens (of all documents if cut to this length) and quantile
    (share of documents that are no longer). Nulls count as length 0. An empty
    table gives no rows.
    """
    histogram = lengths.groupBy(F.coalesce(column, F.lit(0)).cast("long").alias("n_tokens")).agg(F.count(F.lit(1)).alias("docs"))
    histogram = histogram.withColumn("tokens", F.col("n_tokens") * F.col("docs")).withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    blocks = histogram.groupBy("block").agg(F.sum("docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    over = Window.partitionBy(F.lit(0))
    later = over.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "block",
        *(F.coalesce(F.sum(f"block_{c}").over(later), F.lit(0)).alias(f"later_{c}") for c in ("docs", "tokens")),
        *(F.sum(f"block_{c}").over(over).alias(f"all_{c}") for c in ("docs", "tokens")),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    joined = histogram.join(blocks, "block").select(
        "*",
        *((F.col(f"later_{c}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(f"{c}_beyond") for c in ("docs", "tokens")),
    )
    return joined.select(
        "n_tokens",
        "docs",
        "tokens",
        (F.col("all_docs") - F.col("docs_beyond")).alias("docs_upto"),
        (F.col("all_tokens") - F.col("tokens_beyond")).alias("tokens_upto"),
        "docs_beyond",
        "tokens_beyond",
        (F.col("all_tokens") - F.col("tokens_beyond") + F.col("n_tokens") * F.col("docs_beyond")).alias("truncated_tokens"),
        ((F.col("all_docs") - F.col("docs_beyond")) / F.col("all_docs")).alias("quantile"),
    )


def truncated_totals(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """Tokens kept, documents cut, for each context limit (between two lengths too)."""
    totals = [F.struct(F.lit(x).cast("long").alias("limit"), F.sum(F.least("n_tokens", F.lit(x)) * F.col("docs")).alias("tokens"), F.sum(F.when(F.col("n_tokens") > x, F.col("docs")).otherwise(0)).alias("docs_cut")) for x in limits]
    return histogram.agg(F.array(*totals).alias("found")).select(F.inline("found"))


def quantile_lengths(histogram: DataFrame, quantiles: list[float]) -> DataFrame:
    """Smallest length that at least the given share of documents does not exceed."""
    found = [F.struct(F.lit(float(q)).alias("quantile"), F.min(F.when(F.col("quantile") >= q, F.col("n_tokens"))).alias("n_tokens")) for q in quantiles]
    return histogram.agg(F.array(*found).alias("found")).select(F.inline("found"))
