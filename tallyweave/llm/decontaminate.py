"""Benchmark decontamination with one Aho-Corasick automaton over normalised items.

Each word of the test items becomes one symbol, so that the automaton's
patterns are short and a document is scanned once, word by word. Offsets of the
hits are carried back to characters of the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import batched

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import before, durable, free_name

WINDOW = 13
#: Stretches of items that one bucket of their running total holds on average.
BUCKET_ROWS = 4096
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: ASCII bytes that are no part of a word become spaces, A-Z lower case.
NORMAL = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
#: UTF-8 bytes of item text that one automaton may hold, beside one stretch more; beyond it the stretches are dealt to several.
#: So few bytes hold far fewer distinct words than there are symbols; their automaton takes some 250 MB at most.
AUTOMATON_BYTES = 2 << 20
#: Words of an item that are dealt together, each stretch with the window's overlap.
STRETCH_WORDS = 20_000
RESULT = "n_words long, n_hit long, items array<string>, spans array<struct<start: int, stop: int>>"
Items = list[tuple[str, str]]


def words(text: str) -> list[bytes]:
    return text.encode().translate(NORMAL).split()


def symbol(i: int) -> str:
    return chr(i + 1 if i + 1 < 0xD800 else i + 1 + 0x800)


class Scanner:
    """All windows of the given items, looked up in one pass over a text's words."""

    def __init__(self, items: Items, window: int = WINDOW) -> None:
        import ahocorasick

        self.symbols: dict[bytes, str] = {}
        owners: dict[str, set[str]] = {}
        for item_id, text in items:
            coded = "".join(self.symbols.setdefault(w, symbol(len(self.symbols))) for w in words(text))
            for start in range(max(1, len(coded) - window + 1)) if coded else ():
                owners.setdefault(coded[start : start + window], set()).add(item_id)
        self.automaton = ahocorasick.Automaton()
        for pattern, ids in owners.items():
            self.automaton.add_word(pattern, (len(pattern), tuple(ids)))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def scan(self, text: str | None) -> tuple[int, int, list[str], list[dict]]:
        """Number of words, of hit words, ids of items with a window in the text, hit stretches as character offsets."""
        if not text:
            return 0, 0, [], []
        found = words(text)
        if self.empty:
            return len(found), 0, [], []
        get = self.symbols.get
        ends, lengths, ids = [], [], set()
        for end, (length, owners) in self.automaton.iter("".join([get(w, "\0") for w in found])):
            ends.append(end)
            lengths.append(length)
            ids.update(owners)
        if not ends:
            return len(found), 0, [], []
        change = np.zeros(len(found) + 1, dtype=np.int64)
        stops = np.array(ends) + 1
        np.add.at(change, stops - np.array(lengths), 1)
        np.add.at(change, stops, -1)
        hit = np.concatenate([[False], np.cumsum(change[:-1]) > 0, [False]])
        edges = np.flatnonzero(hit[1:] != hit[:-1])
        at = [m.span() for m in WORD.finditer(re.sub("[A-Z]+", lambda m: m[0].lower(), text))]
        spans = [{"start": at[a][0], "stop": at[b - 1][1]} for a, b in batched(edges.tolist(), 2)]
        return len(found), int(hit.sum()), sorted(ids), spans


@lru_cache(maxsize=1)
def _scanner(items: tuple[tuple[str, str], ...], window: int) -> Scanner:
    return Scanner(list(items), window)


def _scan(df: DataFrame, items: Items, text: Column, window: int) -> Column:
    shared = df.sparkSession.sparkContext.broadcast(tuple(items))

    @F.pandas_udf(RESULT)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = _scanner(shared.value, window)
        for batch in batches:
            yield pd.DataFrame([scanner.scan(t) for t in batch], columns=["n_words", "n_hit", "items", "spans"])

    return scan(text)


def stretches(benchmark: DataFrame, window: int) -> DataFrame:
    """(item_id, text) of stretches that each hold whole windows; a long item is cut into several, which overlap."""

    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            found = words(text)
            starts = range(0, max(1, len(found) - window + 1), STRETCH_WORDS)
            out.append([b" ".join(found[a : a + STRETCH_WORDS + window - 1]).decode() for a in starts] if found else [])
        return pd.Series(out)

    items = benchmark.filter("text is not null").select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.explode(cut("text")).alias("text"))
    return items.distinct()


def dealt(benchmark: DataFrame, window: int, automaton_bytes: int) -> tuple[DataFrame, int]:
    """Stretches with the automaton that they go to, `group`, and the number of automata."""
    pieces = stretches(benchmark, window).withColumn("bytes", (F.octet_length("text") + 16).cast("long"))
    pieces = durable(pieces.withColumn("place", F.xxhash64("item_id", "text")))
    size, n = pieces.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.count(F.lit(1))).first()
    bucket = F.pmod(F.col("place"), F.lit(max(1, n // BUCKET_ROWS)))
    placed = before(pieces.withColumn("bucket", bucket), [], "bucket", [F.col("place"), F.col("item_id"), F.col("text")], F.col("bytes"), "earlier")
    return placed.select("item_id", "text", F.expr(f"earlier div {automaton_bytes}").alias("group")), max(1, -(-size // automaton_bytes))


def scan_documents(docs: DataFrame, benchmark: DataFrame, name: str = "scan", text: str = "text", window: int = WINDOW, automaton_bytes: int = AUTOMATON_BYTES) -> DataFrame:
    """docs with a struct column `name`: n_words, n_hit, items, spans.

    benchmark(item_id, text). Words are runs of ASCII letters, digits and
    non-ASCII characters after lower-casing A-Z; a window is `window`
    consecutive words of an item, or a shorter item's words; every word in an
    occurrence of a window is hit. spans are the hit stretches as character
    offsets into the original text. Null and empty texts have no words; items
    that are null or without words never occur; every row is scanned by itself,
    so repeated rows get the same answer. Items beyond `automaton_bytes` are
    dealt to several automata, long ones in stretches. Each automaton is a pass
    over the texts that keeps the texts with hits only, by their hash; these
    are merged and joined to the documents once.
    """
    items, groups = dealt(benchmark, window, automaton_bytes)
    if groups == 1:
        return docs.withColumn(name, _scan(docs, [(r.item_id, r.text) for r in items.collect()], F.col(text), window))
    digest = lambda: F.sha2(F.coalesce(text, F.lit("")), 256)
    passes = []
    for g in range(groups):
        own = [(r.item_id, r.text) for r in items.filter(F.col("group") == g).collect()]
        hits = docs.select(F.col(text).alias("text"), F.explode(F.array(_scan(docs, own, F.col(text), window))).alias("hit")).filter("hit.n_hit > 0")
        passes.append(hits.select(F.sha2("text", 256).alias("digest"), "hit", "text").dropDuplicates(["digest"]))
    both = reduce(DataFrame.unionByName, passes).groupBy("digest").agg(F.collect_list("hit").alias("hits"), F.first("text").alias("text"))

    @F.pandas_udf(RESULT)
    def merged(found: pd.Series, texts: pd.Series) -> pd.DataFrame:
        out = []
        for parts, t in zip(found, texts, strict=True):
            spans: list[dict] = []
            for start, stop in sorted((s["start"], s["stop"]) for p in parts for s in p["spans"]):
                if spans and start <= spans[-1]["stop"]:
                    spans[-1]["stop"] = max(stop, spans[-1]["stop"])
                else:
                    spans.append({"start": start, "stop": stop})
            hit = sum(len(words(t[s["start"] : s["stop"]])) for s in spans)
            out.append((parts[0]["n_words"], hit, sorted({i for p in parts for i in p["items"]}), spans))
        return pd.DataFrame(out, columns=["n_words", "n_hit", "items", "spans"])

    @F.pandas_udf("long")
    def counted(texts: pd.Series) -> pd.Series:
        return pd.Series([len(words(t)) if t else 0 for t in texts], dtype="int64")

    key, found = free_name(docs, "scan_key"), free_name(docs, "scan_found")
    scans = both.select(F.col("digest").alias(key), merged("hits", "text").alias(found))
    nothing = F.struct(counted(F.col(text)).alias("n_words"), F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"), F.array().cast("array<struct<start: int, stop: int>>").alias("spans"))
    joined = docs.withColumn(key, digest()).join(durable(scans), key, "left")
    return joined.withColumn(name, F.coalesce(F.col(found), nothing)).drop(key, found)


def is_contaminated(scan: str = "scan") -> Column:
    """At least one hit word, and one in twenty words or more is hit."""
    return (F.col(f"{scan}.n_hit") > 0) & (F.col(f"{scan}.n_hit") * 20 >= F.col(f"{scan}.n_words"))
