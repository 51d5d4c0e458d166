"""Self-join of documents on the Jaccard similarity of their word shingles.

Equal texts are folded into one, whose key is a hash of the text, so that rows
which share a doc_id but not a text are apart. MinHash bands give candidate buckets; buckets
with the same members are searched once, and a pair only in the first band that
it shares, so that no pair is written out before it is known to be a link and
none is looked at twice. In a bucket MinHash values are compared a few at a
time, and a pair is dropped once the posterior probability that it reaches the
threshold falls below a tolerance (Bayesian pruning with a uniform prior). What
is left is verified on the exact shingle sets. A bucket of many members is cut
into blocks, and each pair of blocks is a group of its own, of bounded size.
Links leave a group as counts and a spanning forest, not as all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, free_name
from .texthash import shingle_sets

THRESHOLD, WORDS = 0.8, 5
HASHES, BAND = 96, 4
BANDS = HASHES // BAND
#: MinHash values compared between two prunings, and the tolerance of a pruning.
STEP, TOLERANCE = 16, 1e-6
BLOCK = 512
#: Shingles that the members of a block have on average at most (8 bytes each); a pair of blocks is verified together.
BLOCK_SHINGLES = 1 << 21
#: Pairs compared at a time.
PAIRS_TOGETHER = 1 << 16
#: Texts whose shingles are made together, and characters (more only if one text has more).
TOGETHER, CHARS_TOGETHER = 1000, 1 << 22
FACTORS = np.random.default_rng(20).integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minhash(shingles: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        values = (FACTORS[:, None] * shingles[None, at : at + 4096]) >> np.uint64(32)
        least = np.minimum(least, values.min(axis=1))
    return least.astype(np.uint32)


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One key for each band: rows x BANDS."""
    x = signatures.reshape(len(signatures), BANDS, BAND).astype(np.uint64)
    key = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(BAND):
        key = (key ^ x[:, :, k]) * np.uint64(0xC2B2AE3D27D4EB4F)
        key ^= key >> np.uint64(29)
    return key.astype(np.int64)


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For n = 0..HASHES compared values: the fewest matches with P(J >= threshold | matches, n) >= tolerance.

    With a uniform prior J has a Beta(m + 1, n - m + 1) posterior, whose upper
    tail is the chance of at most m successes in n + 1 trials.
    """
    out = []
    for n in range(HASHES + 1):
        tail, m = 0.0, -1
        while tail < tolerance and m < n:
            m += 1
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def likely_pairs(signatures: np.ndarray, band: int, sides: np.ndarray, inside: bool, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a bucket's members that first meet in this band and survive the prunings.

    inside: all pairs of members, else those of a member of side 0 and one of side 1.
    """
    if inside:
        p, q = np.triu_indices(len(signatures), 1)
    else:
        p, q = (x.ravel() for x in np.meshgrid(np.flatnonzero(sides == 0), np.flatnonzero(sides == 1), indexing="ij"))
    parts = [survivors(signatures, p[at : at + PAIRS_TOGETHER], q[at : at + PAIRS_TOGETHER], band, threshold, tolerance) for at in range(0, len(p), PAIRS_TOGETHER)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (p, q)


def survivors(signatures: np.ndarray, p: np.ndarray, q: np.ndarray, band: int, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that are not pruned; STEP values more are compared in each round."""
    fewest = least_matches(threshold, tolerance)
    matches = np.zeros(len(p), dtype=np.int64)
    met_before = np.zeros(len(p), dtype=bool)
    for at in range(0, HASHES, STEP):
        same = signatures[p, at : at + STEP] == signatures[q, at : at + STEP]
        met = same.reshape(len(p), STEP // BAND, BAND).all(axis=2)
        met_before |= met[:, : max(0, band - at // BAND)].any(axis=1)
        matches += same.sum(axis=1)
        left = (matches >= fewest[at + STEP]) & ~met_before
        p, q, matches, met_before = p[left], q[left], matches[left], met_before[left]
    return p, q


def by_group(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups of a stream of rows that is sorted by `keys`."""
    rest: pd.DataFrame | None = None
    for batch in batches:
        rest = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        new = np.zeros(len(rest), dtype=bool)
        for k in keys:
            values = rest[k].to_numpy()
            new[1:] |= values[1:] != values[:-1]
        cuts = np.flatnonzero(new)
        for a, b in zip([0, *cuts[:-1]], cuts, strict=False):
            yield rest.iloc[a:b]
        rest = rest.iloc[cuts[-1] :] if len(cuts) else rest
    if rest is not None and len(rest):
        yield rest


def text_key(text: str = "text") -> Column:
    """Key of a text: 64 bits of hash; null texts have none."""
    return F.when(F.col(text).isNotNull(), F.xxhash64(text))


def stretches(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """A batch's rows in pieces of bounded rows and characters."""
    start, n = 0, 0
    for i, length in enumerate(batch["text"].str.len()):
        if i > start and (i - start >= TOGETHER or n + length > CHARS_TOGETHER):
            yield batch.iloc[start:i]
            start, n = i, 0
        n += length
    if start < len(batch):
        yield batch.iloc[start:]


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, id (key of the text), number of shingles, signature and band keys of every text that is not null."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for some in stretches(batch):
                sets = shingle_sets(some["text"].to_list(), words)
                signatures = np.stack([minhash(s) for s in sets])
                yield pd.DataFrame({"doc_id": some["doc_id"], "id": some["id"], "size": [len(s) for s in sets], "signature": [s.tobytes() for s in signatures], "keys": list(band_keys(signatures))}).astype({"doc_id": "Int64"})

    rows = docs.filter("text is not null").select("doc_id", text_key().alias("id"), "text")
    return rows.mapInPandas(sketch, "doc_id long, id long, size long, signature binary, keys array<long>")


def block_pairs(members: DataFrame) -> DataFrame:
    """Rows of (key, n, total, id, ...) once for each pair of blocks that their block is part of.

    A bucket has as many blocks as its members, or all their shingles, ask for.
    """
    n_blocks = F.least("n", F.ceil(F.greatest(F.col("n") / BLOCK, F.col("total") / BLOCK_SHINGLES))).cast("int")
    placed = members.withColumn("blocks", n_blocks).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return placed.withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other")).withColumn("side", F.when(F.col("own") == F.col("a"), 0).otherwise(1)).drop("blocks", "own", "other", "total")


GROUP = ["key", "a", "b"]


def find_links(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, tolerance: float = TOLERANCE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts, links as spanning edges, and how many links each text has.

    texts(id, first, copies): distinct texts, their smallest doc_id (null if
    all are) and their rows; edges(one, two): links that connect what all links
    connect; counts(id, links, linked_docs): other texts linked, and rows with
    these.
    """
    known = durable(sketches(docs, words))
    texts = durable(known.groupBy("id").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies")))
    firsts = texts.select("id", F.col("first").alias("doc_id"))
    chosen = known.join(firsts, (known.id == firsts.id) & known.doc_id.eqNullSafe(firsts.doc_id), "left_semi").dropDuplicates(["id"])
    entries = chosen.select("id", "size", F.posexplode("keys").alias("band", "key"))
    buckets = entries.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("total"), F.min("band").alias("band"), F.min("id").alias("first"), F.bit_xor(F.xxhash64("id")).alias("mark"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("mark2")).filter("n > 1")
    buckets = buckets.groupBy("n", "total", "first", "mark", "mark2").agg(F.min(F.struct("band", "key")).alias("b")).select("b.key", "b.band", "n", "total")
    members = entries.select("id", "key").join(buckets, "key")
    grouped = block_pairs(members).join(chosen.select("id", "signature"), "id")
    grouped = grouped.repartition(*GROUP).sortWithinPartitions(*GROUP, "id")

    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in by_group(batches, GROUP):
            signatures = np.stack([np.frombuffer(s, dtype=np.uint32) for s in rows["signature"]])
            a, b = rows["a"].iloc[0], rows["b"].iloc[0]
            p, q = likely_pairs(signatures, int(rows["band"].iloc[0]), rows["side"].to_numpy(), a == b, threshold, tolerance)
            if len(p):
                yield rows.iloc[np.unique(np.concatenate([p, q]))][[*GROUP, "band", "side", "id"]]

    taking_part = durable(grouped.mapInPandas(prune, "key long, a int, b int, band int, side int, id long"))
    wanted = taking_part.select("id").distinct().join(texts, "id").select("id", F.col("first").alias("doc_id"), "copies")

    def shingle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for some in stretches(batch):
                yield pd.DataFrame({"id": some["id"], "copies": some["copies"], "shingles": [s.tobytes() for s in shingle_sets(some["text"].to_list(), words)]})

    own_texts = docs.filter("text is not null").select(F.col("doc_id").alias("own"), text_key().alias("key"), "text")
    own_texts = own_texts.join(wanted.hint("shuffle_hash"), (F.col("key") == F.col("id")) & F.col("own").eqNullSafe(F.col("doc_id"))).dropDuplicates(["id"])
    sets = own_texts.select("id", "copies", "text").mapInPandas(shingle, "id long, copies long, shingles binary")
    regrouped = taking_part.join(sets, "id").repartition(*GROUP).sortWithinPartitions(*GROUP, "id")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in by_group(batches, GROUP):
            found = [np.frombuffer(s, dtype=np.uint64) for s in rows["shingles"]]
            signatures = np.stack([minhash(s) for s in found])
            p, q = likely_pairs(signatures, int(rows["band"].iloc[0]), rows["side"].to_numpy(), rows["a"].iloc[0] == rows["b"].iloc[0], threshold, tolerance)
            is_link = np.array([jaccard(found[i], found[j]) >= threshold for i, j in zip(p, q, strict=True)], dtype=bool)
            p, q = p[is_link], q[is_link]
            if not len(p):
                continue
            ids, copies = rows["id"].to_numpy(), rows["copies"].to_numpy()
            n_links = np.bincount(np.concatenate([p, q]), minlength=len(rows))
            n_docs = np.bincount(np.concatenate([p, q]), weights=copies[np.concatenate([q, p])], minlength=len(rows)).astype(np.int64)
            root = list(range(len(rows)))

            def top(i: int, root: list[int] = root) -> int:
                while root[i] != i:
                    root[i] = root[root[i]]
                    i = root[i]
                return i

            for i, j in zip(p.tolist(), q.tolist(), strict=True):
                one, two = top(i), top(j)
                if one != two:
                    root[max(one, two)] = min(one, two)
            yield pd.DataFrame([(ids[i], ids[top(i)], int(n_links[i]), int(n_docs[i])) for i in range(len(rows)) if n_links[i]], columns=["id", "to", "links", "linked_docs"])

    verified = durable(regrouped.mapInPandas(verify, "id long, to long, links long, linked_docs long"))
    edges = verified.filter("id != to").select(F.col("id").alias("one"), F.col("to").alias("two")).distinct()
    counts = verified.groupBy("id").agg(F.sum("links").alias("links"), F.sum("linked_docs").alias("linked_docs"))
    return texts, edges, counts


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays of distinct hashes; of two empty ones 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) / max(len(a), len(b)) < 0.5:
        common = np.isin(a, b, assume_unique=True).sum()
    else:
        both = np.concatenate([a, b])
        both.sort(kind="stable")
        common = int((both[1:] == both[:-1]).sum())
    return float(common / (len(a) + len(b) - common))


def components(edges: DataFrame) -> DataFrame:
    """id and the smallest id that it is connected with.

    Labels take the least of their neighbours' and then jump to their label's
    label, so that the rounds grow with the logarithm of the longest path.
    """
    both = durable(edges.select("one", "two").unionByName(edges.select(F.col("two").alias("one"), F.col("one").alias("two"))))
    labels = both.groupBy(F.col("one").alias("id")).agg(F.least(F.min("two"), F.min("one")).alias("label"))
    labels = durable(labels)
    while True:
        near = both.join(labels, both.two == labels.id).groupBy("one").agg(F.min("label").alias("near"))
        lowered = labels.join(near, labels.id == near.one).select("id", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        lowered = durable(lowered)
        goal = lowered.select(F.col("id").alias("label"), F.col("label").alias("further"))
        jumped = durable(lowered.join(goal, "label").select("id", F.least("label", "further").alias("label"), "was"))
        if not jumped.filter("label != was").limit(1).count():
            return jumped.select("id", "label")
        labels = jumped.select("id", "label")


def classes_of(docs: DataFrame, threshold: float, words: int, tolerance: float) -> DataFrame:
    """id, first, copies, class_id, winner and n_links of each distinct text (see `near_duplicates`).

    winner: the key of the class's text that has the class's smallest doc_id
    (of several such texts the one with the smallest key).
    """
    texts, edges, counts = find_links(docs, threshold, words, tolerance)
    labelled = texts.join(components(edges), "id", "left").withColumn("label", F.coalesce("label", "id")).join(counts, "id", "left")
    heads = labelled.groupBy("label").agg(F.min(F.struct(F.col("first").isNull().alias("none"), "first", "id")).alias("head"))
    joined = labelled.join(heads, "label").select("id", "first", "copies", F.col("head.first").alias("class_id"), F.col("head.id").alias("winner"), (F.col("copies") - 1 + F.coalesce("linked_docs", F.lit(0))).alias("n_links"))
    return durable(joined)


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, tolerance: float = TOLERANCE) -> DataFrame:
    """One row for each row of docs(doc_id, text): doc_id, class_id, copy_id, n_links.

    class_id: the smallest doc_id of the documents that links (Jaccard
    similarity of word shingles >= threshold) and equal texts connect with it;
    copy_id: the smallest doc_id with an equal text; n_links: other rows that
    have an equal text or are linked. Texts of fewer words than a shingle are
    one shingle; all texts without a word are linked with each other. A null
    text is linked with nothing and is its own class. A null doc_id is larger
    than any; a class whose ids are all null has a null class_id. Repeated rows
    are rows of their own with an equal text; rows that share a doc_id but not a
    text are documents of their own. An empty table gives no rows.
    """
    classes = classes_of(docs, threshold, words, tolerance).select("id", "class_id", F.col("first").alias("copy_id"), "n_links")
    rows = docs.select("doc_id", text_key().alias("id"))
    alone = rows.filter("id is null").select("doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"), F.lit(0).cast("long").alias("n_links"))
    return rows.join(classes, "id").select("doc_id", "class_id", "copy_id", "n_links").unionByName(alone)


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Rows of docs of which one stays of each class of `near_duplicates`.

    That is the row with the class's smallest doc_id (with the smaller key of
    the text, then the smallest in its other columns, where several have it).
    Rows with a null text all stay. Columns of any name may follow.
    """
    key, own = free_name(docs, "key"), free_name(docs, "own")
    classes = classes_of(docs, threshold, words, tolerance)
    keyed = docs.withColumn(key, text_key())
    rows = docs.select("doc_id", text_key().alias("id")).filter("id is not null").groupBy("id", "doc_id").count()
    told = rows.join(classes.select("id", "first", "winner"), "id")
    wins = (F.col("id") == F.col("winner")) & F.col("doc_id").eqNullSafe(F.col("first"))
    lost = told.filter(~wins).select(F.col("id").alias(key), F.col("doc_id").alias(own)).hint("shuffle_hash")
    kept = keyed.join(lost, (keyed[key] == lost[key]) & keyed["doc_id"].eqNullSafe(lost[own]), "left_anti")
    repeated = durable(told.filter(wins & (F.col("count") > 1)).select(F.col("id").alias(key)))
    if not repeated.limit(1).count():
        return kept.drop(key)
    # columns that have no order are compared as JSON
    ordered = [F.to_json(c) if "map<" in kind or "variant" in kind else F.col(c) for c, kind in docs.dtypes]
    once = kept.join(repeated, key, "left_semi").groupBy(key).agg(F.min_by(F.struct(*(F.col(c) for c in docs.columns)), F.struct(*ordered)).alias(own)).select(f"{own}.*")
    return kept.join(repeated, key, "left_anti").drop(key).unionByName(once)
