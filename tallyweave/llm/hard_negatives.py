"""Hard negatives of anchors, filtered by rotated one-bit codes.

A vector is kept as one bit a dimension after a rotation, with its alignment:
the inner product of vector and code. What the code leaves over is coded again
under the next rotation. An anchor's inner product with a code comes from
population counts over the bit planes of the rotated, rounded anchor; what
rounding and the last remainder can add is bounded by Cauchy-Schwarz, so each
estimate is an interval that surely holds the score. Rows whose interval can't
reach a result are dropped from one code to the next; those that survive are
scored on the integers.

Anchors (a stated set) meet all rows in blocks: groups of anchors and blocks
of rows are dealt by hash, so neither a label nor a common vector is one task.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, finite_vectors

SCALE = 256
#: Scaled components are held to this, so that integers stay exact as doubles.
LARGEST = float(1 << 52)
POSITIVES, NEGATIVES = 5, 5
#: Negatives score at least this share of the positive, in hundredths.
LEAST_HUNDREDTHS = 80
#: Rotated codes of a vector, and bits to which an anchor's rotated components are rounded.
CODES, PLANES = 4, 6
#: Components in the largest and the smallest block, and anchors in the largest group.
LARGEST_BLOCK, SMALLEST_BLOCK, GROUP_ANCHORS = 1 << 22, 1 << 17, 4096
#: Share of the product of norms that rounding of the estimates stays under.
SLACK = 1e-9


@lru_cache(maxsize=16)
def rotation(width: int, code: int) -> np.ndarray:
    return np.linalg.qr(np.random.default_rng(100 + code).normal(size=(width, width)))[0]


def widened(x: np.ndarray) -> np.ndarray:
    """x as doubles, with zero columns up to a multiple of 64."""
    return np.pad(x.astype(np.float64), ((0, 0), (0, -x.shape[1] % 64)))


def encode(x: np.ndarray, codes: int = CODES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows x codes x words), alignments (rows x codes) and norms of what is left (rows x codes + 1)."""
    left = widened(x)
    width = left.shape[1]
    words, align, rest = [], [], [np.linalg.norm(left, axis=1)]
    for k in range(codes):
        turn = rotation(width, k)
        turned = left @ turn.T
        bits = turned >= 0
        words.append(np.packbits(bits, axis=1, bitorder="little").view(np.uint64))
        align.append(np.abs(turned).sum(axis=1) / np.sqrt(width))
        left = left - align[-1][:, None] * (np.where(bits, 1.0, -1.0) @ turn / np.sqrt(width))
        rest.append(np.linalg.norm(left, axis=1))
    return np.stack(words, axis=1), np.stack(align, axis=1), np.stack(rest, axis=1)


class Asked:
    """An anchor's rotated components, rounded to bit planes."""

    def __init__(self, x: np.ndarray, codes: int = CODES) -> None:
        wide = widened(x[None])[0]
        self.width, self.norm, self.parts = len(wide), float(np.linalg.norm(wide)), []
        for k in range(codes):
            turned = rotation(self.width, k) @ wide
            low = turned.min()
            step = (turned.max() - low) / ((1 << PLANES) - 1) or 1.0
            steps = np.rint((turned - low) / step).astype(np.uint8)
            rounded = low + step * steps
            planes = [np.packbits((steps >> b) & 1, bitorder="little").view(np.uint64) for b in range(PLANES)]
            self.parts.append((low, step, rounded.sum(), float(np.linalg.norm(turned - rounded)), planes))

    def product(self, words: np.ndarray, code: int) -> np.ndarray:
        """Inner products of the rounded anchor with unit codes, by population counts."""
        low, step, total, _, planes = self.parts[code]
        inside = low * np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        for b, plane in enumerate(planes):
            inside = inside + step * (1 << b) * np.bitwise_count(words & plane).sum(axis=1, dtype=np.int64)
        return (2 * inside - total) / np.sqrt(self.width)


class Block:
    """Rows of one block, by falling smallness of vec_id, with their codes."""

    def __init__(self, rows: pd.DataFrame) -> None:
        rows = rows.sort_values("vec_id", kind="stable")
        self.ids, self.labels = rows["vec_id"].to_numpy(), rows["label"].to_numpy()
        self.x = np.stack(rows["x"].to_list())
        n, codes = len(rows), len(rows["align"].iloc[0])
        self.words = np.ascontiguousarray(np.stack(rows["words"].to_list()).astype(np.int64).view(np.uint64).reshape(n, codes, -1).transpose(1, 0, 2))
        self.align, self.rest = np.stack(rows["align"].to_list(), axis=1), np.stack(rows["rest"].to_list(), axis=1)
        self.largest = int(np.abs(self.x).max())
        self.doubles = self.x.astype(np.float64)

    def scores(self, which: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Exact inner products of the rows `which` with x; those beyond a long are held to its ends."""
        bound = self.largest * int(np.abs(x).max()) * len(x)
        if bound < 1 << 53:
            return np.rint(self.doubles[which] @ x.astype(np.float64)).astype(np.int64)
        if bound < 1 << 63:
            return self.x[which] @ x
        exact = [sum(a * b for a, b in zip(row, x.tolist(), strict=True)) for row in self.x[which].tolist()]
        return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in exact], dtype=np.int64)

    def narrowed(self, which: np.ndarray, asked: Asked, keep) -> np.ndarray:
        """Those of the rows `which` that keep(low, high), called with the intervals of each code, lets through."""
        middle, wide = np.zeros(len(which)), np.zeros(len(which))
        for code in range(len(self.align)):
            if not len(which):
                break
            align = self.align[code, which]
            middle = middle + align * asked.product(self.words[code, which], code)
            wide = wide + align * asked.parts[code][3]
            half = wide + asked.norm * (self.rest[code + 1, which] + SLACK * self.rest[0, which])
            good = keep(middle - half, middle + half)
            which, middle, wide = which[good], middle[good], wide[good]
        return which


def kth_largest(values: np.ndarray, k: int) -> float:
    """-inf if there are fewer than k."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def positives_in(block: Block, vec_id: int, label: int, x: np.ndarray, most: int) -> list[tuple[int, int]]:
    """(vec_id, score) of the best rows of the anchor's label with another id."""
    which = np.flatnonzero((block.labels == label) & (block.ids != vec_id))
    which = block.narrowed(which, Asked(x), lambda low, high: high >= kth_largest(low, most))
    scores = block.scores(which, x)
    order = np.lexsort((block.ids[which], -scores))[:most]
    return [(block.ids[which[i]], scores[i]) for i in order]


def negatives_in(block: Block, label: int, x: np.ndarray, positives: list[tuple[int, int]], most: int, least: int) -> list[tuple[int, int, int, int]]:
    """(positive_id, positive_score, vec_id, score) of each positive's best rows of other labels that score near it."""
    wanted = [(p, score, -(-least * score // 100)) for p, score in positives if score >= 0]
    if not wanted:
        return []

    def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        good = np.zeros(len(low), dtype=bool)
        for _, top, floor in wanted:
            sure = low[(low >= floor) & (high <= top)]
            good |= (high >= max(floor, kth_largest(sure, most))) & (low <= top)
        return good

    which = block.narrowed(np.flatnonzero(block.labels != label), Asked(x), keep)
    scores = block.scores(which, x)
    order = np.lexsort((block.ids[which], -scores))
    scores, ids = scores[order], block.ids[which[order]]
    out = []
    for p, top, floor in wanted:
        start = int(np.searchsorted(-scores, -top))
        out += [(p, top, ids[i], scores[i]) for i in range(start, min(start + most, len(ids))) if scores[i] >= floor]
    return out


def mine(vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, least_hundredths: int = LEAST_HUNDREDTHS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    vectors(vec_id, embedding, label). Anchors are the rows whose vec_id is
    divisible by `every`, its positives the best rows of its label with another
    id, a positive's negatives the best rows of other labels that score
    no more than it and at least `least_hundredths` of it. Scores are inner products of
    components floor(256 * c); the higher comes first, ties go to the smaller
    vec_id. Rows alike in vec_id, label and vector count once; rows of one id
    that differ are rows (and anchors) of their own. Rows with a null id, label or vector, with null or
    non-finite components or without the commonest length take no part; an
    empty table gives no rows. Negative positives have no negatives.
    """
    spark = vectors.sparkSession
    whole = lambda c: F.floor(F.least(F.greatest(c * SCALE, F.lit(-LARGEST)), F.lit(LARGEST)))
    usable = finite_vectors(vectors.filter("vec_id is not null and label is not null"), "vec_id", "label")
    rows = usable.select("vec_id", F.col("label").cast("long").alias("label"), F.transform("embedding", whole).alias("x")).distinct()

    @F.pandas_udf("struct<words: array<long>, align: array<double>, rest: array<double>>")
    def coded(x: pd.Series) -> pd.DataFrame:
        if not len(x):
            return pd.DataFrame({"words": [], "align": [], "rest": []})
        words, align, rest = encode(np.stack(x.to_list()))
        return pd.DataFrame({"words": list(words.view(np.int64).reshape(len(x), -1)), "align": list(align), "rest": list(rest)})

    base = durable(rows.withColumn("c", coded("x")).select("vec_id", "label", "x", "c.*", F.monotonically_increasing_id().alias("row")))
    anchors = base.filter(F.col("vec_id") % every == 0).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.col("label").alias("own"), F.col("x").alias("asked"))
    n, width = base.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("x")), F.lit(1))).first()
    n_groups = max(1, -(-anchors.count() // GROUP_ANCHORS))
    n_blocks = max(1, -(-n * width // LARGEST_BLOCK), min(-(-n * width // SMALLEST_BLOCK), 2 * spark.sparkContext.defaultParallelism))
    deal = lambda c, parts: F.pmod(F.xxhash64(c), F.lit(parts)).cast("int")
    every_one = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    placed = base.withColumn("block", deal("row", n_blocks)).withColumn("ask", every_one(n_groups))

    def compared(asked: DataFrame, find, schema: str) -> DataFrame:
        """find(block, anchor) for each anchor and block."""
        columns = [c.split()[0] for c in schema.split(", ")]

        def compare(some: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            block = Block(rows) if len(some) and len(rows) else None
            return pd.DataFrame([r for a in some.itertuples(index=False) for r in find(block, a)] if block else [], columns=columns)

        sent = asked.withColumn("ask", deal("anchor", n_groups)).withColumn("block", every_one(n_blocks))
        return sent.groupBy("ask", "block").cogroup(placed.groupBy("ask", "block")).applyInPandas(compare, schema)

    best = lambda *keys: Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id")
    near = compared(
        anchors,
        lambda block, a: [(a.anchor, i, s) for i, s in positives_in(block, a.anchor_id, a.own, a.asked, positives)],
        "anchor long, vec_id long, score long",
    )
    near = near.withColumn("nth", F.row_number().over(best("anchor"))).filter(F.col("nth") <= positives)
    paired = near.groupBy("anchor").agg(F.collect_list("nth").alias("nths"), F.collect_list("vec_id").alias("ids"), F.collect_list("score").alias("scores"))
    asked = durable(anchors.join(paired, "anchor"))
    found = compared(
        asked,
        lambda block, a: [
            (a.anchor, a.anchor_id, nth, a.ids[list(a.nths).index(nth)], top, i, s)
            for nth, top, i, s in negatives_in(block, a.own, a.asked, [(int(k), int(s)) for k, s in zip(a.nths, a.scores, strict=True)], negatives, least_hundredths)
        ],
        "anchor long, anchor_id long, nth int, positive_id long, positive_score long, vec_id long, score long",
    )
    ranked = found.withColumn("rank", F.row_number().over(best("anchor", "nth"))).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
