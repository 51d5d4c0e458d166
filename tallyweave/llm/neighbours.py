"""Nearest neighbours by largest inner product with shifted Hilbert curves.

Vectors are projected to a few dimensions and ordered along several shifted
Hilbert curves; Spark range-partitions each ordering, and a query is compared
with the windows of keys around it on every curve. The best of these, merged
and reranked on the original vectors, give a floor for each query. Blocks of
the first curve whose ball bound can still beat the floor are then searched as
well, so that nothing is lost where the data has no low-dimensional order (the
windows alone find few neighbours among directions that are spread evenly).

Equal vectors are searched once: of a group of copies only the k + 1 with the
smallest ids can be anyone's neighbours, and only one is used as a query.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable

CURVES, DIMENSIONS, BITS = 3, 6, 9
WINDOW = 256
BLOCK_ROWS = 4096
#: Queries that are searched together against one block.
GROUP_QUERIES = 4096
#: Balls that are held against a group of queries at a time.
BALLS_TOGETHER = 4096
FOUND = "query_id long, vec_id long, score double"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of integer cells (rows x dimensions), after Skilling (2004)."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def curve_keys(vectors: np.ndarray, scale: float, curve: int) -> np.ndarray:
    """Keys of a curve: its own projection, squeezed to the unit cube and shifted."""
    random = np.random.default_rng(1000 + curve)
    direction = random.normal(size=(vectors.shape[1], DIMENSIONS)) / max(scale, 1e-300)
    unit = 0.5 + 0.5 * np.tanh(vectors @ direction)
    shifted = (unit + random.random(DIMENSIONS)) / 2
    return hilbert_keys(np.minimum((shifted * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.float64)


def best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, floor: np.ndarray | None = None) -> pd.DataFrame:
    """The k best vec_ids of each query, each once, scored one way whatever rows stand beside them; ties go to the smaller vec_id."""
    rough = queries @ rows.T
    by_id = np.argsort(ids, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(ids[by_id]) != 0))
    of_ids = np.maximum.reduceat(rough[:, by_id], starts, axis=1) if len(starts) < len(ids) else rough
    least = -np.partition(-of_ids, min(len(starts), k) - 1, axis=1)[:, min(len(starts), k) - 1]
    least -= 1e-9 * np.sqrt((queries * queries).sum(axis=1) * (rows * rows).sum(axis=1).max())
    out = []
    for i, q in enumerate(query_ids):
        top = np.flatnonzero(rough[i] >= least[i])
        scores = (queries[i] * rows[top]).sum(axis=1)
        order = np.lexsort((ids[top], -scores))
        if len(starts) < len(ids):
            order = order[np.sort(np.unique(ids[top[order]], return_index=True)[1])]
        out += [(q, ids[top[j]], scores[j]) for j in order[:k] if floor is None or scores[j] >= floor[i]]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def usable(vectors: DataFrame) -> DataFrame:
    """Rows whose vector has only finite components, not all 0, and the commonest length; equal rows once."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    v = v.filter(F.col("vec_id").isNotNull() & F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0)).distinct()
    length = v.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return v.filter(F.size("embedding") == (length[0]["n"] if length else 0))


def merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query, each row once, as a sorted array."""
    alike = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = alike.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("near"))


def window_candidates(base: DataFrame, scale: float, k: int, curves: int, window: int) -> DataFrame:
    """The k best rows of each query within the windows of keys around it, on every curve."""

    @F.pandas_udf("array<long>")
    def keys(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            v = stacked(batch)
            yield pd.Series(list(np.stack([curve_keys(v, scale, c) for c in range(curves)], axis=1)))

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before, now = None, None
        for rows in rechunked(batches, window):
            if now is not None:
                yield compare(before, now, rows)
                before = now if rows is not None and rows["curve"].iloc[0] == now["curve"].iloc[0] else None
            now = rows
        if now is not None:
            yield compare(before, now, None)

    def compare(before: pd.DataFrame | None, now: pd.DataFrame, after: pd.DataFrame | None) -> pd.DataFrame:
        curve = now["curve"].iloc[0]
        around = pd.concat([x for x in (before, now, after) if x is not None and x["curve"].iloc[0] == curve])
        asked = now[now["search"]]
        if not len(asked):
            return pd.DataFrame(columns=["query_id", "vec_id", "score"])
        return best(asked["vec_id"].to_numpy(), stacked(asked["embedding"]), around["vec_id"].to_numpy(), stacked(around["embedding"]), k)

    keyed = base.select("vec_id", "embedding", "search", F.posexplode(keys("embedding")).alias("curve", "key"))
    n = max(1, curves * base.count() // (8 * BLOCK_ROWS) + 1)
    ordered = keyed.repartitionByRange(n, "curve", "key", "vec_id").sortWithinPartitions("curve", "key", "vec_id")
    return ordered.mapInPandas(near, FOUND)


def rechunked(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Rows in pieces of `size` that hold one curve each."""
    kept: pd.DataFrame | None = None
    for batch in batches:
        kept = batch if kept is None else pd.concat([kept, batch])
        while len(kept):
            own = int((kept["curve"] == kept["curve"].iloc[0]).sum())
            if own < size and own == len(kept):
                break
            yield kept.iloc[: min(own, size)]
            kept = kept.iloc[min(own, size) :]
    if kept is not None and len(kept):
        yield kept


def in_blocks(base: DataFrame, scale: float, n_rows: int) -> DataFrame:
    """base with `block`, a stretch of the first curve, and `key`."""

    @F.pandas_udf("long")
    def key(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(curve_keys(stacked(batch), scale, 0))

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield batch.assign(block=(part << 32) + (seen + np.arange(len(batch))) // BLOCK_ROWS)
            seen += len(batch)

    keyed = base.withColumn("key", key("embedding"))
    ordered = keyed.repartitionByRange(max(1, -(-n_rows // BLOCK_ROWS)), "key", "vec_id").sortWithinPartitions("key", "vec_id")
    return durable(ordered.mapInPandas(number, "vec_id long, embedding array<double>, search boolean, key long, block long"))


def block_candidates(placed: DataFrame, floors: DataFrame, n_queries: int, k: int) -> DataFrame:
    """The k best rows of each query from every block that its floor does not rule out."""
    def ball(rows: pd.DataFrame) -> pd.DataFrame:
        v = stacked(rows["embedding"])
        centre = v.mean(axis=0)
        return pd.DataFrame([(rows["block"].iloc[0], centre, np.sqrt(((v - centre) ** 2).sum(axis=1).max()))])

    balls = durable(placed.groupBy("block").applyInPandas(ball, "block long, centre array<double>, radius double"))
    pieces = max(1, -(-balls.count() // BALLS_TOGETHER))
    balls = balls.withColumn("piece", F.pmod(F.xxhash64("block"), F.lit(pieces)))
    asked = placed.filter("search").join(floors, placed.vec_id == floors.query_id, "left").select("vec_id", "embedding", "floor")
    groups = max(1, -(-n_queries // GROUP_QUERIES))
    asked = durable(asked.withColumn("ask", F.pmod(F.xxhash64("vec_id"), F.lit(groups))))

    def blocks_for(questions: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(questions) or not len(own):
            return pd.DataFrame(columns=["vec_id", "block"])
        q, names = stacked(questions["embedding"]), own["block"].to_numpy()
        bound = q @ stacked(own["centre"]).T + np.sqrt((q * q).sum(axis=1))[:, None] * own["radius"].to_numpy()
        floor = questions["floor"].fillna(-np.inf).to_numpy()[:, None]
        row, block = np.nonzero(bound + 1e-9 * np.abs(bound) + 1e-9 >= floor)
        return pd.DataFrame({"vec_id": questions["vec_id"].to_numpy()[row], "block": names[block]})

    everywhere = asked.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)).cast("array<long>")))
    to_ask = balls.withColumn("ask", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")))
    wanted = everywhere.groupBy("ask", "piece").cogroup(to_ask.groupBy("ask", "piece")).applyInPandas(blocks_for, "vec_id long, block long")
    asked = durable(asked.join(wanted, "vec_id"))
    pairs = asked.select("ask", "block").distinct()
    rows = placed.select("block", F.col("vec_id").alias("row_id"), F.col("embedding").alias("row")).join(pairs, "block").toDF("at_block", "row_id", "row", "at_ask")

    def search(questions: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if not len(questions) or not len(answers):
            return pd.DataFrame(columns=["query_id", "vec_id", "score"])
        ids, v = answers["row_id"].to_numpy(), stacked(answers["row"])
        floor = questions["floor"].fillna(-np.inf).to_numpy()
        q_ids, q = questions["vec_id"].to_numpy(), stacked(questions["embedding"])
        return pd.concat([best(q_ids[i : i + 256], q[i : i + 256], ids, v, k, floor[i : i + 256]) for i in range(0, len(q), 256)])

    return asked.groupBy("ask", "block").cogroup(rows.groupBy("at_ask", "at_block")).applyInPandas(search, FOUND)


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, curves: int = CURVES, window: int = WINDOW, complete: bool = True) -> DataFrame:
    """query_id, rank, vec_id and score: the k rows with the largest inner product.

    vectors(vec_id, embedding); queries are the rows whose vec_id is divisible
    by `every`, candidates all rows but those with the query's vec_id. Ties go
    to the smaller vec_id; fewer candidates than k give fewer rows. Rows that
    repeat a vec_id and its vector count once. Rows with a
    null id, vectors that are null, all zero, hold a null or non-finite
    component or have not the commonest length take no part. An empty table
    gives no rows. complete=False leaves it at the curves' windows.
    """
    v = usable(vectors)
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    kept = v.withColumn("nth", F.row_number().over(copies)).filter(F.col("nth") <= k + 1)
    queries = v.filter(F.col("vec_id") % every == 0)
    wanted = queries.groupBy("embedding").agg(F.lit(True).alias("asked"))
    base = durable(kept.join(wanted, "embedding", "left").select("vec_id", "embedding", ((F.col("nth") == 1) & F.col("asked").isNotNull()).alias("search"), "nth"))
    square = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n_rows, n_queries, mean_square = base.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("search").cast("int")), F.lit(0)), F.avg(square)).first()
    scale = 1.5 * float(mean_square or 1.0) ** 0.5
    n_dims = base.select(F.size("embedding").alias("n")).limit(1).collect()
    scale /= max(1, n_dims[0].n if n_dims else 1) ** 0.5
    rows = base.select("vec_id", "embedding", "search")
    found = [window_candidates(rows, scale, k + 1, curves, window)]
    if complete:
        first = durable(merged(found[0], k + 1))
        floors = first.filter(F.size("near") > k).select("query_id", F.element_at("near", -1)["score"].alias("floor"))
        found = [first.select("query_id", F.inline("near")).select("query_id", "vec_id", "score")]
        found.append(block_candidates(in_blocks(rows, scale, n_rows), floors, n_queries, k + 1))
    near = merged(reduce(DataFrame.unionByName, found), k + 1)
    speakers = base.filter("search").select("embedding", F.col("vec_id").alias("speaker"))
    answers = queries.join(speakers, "embedding").select(F.col("vec_id").alias("asker"), "speaker").join(near, F.col("speaker") == near.query_id)
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("asker")), 1, k)
    each = answers.select(F.col("asker").alias("query_id"), F.posexplode(others).alias("pos", "x"))
    return each.select("query_id", (F.col("pos") + 1).alias("rank"), "x.vec_id", "x.score")
