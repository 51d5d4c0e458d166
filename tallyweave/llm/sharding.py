"""Shards of near-equal size that keep linked documents together.

Balanced label propagation on DataFrames alone: every document starts in a
shard given by its key, then rounds of joins move the documents of a link to
the shard that holds most of it, as far as that shard's quota of bytes allows.
Further rounds even the shards out: unlinked documents move first, then whole
links, and single documents of links only where these do not suffice. A
document that is larger than a shard's share has a shard for itself; the others
are evened out over the rest. Quotas are dealt by
running sums in two levels, so that no task needs a whole shard or link. Only
one number a shard ever reaches the driver.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import before, durable

SHARDS = 40
ROW_BYTES = 16
#: A link of more than this share of a shard's mean size is dealt in pieces.
LARGEST_PIECE = 0.5
#: Propagation may fill a shard with linked documents up to this share of the mean; balancing then moves others out.
FILL = 1.25
#: Rounds end when one lessens what they are to lessen by a smaller share than this; balancing allows so many of them in a row.
LEAST_GAIN, IDLE_ROUNDS = 0.05, 3
#: Balancing ends when no shard is further from the mean than this share of it.
TOLERANCE = 0.001
BUCKET_ROWS = 4096


def by_shard(numbers: list[float]) -> Column:
    """The number of the row's shard."""
    return F.element_at(F.array(*(F.lit(float(x)) for x in numbers)), F.col("shard") + 1)


def loads(placed: DataFrame, n_shards: int, size: str = "size") -> list[int]:
    found = {r.shard: r.bytes for r in placed.groupBy("shard").agg(F.sum(size).alias("bytes")).collect()}
    return [found.get(s, 0) for s in range(n_shards)]


def propagate(tally: DataFrame, free: list[float], buckets: int) -> DataFrame:
    """One round: the links whose missing members fit move to their largest shard.

    tally(link, origin, shard, held): bytes of a link by the shard that they
    started in and the one they are in. No row of a document is moved in a round.
    """
    here = tally.groupBy("link", "shard").agg(F.sum("held").alias("held"))
    total = here.groupBy("link").agg(F.sum("held").alias("total"))
    fitting = here.join(total, "link").withColumn("missing", F.col("total") - F.col("held")).filter(F.col("missing") <= by_shard(free))
    best = fitting.groupBy("link").agg(F.max(F.struct("held", F.xxhash64("link", "shard").alias("tie"), "shard", "missing")).alias("best"))
    wanted = best.select("link", "best.shard", "best.missing").withColumn("bucket", F.pmod(F.xxhash64("link"), F.lit(buckets))).filter("missing > 0")
    dealt = before(wanted, ["shard"], "bucket", [F.col("link")], F.col("missing"), "earlier")
    moved = dealt.filter(F.col("earlier") + F.col("missing") <= by_shard(free)).select("link", F.col("shard").alias("to"))
    return tally.join(moved, "link", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to")


def parted(tally: DataFrame) -> int:
    """Bytes of links that are not in the shard which holds most of their link."""
    here = tally.groupBy("link", "shard").agg(F.sum("held").alias("held")).groupBy("link").agg((F.sum("held") - F.max("held")).alias("away"))
    return here.agg(F.coalesce(F.sum("away"), F.lit(0))).first()[0]


def cut_edges(docs: DataFrame, placed: DataFrame) -> DataFrame:
    """One row: pairs of rows with an equal text (edges), and how many of them lie in two shards (cut).

    placed: what `place_documents` gave for docs. Pairs are counted, not made.
    """
    texts = docs.filter("text is not null").select("doc_id", F.octet_length("text").alias("n"), F.crc32("text").alias("text_crc32"), F.md5("text").alias("link")).groupBy("doc_id", "n", "text_crc32").agg(F.min("link").alias("link"))
    rows = placed.withColumn("n", (F.col("size") - ROW_BYTES).cast("int")).join(texts, ["doc_id", "n", "text_crc32"])
    of_link = rows.groupBy("link", "shard").agg(F.count(F.lit(1)).alias("k")).groupBy("link").agg(F.sum("k").alias("all"), F.sum(F.col("k") * F.col("k")).alias("same"))
    pairs = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return of_link.agg(pairs(F.expr("`all` * (`all` - 1) div 2")).alias("edges"), pairs(F.expr("(`all` * `all` - same) div 2")).alias("cut"))


def level(placed: DataFrame, bytes_of: list[int], k: int, buckets: int) -> DataFrame:
    """Round k: shards above the mean hand rows that fit their excess to those below.

    Rows come in a new random order in every even round, in odd ones the largest first.
    """
    mean = sum(bytes_of) / len(bytes_of)
    over = [max(0.0, b - mean) for b in bytes_of]
    gaps = [(s, mean - b) for s, b in enumerate(bytes_of) if b < mean]
    size_class = 999 - F.floor(F.log2("size") * 8) if k % 2 else F.lit(0)
    order = (F.col("is_linked").cast("int") * 1000 + size_class) * buckets + F.pmod(F.xxhash64("row", "link", F.lit(k)), F.lit(buckets))
    giving = placed.filter(by_shard(over) >= F.col("size")).withColumn("bucket", order)
    giving = before(giving, ["shard"], "bucket", [F.xxhash64("row", "link", F.lit(k)), F.col("row")], F.col("size"), "earlier")
    given = giving.withColumn("given", F.col("earlier") + F.col("size") <= by_shard(over))
    # released bytes of all shards in a row, laid over the receivers' gaps in a row
    starts, at = [], 0.0
    for b in over:
        starts.append(at)
        at += b
    place = by_shard(starts) + F.col("earlier") + F.col("size") / 2
    ends, at = [], 0.0
    for _, gap in gaps:
        at += gap
        ends.append(at)
    receiver = F.least(F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e <= place)), F.lit(len(gaps) - 1))
    to = F.element_at(F.array(*(F.lit(s) for s, _ in gaps)), receiver + 1)
    moved = given.withColumn("shard", F.when(F.col("given"), to).otherwise(F.col("shard")))
    kept = placed.filter(by_shard(over) < F.col("size"))
    return kept.unionByName(moved.select(*placed.columns))


def levelled(placed: DataFrame, n_shards: int, mean: float, buckets: int) -> DataFrame:
    """placed after rounds of `level`, until sizes are within TOLERANCE or rounds gain nothing more.

    What rounds gain is judged by the bytes that are over the mean in all
    shards together, so that one shard that can't be mended doesn't end the
    work on the others.
    """
    least, idle, k = float("inf"), 0, 0
    while True:
        bytes_of = loads(placed, n_shards)
        over = sum(max(0.0, b - mean) for b in bytes_of)
        idle = idle + 1 if over > least * (1 - LEAST_GAIN) else 0
        if max(abs(b - mean) for b in bytes_of) <= mean * TOLERANCE or idle == IDLE_ROUNDS:
            return placed
        least = min(least, over)
        placed = durable(level(placed, bytes_of, k, buckets))
        k += 1


def too_large(rows: DataFrame, n_shards: int, total: int) -> list[tuple[int, int]]:
    """(row, size) of the rows that are larger than the mean of the shards which they leave to the others; fewer than shards."""
    largest = [(r["row"], r["size"]) for r in rows.orderBy(F.desc("size"), "row").select("row", "size").limit(n_shards - 1).collect()]
    alone: list[tuple[int, int]] = []
    for row, size in largest:
        if size * (n_shards - len(alone)) <= total:
            break
        alone.append((row, size))
        total -= size
    return alone


def place_documents(docs: DataFrame, n_shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of docs(doc_id, text).

    Documents of equal text are linked. size is the text's UTF-8 bytes and 16;
    a null text has no bytes, crc32 0 and no links. Sizes of shards end up near
    equal (within TOLERANCE of the mean, or as near as rounds that still gain
    bring them). A document larger than a shard's share stands alone in the
    last shards, with a warning, and the mean is that of the others. A link
    larger than LARGEST_PIECE of a shard is split. Slots count from 0
    without gaps in each shard. Repeated rows are placed one by one; an empty
    table gives no rows.
    """
    rows = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32("text"), F.lit(0)).alias("text_crc32"),
        F.md5("text").alias("link"),
    )
    rows = durable(rows.withColumn("row", F.monotonically_increasing_id()))
    total, n_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    alone = too_large(rows, n_shards, total)
    apart = rows.limit(0).withColumn("shard", F.lit(0))
    if alone:
        warnings.warn(f"{len(alone)} documents are larger than a shard's share and have a shard each", stacklevel=2)
        places = F.create_map(*(x for k, (row, _) in enumerate(alone) for x in (F.lit(row).cast("long"), F.lit(n_shards - 1 - k))))
        chosen = F.col("row").isin([row for row, _ in alone])
        apart, rows = rows.filter(chosen).withColumn("shard", F.element_at(places, F.col("row"))), rows.filter(~chosen)
        n_shards, total = n_shards - len(alone), total - sum(size for _, size in alone)
    mean = total / n_shards
    buckets = max(1, n_rows // (BUCKET_ROWS * n_shards))
    groups = rows.filter("link is not null").groupBy("link").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    pieces = F.ceil(F.col("bytes") / F.lit(max(1.0, mean * LARGEST_PIECE)))
    placed = rows.join(groups, "link", "left").withColumn("shard", F.pmod(F.xxhash64("doc_id", "row"), F.lit(n_shards)).cast("int"))
    piece = F.concat_ws("-", F.col("link"), F.pmod(F.xxhash64("row", F.lit("piece")), pieces))
    placed = durable(placed.withColumn("link", F.when(F.col("n") > 1, piece)).withColumn("is_linked", F.col("link").isNotNull()).drop("bytes", "n"))
    alone, linked = placed.filter("not is_linked"), placed.filter("is_linked").withColumnRenamed("shard", "origin")
    tally = durable(linked.groupBy("link", "origin").agg(F.sum("size").alias("held")).withColumn("shard", F.col("origin")))
    away, was = parted(tally), None
    while away and (was is None or away <= was * (1 - LEAST_GAIN)):
        tally = durable(propagate(tally, [mean * FILL - b for b in loads(tally, n_shards, "held")], buckets))
        away, was = parted(tally), away
    # a unit is a document without links, or what one shard holds of a link
    held = tally.groupBy("link", F.col("shard").alias("home")).agg(F.sum("held").alias("size"))
    units = alone.withColumn("home", F.col("shard")).unionByName(held.withColumn("shard", F.col("home")).withColumn("is_linked", F.lit(True)), allowMissingColumns=True)
    units = levelled(units, n_shards, mean, buckets)
    homes = units.filter("is_linked").select("link", "home", "shard")
    to = tally.select("link", "origin", F.col("shard").alias("home")).join(homes, ["link", "home"]).select("link", "origin", "shard")
    columns = placed.columns
    placed = units.filter("not is_linked").select(*columns).unionByName(linked.join(to, ["link", "origin"]).select(*columns))
    placed = levelled(placed, n_shards, mean, buckets).select("doc_id", "size", "text_crc32", "row", "shard")
    placed = placed.unionByName(apart.select(*placed.columns)).withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(buckets)))
    slotted = before(placed, ["shard"], "bucket", [F.col("row")], F.lit(1), "slot")
    return slotted.select("doc_id", "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot"))
