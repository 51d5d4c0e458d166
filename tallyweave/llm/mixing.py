"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, played up to
`repeats` times. An entry's virtual finish time is its source's cumulative
words divided by the source's target; the mix is the prefix of all entries in
the order of their finish times that fits the total budget. Cumulative sums
are taken in two levels (buckets of the shuffled order, then rows in a bucket)
and the end of the prefix is narrowed down from totals of ranges, so that no
source and no stretch of the order needs a task of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import before, durable, free_name

WEIGHTS = (3, 1, 2)
SHARE = 1.5
REPEATS = 2
SEED = "mix-1"
#: Rows that one bucket of a cumulative sum holds on average, and copies of a row that are dealt together.
BUCKET_ROWS = 4096
#: Ranges that one step of the search for the end of the mix looks at, and entries that end it.
RANGES, FEW = 1024, 20_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, repeats: int) -> DataFrame:
    """source, source_size, weight, rank and target of each source of sizes(source, size).

    Targets are share * all sizes, dealt by weight and held to `repeats` times
    a source's size; what a held source can't take goes to the others by
    weight. Sorted by the level at which a source is held, the common level of
    those that are not follows from running sums.
    """
    everywhere = Window.partitionBy(F.lit(0))
    by_name = everywhere.orderBy(F.col("source").asc_nulls_last())
    held_first = everywhere.orderBy(F.col("hold_at"), F.col("rank"))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    level = (F.lit(share) * F.col("all_size") - F.lit(repeats) * (F.col("size_upto") - F.col("source_size"))) / (F.col("all_weight") - F.col("weight_upto") + F.col("weight"))
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("hold_at", F.lit(float(repeats)) * F.col("source_size") / F.col("weight"))
        .withColumn("size_upto", F.sum("source_size").over(held_first))
        .withColumn("weight_upto", F.sum("weight").over(held_first))
        .withColumn("all_size", F.sum("source_size").over(everywhere))
        .withColumn("all_weight", F.sum("weight").over(everywhere))
        .withColumn("level", F.max(F.when(level <= F.col("hold_at"), level)).over(everywhere))
        .select("source", "source_size", "weight", "rank", F.coalesce(F.least(F.lit(float(repeats)) * F.col("source_size"), F.col("level") * F.col("weight")), F.lit(float(repeats)) * F.col("source_size")).alias("target"))
    )


def digest(text: Column | str) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def row_key() -> Column:
    return F.md5(F.to_json(F.struct(F.col("doc_id").cast("string").alias("i"), F.col("source").alias("s"), digest("text").alias("t"))))


def numbered(rows: DataFrame) -> DataFrame:
    """rows(..., copies) as one row a copy, numbered from 1 in `copy`; many copies are dealt in stretches."""
    stretches = F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {BUCKET_ROWS}"))
    dealt = rows.withColumn("stretch", F.explode(stretches)).repartition("row", "stretch")
    first = F.col("stretch") * BUCKET_ROWS + 1
    return dealt.withColumn("copy", F.explode(F.sequence(first, F.least(F.col("copies"), first + (BUCKET_ROWS - 1))))).drop("stretch")


def end_of_prefix(entries: DataFrame, budget: float) -> tuple[float, int] | None:
    """(finish, tie) of the first entry that the budget has no room for; None if it has room for all.

    entries(words, finish, tie), in the order of finish and tie. The range of
    finish times, then of ties among equal times, is cut into RANGES, and the
    one in which the running total passes the budget is searched further.
    """
    spent = 0
    for key in ("finish", "tie"):
        low, high, n, words = entries.agg(F.min(key), F.max(key), F.count(F.lit(1)), F.sum("words")).first()
        if key == "finish" and (not n or words <= budget):
            return None
        while n > FEW and low < high:
            part = F.least(F.floor((F.col(key) - F.lit(low)) / F.lit(high - low) * RANGES), F.lit(RANGES - 1))
            ranges = entries.groupBy(part.alias("part")).agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n"), F.sum("words").alias("words")).orderBy("part").collect()
            for r in ranges:
                if spent + r["words"] > budget:
                    break
                spent += r["words"]
            low, high, n = r["low"], r["high"], r["n"]
            entries = entries.filter(F.col(key).between(F.lit(low), F.lit(high)))
    upto = F.sum("words").over(Window.partitionBy(F.lit(0)).orderBy("finish", "tie").rowsBetween(Window.unboundedPreceding, 0)) + F.lit(spent)
    first = entries.withColumn("upto", upto).filter(F.col("upto") > budget).orderBy("finish", "tie").select("finish", "tie").first()
    return first["finish"], first["tie"]


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, repeats: int = REPEATS, seed: str = SEED) -> DataFrame:
    """One row for each row of docs(doc_id, text, source), with how often the mix takes it.

    Returns row (a hash of doc_id, source and text), doc_id, source, copies
    (rows with this hash), copy (from 1), size, source_size, target and times,
    0 to `repeats`. Every row is an entry of its own in its source's queue, copies
    and rows without an id too; which of several copies goes first does not
    matter, as they are alike. Null and empty texts have size 0 and are taken
    0 times; a null source is a source of its own, ranked last; an empty table
    gives no rows. Every run gives the same mix.
    """
    rows = docs.select(row_key().alias("row"), "doc_id", "source", digest("text").alias("digest"), n_words(F.col("text")).alias("size"))
    alike = durable(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")))
    n_rows = alike.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    targets = durable(source_targets(alike.select("source", (F.col("size") * F.col("copies")).alias("size")), weights, share, repeats))
    place = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "digest", F.col("copy").cast("string"), F.lit(seed))
    rows = numbered(alike).withColumn("shuffled", F.substring(F.md5(place), 1, 16))
    digits = next(d for d in range(1, 9) if n_rows <= BUCKET_ROWS * 16**d)
    queued = rows.join(targets, rows.source.eqNullSafe(targets.source)).drop(targets.source)
    queued = queued.withColumn("bucket", F.substring("shuffled", 1, digits))
    queued = durable(before(queued, ["rank"], "bucket", [F.col("shuffled"), F.col("doc_id"), F.col("size")], F.col("size"), "earlier"))
    # the order of entries of one finish time: their source's rank, then the time that they are played
    ties = F.col("rank").cast("long") * repeats

    def finish(epoch: Column | int) -> Column:
        return (F.col("earlier") + F.col("size") + F.lit(epoch) * F.col("source_size")) / F.when(F.col("target") > 0, F.col("target"))

    entries = queued.filter("size > 0 and target > 0").withColumn("epoch", F.explode(F.array(*map(F.lit, range(repeats)))))
    entries = entries.select(F.col("size").alias("words"), finish(F.col("epoch")).alias("finish"), (ties + F.col("epoch")).alias("tie"))
    budget = targets.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0] if n_rows else 0.0
    end = end_of_prefix(entries, budget)
    taken = F.lit(0)
    for epoch in range(repeats):
        early = F.lit(True) if end is None else (finish(epoch) < F.lit(end[0])) | ((finish(epoch) == F.lit(end[0])) & (ties + epoch < F.lit(end[1])))
        taken = taken + F.when((F.col("size") > 0) & early, 1).otherwise(0)
    return queued.select("row", "doc_id", "source", "copies", "copy", "size", "source_size", "target", taken.cast("int").alias("times"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """docs with each row as often as the mix takes it (see `mix`); columns of any name may follow.

    Of rows alike in doc_id, source and text each meets the decision on one of
    the copies; they are numbered in stretches, as there may be many.
    """
    row, copies, copy, times, time, salt, stretch, nth = (free_name(docs, f"mixed_{n}") for n in ("row", "copies", "copy", "times", "time", "salt", "stretch", "nth"))
    taken = mix(docs, **options).filter("times > 0")
    plan = durable(taken.select(F.col("row").alias(row), F.col("copies").alias(copies), F.col("copy").alias(copy), F.col("times").alias(times)))
    keyed = docs.withColumn(row, row_key())
    each = keyed.join(plan.filter(F.col(copies) == 1).select(row, times).hint("shuffle_hash"), row)
    twins = plan.filter(F.col(copies) > 1)
    if not twins.isEmpty():
        rows = durable(keyed.join(twins.select(row).distinct().hint("shuffle_hash"), row).withColumn(salt, F.monotonically_increasing_id()))
        counted = before(rows.withColumn(stretch, F.floor(F.col(salt) / BUCKET_ROWS)), [row], stretch, [F.col(salt)], F.lit(1), nth)
        numbers = twins.select(row, (F.col(copy) - 1).alias(nth), times)
        each = each.unionByName(counted.join(numbers, [row, nth]).select(*each.columns))
    return each.withColumn(time, F.explode(F.array_repeat(F.lit(1), F.col(times)))).select(*docs.columns)
