"""Helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Set while a plan is made: its shuffle files are removed as soon as its result is kept.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def kept_folder(spark: SparkSession) -> str:
    """The session's folder for kept rows, which driver and executors share.

    Without spark.checkpoint.dir a local session gets a folder of its own; a
    cluster, where no such folder would be shared, is refused.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared checkpoint folder; the shuffle files that led to it are removed then."""
    spark = df.sparkSession
    kept_folder(spark)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        return df.select("*").checkpoint()
    finally:
        spark.conf.set(CLEANUP, before)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that df has not, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def finite_vectors(vectors: DataFrame, *keep: str) -> DataFrame:
    """`keep` and embedding (doubles) of the rows whose vector has only finite entries and the commonest length, which is not 0."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    v = vectors.select(*keep, F.col("embedding").cast("array<double>").alias("embedding")).filter(F.forall("embedding", finite) & (F.size("embedding") > 0))
    length = v.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return v.filter(F.size("embedding") == (length[0]["n"] if length else 0))


def fold(id_column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit(""))) % n


def before(df: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column], value: Column, name: str) -> DataFrame:
    """df with `name`: the sum of `value` over the rows that come earlier in its group.

    A group's order is its buckets' order, then `order` within a bucket. No
    window holds more than one bucket's rows or one group's bucket totals, so
    a group of any size is spread over as many tasks as it has buckets.
    Group columns must not be null.
    """
    totals = df.groupBy(*group, bucket).agg(F.sum(value).alias("__total"))
    over_buckets = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    starts = totals.select(
        *group,
        bucket,
        (F.sum("__total").over(over_buckets.orderBy(bucket)) - F.col("__total")).alias("__start"),
    )
    in_bucket = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inner = df.withColumn("__upto", F.sum(value).over(in_bucket) - value)
    return inner.join(starts, [*group, bucket]).withColumn(name, F.col("__start") + F.col("__upto")).drop("__start", "__upto")
