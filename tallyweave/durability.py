"""Results that are kept where every executor can read them again."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of checkpoints; without spark.checkpoint.dir a local session gets one of its own, a cluster is refused."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """df, computed once, its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
