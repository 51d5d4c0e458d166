"""From raw documents to shards of a training mix, in five stages.

Each stage takes what its predecessor kept; all but the last return the
columns of `documents`. Between stages the rows are written as Parquet in the
shared checkpoint folder, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyweave.llm import toxicity
from tallyweave.llm.common import free_name, kept_folder, table
from tallyweave.llm.decontaminate import is_contaminated, scan_documents
from tallyweave.llm.jaccard_join import one_of_each
from tallyweave.llm.mixing import mixed_documents
from tallyweave.llm.queries import sharded


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5.

    Each row is judged by its text alone, so repeated rows stay or go together;
    null and empty texts have the score of no features; a score of 0.5 goes.
    Without labelled rows nothing is rejected.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.filter(toxicity.toxicity(docs, model) < 0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the row with the smallest id (see `one_of_each` for ties, repeats and nulls)."""
    return one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a hit word, or with less than one word in twenty in a passage of the benchmark.

    Each row is judged by its text alone, so repeated rows stay or go together;
    null and empty texts have no words and stay; exactly one in twenty goes; an
    empty benchmark rejects nothing.
    """
    name = free_name(docs, "scan")
    scanned = scan_documents(docs, table(spark, sf_dir, "benchmark"), name)
    return scanned.filter(~is_contaminated(name)).drop(name)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it.

    Every row is an entry of its own, repeated ones too; null and empty texts
    have no words and are not taken; a null source is a source.
    """
    return mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row of the mix; repeated rows are placed one by one, null texts by their id."""
    return sharded(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The classifier and the similarity join have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{kept_folder(spark)}/pipeline-{uuid.uuid4()}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
