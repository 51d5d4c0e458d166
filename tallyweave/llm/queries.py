"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_id, toxicity
from .common import fold, table
from .context_mixing import score_texts
from .decontaminate import is_contaminated, scan_documents
from .hard_negatives import mine
from .jaccard_join import near_duplicates
from .mixing import mix
from .neighbours import nearest
from .packing import pack
from .sharding import place_documents
from .token_counts import encoded_length, length_histogram
from .url_filters import judge_urls
from .whitening import whiten

#: (host, path, verdict) of the production rule list.
URL_RULES = [
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return length_histogram(docs.select(encoded_length(spark, F.col("text")).alias("n_tokens")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = scan_documents(docs, table(spark, sf_dir, "benchmark"))
    return scanned.select(
        "doc_id",
        "scan.n_words",
        "scan.n_hit",
        F.size("scan.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("scan.items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"))


def sharded(docs: DataFrame) -> DataFrame:
    placed = place_documents(docs.select("doc_id", "text"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs)
    found = docs.select("doc_id", (fold("doc_id", language_id.FOLDS) == 0).alias("held_out"), language_id.language(docs, model).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (fold("doc_id", toxicity.FOLDS) == 0).alias("held_out"), toxicity.toxicity(docs, model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of ids that 7 divides are set one further, so that they disagree with their neighbours."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    mined = mine(table(spark, sf_dir, "embeddings").withColumn("label", moved))
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
