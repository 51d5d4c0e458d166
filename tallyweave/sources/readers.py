"""Typed readers: every file gets an explicit schema, missing columns are tolerated, blanks are trimmed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import normalize_text, nz, safe_int, text_or_empty
from ..operators.papers import ITEM, WORK, papers_from_items, papers_from_works
from ..operators.review import read_decisions
from ..schemas import schema

#: Headers of the journal list (fixed values of the file format).
JOURNAL_HEADERS = {
    "来源文件": "source_file", "期刊体系": "journal_system", "学科/方向": "discipline", "期刊名称": "journal_name",
    "ISSN/CN": "issn_cn", "学校级别": "achievement_level", "人才库用途": "talent_pool_use", "备注": "notes",
}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, in file order (`seq`); a byte order mark is dropped by the reader."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    return numbered(rows)


def numbered(rows: DataFrame) -> DataFrame:
    """rows of files that are read whole, with `seq` from 0: files by name, then rows in their file.

    The number is the file's start and the row's place in it, so it does not
    depend on how files are dealt to tasks. One row a file is summed up.
    """
    own = [F.col(f"`{c}`") for c in rows.columns]
    placed = rows.select(*own, F.col("_metadata.file_path").alias("__file"), F.monotonically_increasing_id().alias("__id"))
    files = placed.groupBy("__file").agg(F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    seq = (F.col("__start") + F.col("__id") - F.col("__first")).cast("long")
    return placed.join(starts, "__file").select(*own, seq.alias("seq"))


def pick(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Columns renamed and trimmed; those that the file lacks are empty."""
    have = {c.strip(): c for c in df.columns}
    out = [(F.trim(text_or_empty(F.col(f"`{have[src]}`"))) if src in have else F.lit("")).alias(dst) for src, dst in columns.items()]
    return df.select(*out, *(["seq"] if "seq" in df.columns else []))


def plain(df: DataFrame, table: str) -> DataFrame:
    return pick(df, {f.name: f.name for f in schema(table).fields if f.name != "seq"})


def journals(spark: SparkSession, path: str, headers: Mapping[str, str] = JOURNAL_HEADERS) -> DataFrame:
    rows = pick(read_csv(spark, path), headers).filter("journal_name != ''")
    return rows.withColumn("normalized_journal_name", normalize_text("journal_name"))


def school_seeds(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Seeds by suffix of the file: CSV, or Parquet rows in pairs (see pair_rows)."""
    if path.endswith(".csv"):
        rows = plain(read_csv(spark, path), "school_seeds")
    else:
        rows = pair_rows(spark.read.parquet(path))
    typed = rows.withColumns({"rank": safe_int("rank"), "difficulty_level": safe_int("difficulty_level")}).filter("school_name_en != ''")
    return typed.orderBy("seq").limit(limit) if limit else typed


def pair_rows(rows: DataFrame) -> DataFrame:
    """Records that take two rows: a ranked row with one name, then one without a rank that has the rest.

    rows(block, row_idx, c0..c5): c0 is the rank; block keeps pairs together
    (one sheet or file), and only within a block is the rank carried on. The
    first pair of a name wins.
    """
    carried = Window.partitionBy("block").orderBy("row_idx").rowsBetween(Window.unboundedPreceding, 0)
    rank = safe_int("c0")
    named = rows.withColumns({"rank": F.last(rank, ignorenulls=True).over(carried), "first_name": F.last(F.when(rank.isNotNull(), F.trim("c1")), ignorenulls=True).over(carried), "is_ranked": rank.isNotNull()})
    second = named.filter(~F.col("is_ranked") & F.col("rank").isNotNull())
    nth = Window.partitionBy("school_name_en").orderBy("seq")
    pairs = second.select(
        F.col("rank").cast("string").alias("rank"), F.trim(text_or_empty("first_name")).alias("school_name_zh"), F.trim(text_or_empty("c1")).alias("school_name_en"), F.trim(text_or_empty("c2")).alias("homepage_url"),
        F.trim(text_or_empty("c3")).alias("difficulty_level"), F.trim(text_or_empty("c4")).alias("crawl_status"), F.trim(text_or_empty("c5")).alias("notes"), F.col("row_idx").cast("long").alias("seq"),
    )
    return pairs.withColumn("nth", F.row_number().over(nth)).filter("nth = 1").drop("nth")


def school_entrypoints(spark: SparkSession, path: str) -> DataFrame:
    rows = plain(read_csv(spark, path), "school_entrypoints").filter("school != '' and entry_url != ''")
    return rows.withColumn("status", F.coalesce(nz("status"), F.lit("new")))


def journal_groups(spark: SparkSession, path: str, group: str) -> DataFrame:
    names = ("journal_name", "achievement_level", "issn", "collection_group", "default_for_m6", "reason", "notes")
    members = pick(read_csv(spark, path), {n: n for n in names}).filter(F.col("collection_group") == group)
    if members.isEmpty():
        raise ValueError(f"no journals in group {group!r}")
    return members


def decisions(spark: SparkSession, path: str) -> DataFrame:
    names = ("person_id", "review_decision", "review_decision_note", "resolved_issue_types")
    rows = pick(read_csv(spark, path), {n: n for n in names})
    return read_decisions(rows).withColumn("person_id", F.col("person_id").try_cast("long")).filter("person_id is not null")


def export(spark: SparkSession, path: str, columns: list[str], condition: Column | None = None) -> DataFrame:
    """An exported table read again; a file that is not there is an empty table."""
    try:
        rows = pick(read_csv(spark, path), {c: c for c in columns})
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        rows = spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns) + ", seq long")
    return rows if condition is None else rows.filter(condition)


def html_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages from a Parquet table, or one row a file of a folder of raw HTML."""
    if path.endswith(".parquet"):
        return spark.read.parquet(path)
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.html").load(path)
    return raw.select(F.xxhash64("path").alias("page_id"), F.col("path").alias("url"), F.decode("content", "UTF-8").alias("html"))


def works(spark: SparkSession, path: str, fallback_journal: str = "") -> DataFrame:
    return papers_from_works(spark.read.schema(WORK).json(path), fallback_journal)


def items(spark: SparkSession, path: str, fallback_journal: str = "") -> DataFrame:
    return papers_from_items(spark.read.schema(ITEM).json(path), fallback_journal)
