"""The store's lists: which rows a job or an export takes, and in what order.

Filters reach the scan; an order with a limit is a top-k, not a full sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank, text_or_empty, tier_order

EXTRACTABLE = ("faculty_list", "faculty_candidate", "faculty_profile", "")


def first(rows: DataFrame, limit: int | None, *order) -> DataFrame:
    ordered = rows.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def among(rows: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    return rows if not values else rows.filter(F.col(column).isin(*values))


def entrypoints(rows: DataFrame, limit: int | None = None, schools: Sequence[str] | None = None, statuses: Sequence[str] | None = None) -> DataFrame:
    kept = among(among(rows.filter(~is_blank("entry_url")), "school", schools), "status", statuses)
    return first(kept, limit, "school", "unit", "seq")


def journals(rows: DataFrame, limit: int | None = None, names: Sequence[str] | None = None) -> DataFrame:
    return first(among(rows, "journal_name", names), limit, tier_order("achievement_level"), "journal_name")


def school_seeds(rows: DataFrame, limit: int | None = None, names: Sequence[str] | None = None) -> DataFrame:
    return first(among(rows.filter(~is_blank("homepage_url")), "school_name_en", names), limit, F.col("rank").asc_nulls_last(), "school_name_en")


def candidate_links(rows: DataFrame, status: str = "queued", limit: int | None = None) -> DataFrame:
    return first(rows.filter(F.col("status") == status), limit, F.desc("score"), "seq")


def pages_to_extract(rows: DataFrame, limit: int | None = None) -> DataFrame:
    waiting = text_or_empty("parser_status").isin("", "pending", "skipped") & text_or_empty("page_type").isin(*EXTRACTABLE)
    return first(rows.filter(~is_blank("html") & waiting), limit, "seq")


def pages_to_escalate(rows: DataFrame, limit: int | None = None) -> DataFrame:
    return first(rows.filter(~is_blank("html") & text_or_empty("llm_status").isin("", "pending")), limit, "seq")


def papers_without_affiliation(rows: DataFrame, limit: int | None = None, journal_names: Sequence[str] | None = None) -> DataFrame:
    bare = ~is_blank("doi") & (F.coalesce(F.size("affiliations"), F.lit(0)) <= 0)
    return first(among(rows.filter(bare), "journal", journal_names), limit, "journal", F.desc("year"), "seq")


def people(rows: DataFrame) -> DataFrame:
    return rows.withColumnRenamed("primary_source_url", "source_url").orderBy("school", "name", "id")


def publication_only(rows: DataFrame, limit: int | None = None) -> DataFrame:
    return first(rows.filter(F.col("primary_source_type") == "publication"), limit, "id")


def page_audit(rows: DataFrame) -> DataFrame:
    return rows.drop("html").orderBy("school", "page_type", "url")


def issues(rows: DataFrame, status: str | None = None) -> DataFrame:
    return first(rows if status is None else rows.filter(F.col("status") == status), None, "seq")
