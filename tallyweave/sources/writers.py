"""Sinks: fixed column lists, written in parallel; the count comes from the same pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ..durability import kept
from ..operators.papers import quality_report

#: The list of a run's outputs, one row each.
MANIFEST_NAME, MANIFEST = "manifest", "run_id long, output string, n_rows long"
#: Name score from which a candidate's name passes.
NAMED = 0.45

#: Headers of the exported files, in their order (fixed values of the file formats).
EXPORTS: dict[str, tuple[str, ...]] = {
    "papers": (
        "id", "title", "journal", "achievement_level", "talent_pool_use", "year", "doi", "paper_url", "url", "source", "source_api_url", "first_author_name",
        "corresponding_author_names_json", "authors_json", "affiliations_json", "created_at", "updated_at",
    ),
    "candidates": (
        "name", "author_role", "paper_id", "title", "journal", "achievement_level", "year", "doi", "paper_url", "source", "affiliations", "is_likely_chinese_name",
        "chinese_name_score", "name_filter_reason",
    ),
    "people_candidates": (
        "name", "affiliations", "last_5_year_total", "first_author_total", "corresponding_author_total", "top_total", "a_plus_total", "a_total", "a1_total", "a2_total",
        "level_counts_json", "paper_links", "paper_titles", "journals", "years", "author_roles", "is_likely_chinese_name", "chinese_name_score", "name_filter_reason",
        "review_status",
    ),
    "quality_report": (
        "journal", "achievement_level", "papers_count", "openalex_count", "crossref_count", "merged_count", "candidates_count", "chinese_candidates_count",
        "missing_author_count", "missing_affiliation_count", "source_errors",
    ),
    "people": (
        "id", "name", "age", "career_stage", "email", "school", "department", "field", "research_direction", "title", "source_url", "primary_source_type",
        "personal_homepage", "research_interests", "biography", "publications_json", "publication_stats_json", "paper_links_json", "photo_url", "photo_path",
        "education", "advisor", "confidence_score", "review_status", "is_likely_chinese_name", "chinese_name_score", "name_filter_reason", "discipline_score",
        "discipline_is_relevant", "discipline_review_status", "discipline_matched_disciplines_json", "discipline_matched_keywords_json",
        "discipline_negative_keywords_json", "discipline_reason", "created_at", "updated_at",
    ),
    "pages": (
        "id", "school", "department", "page_type", "status_code", "fetch_error", "parser_status", "llm_status", "raw_html_path", "url", "source_url", "fetched_at",
        "updated_at",
    ),
    "issues": (
        "id", "person_id", "related_table", "related_id", "issue_type", "severity", "message", "source_url", "status", "created_at", "resolved_at",
    ),
    "people_review": (
        "person_id", "name", "school", "department", "title", "email", "personal_homepage", "review_status", "is_likely_chinese_name", "chinese_name_score",
        "name_filter_reason", "discipline_score", "discipline_is_relevant", "discipline_review_status", "discipline_reason", "publication_stats_json",
        "paper_links_json", "source_url", "primary_source_type", "confidence_score", "open_issue_types", "open_issue_messages", "open_issue_source_urls",
        "review_decision", "review_decision_note", "resolved_issue_types", "created_at", "updated_at",
    ),
    "review_queue": (
        "priority_score", "priority_tier", "person_id", "name", "school", "department", "title", "email", "personal_homepage", "primary_source_type", "confidence_score",
        "review_status", "discipline_score", "discipline_is_relevant", "discipline_review_status", "pub_last_5_year_total", "pub_a_plus_total", "pub_a_total",
        "pub_a1_total", "pub_a2_total", "pub_top_total", "pub_first_author_total", "pub_corresponding_author_total", "pub_journals", "pub_years", "source_url",
        "paper_links", "open_issue_types", "open_issue_messages", "open_issue_source_urls", "gap_missing_school", "gap_missing_homepage", "gap_missing_email",
        "gap_low_confidence", "gap_name_conflict", "gap_discipline_uncertain", "gap_high_output_no_affiliation", "review_decision", "review_decision_note",
        "resolved_issue_types", "created_at", "updated_at",
    ),
    "gap_report": (
        "gap_category", "gap_category_label", "severity", "count", "examples", "recommendation",
    ),
    "school_seeds": (
        "rank", "school_name_en", "school_name_zh", "homepage_url", "difficulty_level", "crawl_status", "notes",
    ),
    "school_entrypoints": (
        "school", "unit", "entry_url", "entry_type", "url_pattern", "pagination_pattern", "person_link_selector", "api_endpoint", "roles_included", "notes", "status",
    ),
}
#: This library's names of columns whose header differs: taken where a frame lacks the header itself.
NAME_RULE = {"is_likely_chinese_name": "name_rule_flag", "chinese_name_score": "name_rule_score", "name_filter_reason": "name_rule_reason"}
ALIASES: dict[str, dict[str, str]] = {
    "papers": {"id": "seq", "authors_json": "authors", "affiliations_json": "affiliations", "corresponding_author_names_json": "corresponding_author_names"},
    "candidates": {**NAME_RULE, "paper_id": "id"},
    "people_candidates": NAME_RULE,
    "quality_report": {
        "journal": "journal_name", "papers_count": "papers", "openalex_count": "openalex_papers", "crossref_count": "crossref_papers", "merged_count": "merged_papers", "candidates_count": "candidates",
        "chinese_candidates_count": "scored_candidates", "missing_author_count": "missing_author", "missing_affiliation_count": "missing_affiliation", "source_errors": "errors",
    },
    "people": {**NAME_RULE, "source_url": "primary_source_url"},
    "pages": {"id": "page_id", "fetch_error": "error"},
    "issues": {"id": "seq"},
    "people_review": {**NAME_RULE, "person_id": "id", "source_url": "primary_source_url", "open_issue_messages": "open_messages"},
    "review_queue": {"person_id": "id", "priority_tier": "tier", "source_url": "primary_source_url", "open_issue_messages": "open_messages"},
    "gap_report": {"gap_category": "category"},
}


def flat(df: DataFrame, columns: Sequence[str], aliases: Mapping[str, str] | None = None) -> DataFrame:
    """The columns as text that CSV can hold: lists of texts joined (JSON where the header says so), other nested values as JSON, missing ones empty."""
    out = []
    for c in columns:
        source = c if c in df.columns else (aliases or {}).get(c, c)
        kind = df.schema[source].dataType if source in df.columns else None
        if kind is None:
            out.append(F.lit("").alias(c))
        elif isinstance(kind, ArrayType) and not c.endswith("_json") and not isinstance(kind.elementType, (StructType, ArrayType, MapType)):
            out.append(F.array_join(source, " | ").alias(c))
        elif isinstance(kind, (ArrayType, StructType, MapType)):
            out.append(F.to_json(source).alias(c))
        else:
            out.append(F.col(source).alias(c))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, columns: Sequence[str], aliases: Mapping[str, str] | None = None) -> int:
    seen = Observation()
    flat(df, columns, aliases).observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return int(seen.get["n"])


#: Order of the files' rows: columns, falling ones with a minus. Files hold ranges of it, in the order of their names.
ORDERS = {"review_queue": ("-priority_score", "seq"), "people": ("school", "name", "id")}


def in_order(df: DataFrame, name: str) -> DataFrame:
    """df in the order of the export, if it has one and df has its columns."""
    keys = ORDERS.get(name, ())
    if not keys or any(k.lstrip("-") not in df.columns for k in keys):
        return df
    return df.orderBy(*(F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in keys))


def export(df: DataFrame, name: str, path: str) -> int:
    return write_csv(in_order(df, name), path, EXPORTS[name], ALIASES.get(name))


def export_rosters(people: DataFrame, path: str, columns: Sequence[str]) -> dict[str, int]:
    """One folder a roster, written in one pass; rows counted beside it."""
    names = ("confirmed", "deferred", "rejected")
    seen = Observation()
    rows = flat(people, [*columns, "roster"]).observe(seen, *(F.count_if(F.col("roster") == n).alias(n) for n in names))
    rows.write.mode("overwrite").partitionBy("roster").option("header", True).csv(path)
    return {n: int(seen.get[n]) for n in names}


def export_batch(frames: Mapping[str, DataFrame], folder: str) -> dict[str, int]:
    """All outputs of a batch; frames that several exports share should be cached by the caller."""
    return {name: export(df, name, f"{folder}/{name}") for name, df in frames.items()}


def export_run(run_id: int, items: DataFrame, journals: DataFrame, papers: DataFrame, candidates: DataFrame, people_candidates: DataFrame, issues: DataFrame, folder: str) -> dict[str, int]:
    """All outputs of a run: papers, candidates (all, and those whose name passes), people, the quality report of all journals and of the run's.

    Frames that several outputs share are computed once. A manifest is taken away
    first and written last, with the rows of each output, so a folder that has one holds
    all outputs of one run (see `finished_run`).
    """
    spark = papers.sparkSession
    nothing = spark.createDataFrame([], MANIFEST)
    nothing.write.mode("overwrite").json(f"{folder}/{MANIFEST_NAME}")
    papers, candidates, issues, journals = (kept(df) for df in (papers, candidates, issues, journals))
    own = journals.join(items.filter(F.col("run_id") == run_id).select("journal_name").distinct(), "journal_name", "left_semi")
    report = lambda some: quality_report(some, papers, candidates, issues)
    named = {
        "papers": ("papers", papers),
        "publication_candidates": ("candidates", candidates),
        "publication_candidates_named": ("candidates", candidates.filter(F.col("name_rule_score") >= NAMED)),
        "publication_people_candidates": ("people_candidates", people_candidates),
        "publication_quality_report": ("quality_report", report(journals)),
        f"publication_quality_report_{run_id}": ("quality_report", report(own)),
    }
    counts = {name: export(df, kind, f"{folder}/{name}") for name, (kind, df) in named.items()}
    written = spark.createDataFrame([(run_id, name, n) for name, n in counts.items()], MANIFEST).coalesce(1)
    written.write.mode("overwrite").json(f"{folder}/{MANIFEST_NAME}")
    return counts


def finished_run(spark: SparkSession, folder: str) -> tuple[int, dict[str, int]] | None:
    """Run and rows of each output in the folder; None if its outputs are not those of one finished run."""
    rows = spark.read.schema(MANIFEST).json(f"{folder}/{MANIFEST_NAME}").collect()
    return (rows[0].run_id, {r.output: r.n_rows for r in rows}) if rows else None


def write_record(record: DataFrame, path: str) -> None:
    record.write.mode("overwrite").json(path)
