"""Record types of the entity store, and what brings any frame to one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

AUTHORS = "array<struct<name: string, author_id: string, orcid: string, position: string, is_corresponding: boolean, affiliations: array<string>>>"

TABLES: dict[str, str] = {
    "sources": "source_type string, name string, base_url string, config_json string, seq long",
    "school_seeds": "rank int, school_name_en string, school_name_zh string, homepage_url string, difficulty_level int, crawl_status string, notes string, seq long",
    "school_entrypoints": "school string, unit string, entry_url string, entry_type string, url_pattern string, pagination_pattern string, person_link_selector string, api_endpoint string, roles_included string, notes string, status string, seq long",
    "journals": "source_file string, journal_system string, discipline string, journal_name string, normalized_journal_name string, issn_cn string, achievement_level string, talent_pool_use string, notes string, seq long",
    "pages": "url string, source_id long, source_url string, school string, department string, page_type string, status_code int, content_hash string, html string, parser_status string, llm_status string, error string, seq long",
    "papers": f"title string, normalized_title string, journal string, year int, doi string, url string, abstract string, authors {AUTHORS}, first_author_name string, corresponding_author_names array<string>, affiliations array<string>, source string, paper_url string, source_api_url string, seq long",
    "people": "id long, name string, normalized_name string, school string, department string, title string, email string, personal_homepage string, primary_source_url string, primary_source_type string, confidence_score decimal(9,4), review_status string, seq long",
    "candidate_links": "url string, source_id long, source_url string, link_text string, link_type string, score decimal(9,4), school string, department string, status string, seq long",
    "review_issues": "person_id long, related_table string, related_id long, issue_type string, severity string, message string, source_url string, status string, seq long",
    "publication_runs": "id long, run_name string, journal_group string, from_year int, works_per_journal int, sources string, status string, started_at timestamp, finished_at timestamp",
    "publication_run_items": "run_id long, journal_id long, journal_name string, status string, attempts int, papers_seen int, papers_saved int, last_error string",
    "person_papers": "person_id long, paper_id long, author_role string, seq long",
    "publication_stats": "person_id long, stats string, seq long",
}

DEFAULTS: dict[str, dict[str, str]] = {
    "school_entrypoints": {"status": "new"},
    "candidate_links": {"status": "queued"},
    "pages": {"parser_status": "pending", "llm_status": ""},
    "people": {"review_status": "new"},
    "review_issues": {"severity": "medium", "status": "open"},
    "publication_runs": {"status": "created"},
    "publication_run_items": {"status": "pending"},
}


def schema(table: str) -> StructType:
    return StructType.fromDDL(TABLES[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """df with exactly the table's columns: missing ones are added, defaults fill what is missing."""
    out = []
    for f in schema(table).fields:
        c = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        default = DEFAULTS.get(table, {}).get(f.name)
        out.append((F.coalesce(c, F.lit(default)) if default is not None else c).alias(f.name))
    return df.select(*out)


def add_missing(df: DataFrame, **columns: tuple[str, object]) -> DataFrame:
    """Additive schema evolution: column=(type, default) for each column that df lacks."""
    return df.select("*", *(F.lit(value).cast(kind).alias(name) for name, (kind, value) in columns.items() if name not in df.columns))


def row_counts(tables: dict[str, DataFrame], name: str) -> int:
    """Rows of a known table; other names are refused."""
    if name not in TABLES:
        raise ValueError(f"unknown table: {name}")
    return tables[name].count()
