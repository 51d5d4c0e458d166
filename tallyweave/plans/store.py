"""Queries that run readers, sinks, mappers, lookups, lists and jobs of the store on the test tables.

Each function is registered beside the DuckDB statement that gives the same
rows, written from the tables and not from the code. Files go to the session's
shared folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..durability import shared_folder
from ..functions import text as T
from ..functions.lexicon import Lexicon
from ..operators import evidence, listings, pages, papers, people, profiles, review, runs, upsert
from ..sources import readers, writers
from .entities import decimal, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable:
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return register


def text(c: str) -> Column:
    return F.col(c).cast("string")


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").withColumn("s_address", F.concat(F.lit("Addr "), text("s_suppkey")))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").withColumn("o_clerk", F.concat(F.lit("Clerk "), (F.col("o_orderkey") % 7).cast("string")))


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other session writes to."""
    return f"{shared_folder(spark)}/files/{uuid.uuid4()}/{name}"


def written_csv(df: DataFrame, name: str) -> str:
    path = fresh(df.sparkSession, f"{name}.csv")
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


def written_json(df: DataFrame, name: str) -> str:
    path = fresh(df.sparkSession, f"{name}.json")
    df.write.json(path)
    return path


# -- readers ---------------------------------------------------------------------------------------


@query("""
SELECT trim(s_name) AS journal_name, CASE WHEN s_suppkey % 2 = 0 THEN 'A+' ELSE '' END AS achievement_level, CAST(s_suppkey AS VARCHAR) AS issn_cn, lower(trim(s_name)) AS normalized_journal_name
FROM supplier WHERE s_suppkey % 10 <> 0""")
def journal_reader(spark, sf_dir):
    s = suppliers(spark, sf_dir)
    name = F.when(F.col("s_suppkey") % 10 == 0, " ").otherwise(F.concat(F.lit("  "), F.trim("s_name"), F.lit(" ")))
    rows = s.select(name.alias("期刊名称"), F.when(F.col("s_suppkey") % 2 == 0, "A+").alias("学校级别"), text("s_suppkey").alias("ISSN/CN"))
    return readers.journals(spark, written_csv(rows, "journals")).select("journal_name", "achievement_level", "issn_cn", "normalized_journal_name")


@query("""
SELECT CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CAST(s_suppkey AS INTEGER) END AS rank, s_name AS school_name_en, 'https://example.org/' || s_suppkey AS homepage_url, CAST(s_suppkey % 5 AS INTEGER) AS difficulty_level
FROM supplier WHERE s_suppkey % 11 <> 0""")
def seed_reader(spark, sf_dir):
    s = suppliers(spark, sf_dir)
    rows = s.select(F.when(F.col("s_suppkey") % 7 == 0, "n/a").otherwise(F.concat(text("s_suppkey"), F.lit(".0"))).alias("rank"), F.when(F.col("s_suppkey") % 11 != 0, F.col("s_name")).alias("school_name_en"), F.concat(F.lit("https://example.org/"), text("s_suppkey")).alias("homepage_url"), text("s_nationkey").alias("unused"), (F.col("s_suppkey") % 5).cast("string").alias("difficulty_level"))
    return readers.school_seeds(spark, written_csv(rows, "seeds")).select("rank", "school_name_en", "homepage_url", "difficulty_level")


@query("""
WITH r AS (SELECT o_custkey % 10 AS block, o_orderkey AS i, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS rank, ('Clerk ' || (o_orderkey % 7)) AS c1, o_orderpriority AS c2 FROM orders),
n AS (SELECT *, last_value(rank IGNORE NULLS) OVER w AS k, last_value(CASE WHEN rank IS NOT NULL THEN c1 END IGNORE NULLS) OVER w AS zh FROM r WINDOW w AS (PARTITION BY block ORDER BY i ROWS UNBOUNDED PRECEDING)),
f AS (SELECT *, row_number() OVER (PARTITION BY c1 ORDER BY i) AS nth FROM n WHERE rank IS NULL AND k IS NOT NULL)
SELECT CAST(k AS VARCHAR) AS rank, zh AS school_name_zh, c1 AS school_name_en, c2 AS homepage_url FROM f WHERE nth = 1""")
def row_pairs(spark, sf_dir):
    """Orders as two-row records: a ranked row, then rows without a rank."""
    o = orders(spark, sf_dir)
    rows = o.select((F.col("o_custkey") % 10).cast("string").alias("block"), F.col("o_orderkey").alias("row_idx"), F.when(F.col("o_orderkey") % 3 == 0, text("o_orderkey")).otherwise("").alias("c0"), F.col("o_clerk").alias("c1"), F.col("o_orderpriority").alias("c2"), *(F.lit("").alias(f"c{k}") for k in (3, 4, 5)))
    return readers.pair_rows(rows).select("rank", "school_name_zh", "school_name_en", "homepage_url")


@query("""
SELECT s_name AS school, 'https://example.org/' || s_suppkey AS entry_url, CASE WHEN s_suppkey % 2 = 0 THEN 'done' ELSE 'new' END AS status, '' AS unit
FROM supplier WHERE s_suppkey % 9 <> 0""")
def entrypoint_reader(spark, sf_dir):
    s = suppliers(spark, sf_dir)
    rows = s.select("s_name", F.when(F.col("s_suppkey") % 9 != 0, F.concat(F.lit("https://example.org/"), text("s_suppkey"))), F.when(F.col("s_suppkey") % 2 == 0, "done")).toDF("school", "entry_url", "status")
    return readers.school_entrypoints(spark, written_csv(rows, "entrypoints")).select("school", "entry_url", "status", "unit")


@query("SELECT n_name AS journal_name, 'g' || (n_regionkey % 2) AS collection_group, '' AS issn FROM nation WHERE n_regionkey % 2 = 1")
def group_reader(spark, sf_dir):
    rows = read(spark, sf_dir, "nation").select(F.col("n_name").alias("journal_name"), F.concat(F.lit("g"), (F.col("n_regionkey") % 2).cast("string")).alias("collection_group"))
    return readers.journal_groups(spark, written_csv(rows, "groups"), "g1").select("journal_name", "collection_group", "issn")


@query("""
SELECT CAST(c_custkey AS BIGINT) AS person_id, CASE c_custkey % 3 WHEN 0 THEN 'accepted' WHEN 1 THEN 'rejected' ELSE '' END AS review_decision, CASE WHEN c_custkey % 4 = 0 THEN 'note, "' || c_mktsegment || '"' ELSE '' END AS review_decision_note,
       CASE WHEN c_custkey % 5 = 0 THEN 'a;b' ELSE '' END AS types
FROM customer WHERE c_custkey % 7 <> 0 AND (c_custkey % 3 <> 2 OR c_custkey % 4 = 0 OR c_custkey % 5 = 0)""")
def decision_reader(spark, sf_dir):
    c, k = read(spark, sf_dir, "customer"), F.col("c_custkey")
    rows = c.select(
        F.when(k % 7 == 0, "x").otherwise(k.cast("string")).alias("person_id"), F.when(k % 3 == 0, " Approved").when(k % 3 == 1, "rejected").alias("review_decision"),
        F.when(k % 4 == 0, F.concat(F.lit('note, "'), "c_mktsegment", F.lit('"'))).alias("review_decision_note"), F.when(k % 5 == 0, "a | | b").alias("resolved_issue_types"),
    )
    found = readers.decisions(spark, written_csv(rows, "decisions"))
    return found.select("person_id", "review_decision", "review_decision_note", F.array_join("resolved_issue_types", ";").alias("types"))


@query("SELECT page_id, CAST(length(html) AS BIGINT) AS n FROM pages")
def html_reader(spark, sf_dir):
    return readers.html_pages(spark, f"{sf_dir}/pages.parquet").select("page_id", F.length("html").cast("long").alias("n"))


# -- sinks -----------------------------------------------------------------------------------------


def people_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = read(spark, sf_dir, "customer"), F.col("c_custkey")
    return c.select(
        k.cast("long").alias("id"), F.col("c_name").alias("name"), T.normalize_text("c_name").alias("normalized_name"), F.when(k % 5 == 0, "").otherwise(F.col("c_mktsegment")).alias("school"), F.lit("").alias("department"), F.when(k % 4 == 0, "Professor").otherwise("").alias("title"),
        F.when(k % 3 == 0, F.concat(F.lit("p"), k.cast("string"), F.lit("@example.org"))).otherwise("").alias("email"), F.lit("").alias("personal_homepage"), F.concat(F.lit("https://example.org/p/"), k.cast("string")).alias("primary_source_url"),
        F.when(k % 2 == 0, "publication").otherwise("official_site").alias("primary_source_type"), decimal((k % 100) / 100).alias("confidence_score"), F.lit("new").alias("review_status"),
        F.when(k % 3 == 0, "needs_review").otherwise("accepted").alias("discipline_review_status"), decimal((k % 50) / 100).alias("discipline_score"), k.cast("long").alias("seq"),
    )


def issues_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k = orders(spark, sf_dir), F.col("o_orderkey")
    kind = F.when(k % 3 == 0, "missing_affiliation").when(k % 3 == 1, "low_confidence").otherwise("name_filter_uncertain")
    return o.select(F.col("o_custkey").cast("long").alias("person_id"), F.lit("people").alias("related_table"), F.col("o_custkey").cast("long").alias("related_id"), kind.alias("issue_type"), F.lit("medium").alias("severity"), F.concat(F.lit("order "), k.cast("string")).alias("message"), F.lit("").alias("source_url"), F.when(F.col("o_orderstatus") == "O", "open").otherwise("resolved").alias("status"), k.cast("long").alias("seq"))


PEOPLE_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS school, CASE WHEN c_custkey % 3 = 0 THEN 'p' || c_custkey || '@example.org' ELSE '' END AS email,
       'https://example.org/p/' || c_custkey AS source_url, CAST(CAST((c_custkey % 100) / 100.0 AS DECIMAL(9,4)) AS VARCHAR) AS confidence_score, '' AS advisor
FROM customer"""


@query(PEOPLE_SQL)
def export_people(spark, sf_dir):
    path = fresh(spark, "people")
    writers.export(people_of(spark, sf_dir), "people", path)
    return readers.export(spark, path, list(writers.EXPORTS["people"])).select("id", "name", "school", "email", "source_url", "confidence_score", "advisor")


@query("""
WITH n AS (SELECT c_custkey, count(o_orderkey) FILTER (WHERE o_orderstatus = 'O') AS open, count(o_orderkey) AS all_issues FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1)
SELECT 'people' AS export, count(*) AS n_rows, CAST(36 AS BIGINT) AS n_columns, CAST(sum(c_custkey) AS BIGINT) AS keys FROM customer
UNION ALL SELECT 'issues', count(*), 11, CAST(sum(o_orderkey) AS BIGINT) FROM orders
UNION ALL SELECT 'people_review', count(*), 28, CAST(sum(c_custkey) AS BIGINT) FROM customer
UNION ALL SELECT 'review_queue', count(*), 42, CAST(sum(c_custkey) AS BIGINT) FROM customer
UNION ALL SELECT 'gap_report', 7, 6, (SELECT count(*) FROM customer WHERE c_custkey % 5 = 0) + (SELECT count(*) FROM customer) + (SELECT count(*) FROM customer WHERE c_custkey % 3 <> 0) + (SELECT count(*) FROM customer WHERE c_custkey % 100 < 60)
    + (SELECT count(*) FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 50 < 50) + (SELECT count(*) FROM orders)
UNION ALL SELECT 'pages', count(*), 13, CAST(sum(page_id) AS BIGINT) FROM pages
UNION ALL SELECT 'school_seeds', count(*), 7, CAST(sum(s_suppkey) AS BIGINT) FROM supplier
UNION ALL SELECT 'school_entrypoints', count(*), 11, CAST(0 AS BIGINT) FROM supplier""")
def export_all(spark, sf_dir):
    """Every review export written and read again: rows, columns and the sum of a key."""
    who, issues = people_of(spark, sf_dir), issues_of(spark, sf_dir)
    queue = review.review_queue(who, issues)
    s = suppliers(spark, sf_dir)
    frames = {
        "people": (who, "id"), "issues": (issues, "id"), "people_review": (review.with_issues(who, review.issue_buckets(issues)), "person_id"), "review_queue": (queue, "person_id"),
        "gap_report": (review.gap_texts(review.gap_report(who, issues)), "count"), "pages": (read(spark, sf_dir, "pages", "page_id", "url"), "id"),
        "school_seeds": (s.select(F.col("s_suppkey").alias("rank"), F.col("s_name").alias("school_name_en")), "rank"), "school_entrypoints": (s.select(F.col("s_name").alias("school"), F.lit("0").alias("notes")), "notes"),
    }
    folder, out = fresh(spark, "all"), []
    counts = writers.export_batch({name: df for name, (df, _) in frames.items()}, folder)
    for name, (_, key) in frames.items():
        again = readers.export(spark, f"{folder}/{name}", list(writers.EXPORTS[name]))
        told = spark.read.option("header", True).csv(f"{folder}/{name}")
        out.append(again.agg(F.lit(name).alias("export"), F.lit(counts[name]).cast("long").alias("n_rows"), F.lit(len(told.columns)).cast("long").alias("n_columns"), F.sum(F.col(key).try_cast("long")).alias("keys")))
    return union(out)


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


@query("""
SELECT category AS gap_category, severity FROM (VALUES ('missing_school', 'high'), ('missing_homepage_email', 'medium'), ('low_confidence', 'medium'), ('name_conflict', 'high'), ('discipline_uncertain', 'medium'), ('source_errors', 'medium'), ('abstract_missing', 'low')) t(category, severity)""")
def gap_texts(spark, sf_dir):
    return review.gap_texts(review.gap_report(people_of(spark, sf_dir), issues_of(spark, sf_dir))).select(F.col("category").alias("gap_category"), "severity")


# -- mappers and lookups ---------------------------------------------------------------------------


@query("""
SELECT 'Order ' || o_orderkey AS title, CASE WHEN o_orderkey % 2 = 0 THEN ('Clerk ' || (o_orderkey % 7)) ELSE 'Fallback' END AS journal, CAST(year(o_orderdate) AS INTEGER) AS year, CASE WHEN o_orderkey % 3 = 0 THEN '10.1/ab' || o_orderkey ELSE '' END AS doi,
       'https://w.org/' || o_orderkey AS url, CASE WHEN o_orderkey % 5 = 0 THEN 'https://l.org/' || o_orderkey WHEN o_orderkey % 3 = 0 THEN 'https://doi.org/10.1/AB' || o_orderkey ELSE 'https://w.org/' || o_orderkey END AS paper_url,
       c_name AS first_author_name, ('Clerk ' || (o_orderkey % 7)) AS corresponding, c_mktsegment AS affiliations, 'openalex' AS source
FROM orders JOIN customer ON o_custkey = c_custkey""")
def works_mapper(spark, sf_dir):
    """Orders as works of a dump with authorships, written as JSON and read by the mapper."""
    k = F.col("o_orderkey")
    o = orders(spark, sf_dir).join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))

    def authorship(position: str, corresponding: bool, name: str, place):
        return F.struct(F.lit(position).alias("author_position"), F.lit(corresponding).alias("is_corresponding"), F.struct(F.lit("").alias("id"), F.col(name).alias("display_name"), F.lit("").alias("orcid")).alias("author"), F.array(F.struct(place.alias("display_name"))).alias("institutions"))

    location = F.struct(F.when(k % 5 == 0, F.concat(F.lit("https://l.org/"), k.cast("string"))).alias("landing_page_url"), F.struct(F.when(k % 2 == 0, F.col("o_clerk")).alias("display_name")).alias("source"))
    rows = o.select(
        F.concat(F.lit("https://w.org/"), k.cast("string")).alias("id"), F.when(k % 3 == 0, F.concat(F.lit("https://doi.org/10.1/AB"), k.cast("string"))).alias("doi"), F.concat(F.lit(" Order  "), k.cast("string")).alias("title"), F.year("o_orderdate").alias("publication_year"),
        location.alias("primary_location"), F.array(authorship("last", True, "o_clerk", F.lit(" ")), authorship("first", False, "c_name", F.col("c_mktsegment"))).alias("authorships"),
    )
    found = readers.works(spark, written_json(rows, "works"), "Fallback")
    return found.select("title", "journal", "year", "doi", "url", "paper_url", "first_author_name", F.array_join("corresponding_author_names", "|").alias("corresponding"), F.array_join("affiliations", "|").alias("affiliations"), "source")


@query("""
SELECT 'Order ' || o_orderkey AS title, CASE WHEN o_orderkey % 2 = 0 THEN ('Clerk ' || (o_orderkey % 7)) ELSE 'Fallback' END AS journal, CAST(year(o_orderdate) AS INTEGER) AS year, '10.1/ab' || o_orderkey AS doi, 'https://doi.org/10.1/AB' || o_orderkey AS url,
       'Ann ' || c_name AS first_author_name, CAST(2 AS BIGINT) AS n_authors, c_mktsegment AS affiliations
FROM orders JOIN customer ON o_custkey = c_custkey""")
def items_mapper(spark, sf_dir):
    """Orders as items of a dump with given and family names."""
    k = F.col("o_orderkey")
    o = orders(spark, sf_dir).join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))

    def person(given: str | None, family, name, sequence: str, place):
        return F.struct(F.lit(given).cast("string").alias("given"), family.alias("family"), name.alias("name"), F.lit(None).cast("string").alias("ORCID"), F.lit(sequence).alias("sequence"), F.array(F.struct(place.alias("name"))).alias("affiliation"))

    none = F.lit(None).cast("string")
    rows = o.select(
        F.array(F.lit("Order"), k.cast("string")).alias("title"), F.when(k % 2 == 0, F.array("o_clerk")).otherwise(F.array().cast("array<string>")).alias("container-title"), F.concat(F.lit("10.1/AB"), k.cast("string")).alias("DOI"),
        F.array(person(None, none, F.col("o_clerk"), "additional", F.col("c_mktsegment")), person("Ann", F.col("c_name"), none, "first", F.col("c_mktsegment"))).alias("author"), F.struct(F.array(F.array(F.year("o_orderdate"))).alias("date-parts")).alias("issued"),
    )
    found = readers.items(spark, written_json(rows, "items"), "Fallback")
    return found.select("title", "journal", "year", "doi", "url", "first_author_name", F.size("authors").cast("long").alias("n_authors"), F.array_join("affiliations", "|").alias("affiliations"))


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0') || '-123X' ELSE '' END AS issn FROM supplier""")
def issn_of_venues(spark, sf_dir):
    s, k = suppliers(spark, sf_dir), F.col("s_suppkey")
    said = F.when(k % 2 == 0, F.concat(F.lit("CN 11 / "), F.lpad((k % 10000).cast("string"), 4, "0"), F.lit("-123X; 9999-9999"))).otherwise("none")
    return papers.venue_issns(s.select("s_suppkey", said.alias("codes")), "codes").select("s_suppkey", "issn")


@query("""
SELECT c_custkey, s_name AS work_title FROM customer LEFT JOIN (SELECT s_suppkey, any_value(s_name) AS s_name FROM supplier GROUP BY 1) ON s_suppkey = c_custkey AND c_custkey % 4 <> 0""")
def doi_lookup(spark, sf_dir):
    """Customers as papers, suppliers as works; DOIs differ in case and prefix."""
    k = F.col("c_custkey")
    own = read(spark, sf_dir, "customer").select("c_custkey", F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("https://doi.org/10.5/AB"), k.cast("string"))).alias("doi"))
    works = suppliers(spark, sf_dir).select(F.concat(F.lit(" 10.5/ab"), F.col("s_suppkey").cast("string")).alias("doi"), F.col("s_name").alias("title"), F.col("s_suppkey").alias("seq"))
    return papers.lookup_by_doi(own, works, ["title"]).select("c_custkey", "work_title")


@query("""
WITH h AS (SELECT c_mktsegment || c_nationkey || (c_custkey % 11) AS name, c_name AS place FROM customer), u AS (SELECT name, min(place) AS place FROM h GROUP BY 1 HAVING count(*) = 1)
SELECT c_custkey, place FROM customer LEFT JOIN u ON name = c_mktsegment || c_nationkey || (c_custkey % 11)""")
def unique_hits(spark, sf_dir):
    """Customers by segment, nation and a digit: only a name that one profile has counts."""
    c = read(spark, sf_dir, "customer").select("c_custkey", F.concat("c_mktsegment", F.col("c_nationkey").cast("string"), (F.col("c_custkey") % 11).cast("string")).alias("name"), "c_name")
    return papers.unique_hits(c.select("c_custkey", F.lower("name").alias("name")), c.select("name", F.col("c_name").alias("place"))).select("c_custkey", "place")


@query("""
WITH h AS (SELECT c_nationkey || ' ' || (c_custkey % 7) AS name, arg_min(c_name, c_custkey) AS place FROM customer WHERE c_custkey % 4 = 0 GROUP BY 1)
SELECT o_orderkey, place FROM orders LEFT JOIN h ON name = (o_orderkey % 25) || ' ' || (o_custkey % 7)""")
def first_hits(spark, sf_dir):
    """Orders by two digits: of the customers that a search for these gives the first one counts."""
    c = read(spark, sf_dir, "customer").filter("c_custkey % 4 = 0")
    hits = c.select(F.concat_ws(" ", F.col("c_nationkey").cast("string"), (F.col("c_custkey") % 7).cast("string")).alias("name"), F.col("c_name").alias("place"), F.col("c_custkey").alias("rank"))
    wanted = read(spark, sf_dir, "orders").select("o_orderkey", F.concat_ws("  ", (F.col("o_orderkey") % 25).cast("string"), (F.col("o_custkey") % 7).cast("string")).alias("name"))
    return papers.first_hits(wanted, hits, ["place"]).select("o_orderkey", "place")


@query("""
WITH old AS (SELECT 'https://ex.org/c/' || c_custkey AS url, c_custkey AS k FROM customer WHERE c_custkey % 2 = 0),
new AS (SELECT 'https://ex.org/c/' || o_custkey AS url, o_custkey AS k, max(o_orderkey % 10) AS best FROM orders GROUP BY 1, 2)
SELECT coalesce(old.url, new.url) AS url, CASE WHEN old.url IS NULL THEN 'queued' ELSE 'fetched' END AS status, CASE WHEN new.url IS NULL THEN 'old' ELSE 'new' END AS anchor,
       CAST(coalesce(best / 10.0, 0.5) AS DOUBLE) AS score, CASE WHEN old.url IS NULL THEN NULL ELSE 7 END AS source_id, old.k + 1 AS known_seq
FROM old FULL JOIN new ON old.url = new.url""")
def frontier_upsert(spark, sf_dir):
    """Customers as known links, orders as links found anew: all is taken over but the status, the source stays where none is given."""
    k = F.col("c_custkey")
    link = lambda url, anchor, score, status: [url.alias("url"), F.lit("https://ex.org/").alias("source_url"), F.lit(anchor).alias("anchor"), F.lit("unknown").alias("page_type"), decimal(score).alias("score"), F.lit("").alias("school"), F.lit("").alias("department"), F.lit(status).alias("status")]
    old = read(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(*link(F.concat(F.lit("https://ex.org/c/"), k.cast("string")), "old", F.lit(0.5), "fetched"), F.lit(7).cast("long").alias("source_id"), (k + 1).cast("long").alias("seq"))
    new = read(spark, sf_dir, "orders").select(*link(F.concat(F.lit("http://EX.org/c/"), F.col("o_custkey").cast("string"), F.lit("#x")), "new", (F.col("o_orderkey") % 10) / 10, "queued"))
    after = pages.into_frontier(old, new)
    known = F.when(F.col("status") == "fetched", F.col("seq"))
    return after.select("url", "status", "anchor", F.col("score").cast("double").alias("score"), "source_id", known.alias("known_seq"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN coalesce(('Addr ' || s_suppkey), '') ELSE '' END AS affiliation FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def first_link_affiliation(spark, sf_dir):
    k = F.col("c_custkey")
    links = F.when(k % 3 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("https://doi.org/10.1234/x"), k.cast("string")), F.lit("https://doi.org/10.1234/x1")))
    works = suppliers(spark, sf_dir).select(F.concat(F.lit("10.1234/X"), F.col("s_suppkey").cast("string")).alias("doi"), F.array("s_address").alias("affiliations"), F.col("s_suppkey").alias("seq"))
    return papers.affiliation_by_first_link(read(spark, sf_dir, "customer").select("c_custkey", links.alias("paper_links")), works).select("c_custkey", "affiliation")


@query("""
SELECT o_orderkey, n_name AS journal, CASE WHEN n_nationkey % 2 = 0 THEN 'A+' END AS achievement_level
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey""")
def journal_join(spark, sf_dir):
    n = read(spark, sf_dir, "nation")
    rows = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey").join(read(spark, sf_dir, "customer", "c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    dim = n.filter("n_nationkey % 2 = 0").select(F.concat(F.lit(" "), F.lower("n_name"), F.lit("  ")).alias("journal_name"), F.lit("A+").alias("achievement_level"), F.lit("").alias("issn_cn"))
    return papers.with_journal(rows.select("o_orderkey", F.col("n_name").alias("journal")), dim).select("o_orderkey", "journal", "achievement_level")


# -- lists -----------------------------------------------------------------------------------------


@query("""
SELECT 'entrypoints' AS list, CAST(s_suppkey AS BIGINT) AS id FROM (SELECT * FROM supplier WHERE s_nationkey < 12 AND s_suppkey % 2 = 0 AND s_suppkey % 3 <> 0 ORDER BY s_nationkey % 4, s_suppkey LIMIT 20)
UNION ALL SELECT 'journals', CAST(s_suppkey AS BIGINT) FROM (SELECT * FROM supplier ORDER BY CASE s_suppkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 3 END, s_name LIMIT 15)
UNION ALL SELECT 'seeds', CAST(s_suppkey AS BIGINT) FROM (SELECT * FROM supplier WHERE s_suppkey % 3 <> 0 ORDER BY CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE s_suppkey END NULLS LAST, s_name LIMIT 25)
UNION ALL SELECT 'links', CAST(s_suppkey AS BIGINT) FROM (SELECT * FROM supplier WHERE s_suppkey % 2 = 0 ORDER BY s_suppkey % 10 DESC, s_suppkey LIMIT 12)
UNION ALL SELECT 'publication_only', CAST(c_custkey AS BIGINT) FROM (SELECT * FROM customer WHERE c_custkey % 2 = 0 ORDER BY c_custkey LIMIT 30)
UNION ALL SELECT 'no_affiliation', CAST(o_orderkey AS BIGINT) FROM (SELECT * FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 AND o_orderpriority = '1-URGENT' ORDER BY o_orderpriority, year(o_orderdate) DESC, o_orderkey LIMIT 40)
UNION ALL SELECT 'to_extract', CAST(page_id AS BIGINT) FROM (SELECT * FROM pages WHERE page_id % 4 IN (0, 1) AND page_id % 5 <> 0 AND coalesce(html, '') <> '' ORDER BY page_id LIMIT 18)
UNION ALL SELECT 'to_escalate', CAST(page_id AS BIGINT) FROM (SELECT * FROM pages WHERE page_id % 4 <> 2 AND coalesce(html, '') <> '' ORDER BY page_id LIMIT 18)
UNION ALL SELECT 'issues', CAST(o_orderkey AS BIGINT) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'audit', CAST(page_id AS BIGINT) FROM pages
UNION ALL SELECT 'people', CAST(c_custkey AS BIGINT) FROM customer""")
def lists(spark, sf_dir):
    """Every list of the store with its filters, order and limit."""
    s, k = suppliers(spark, sf_dir), F.col("s_suppkey")
    entry = s.select(k.alias("id"), F.when(k % 3 != 0, "https://example.org").alias("entry_url"), (F.col("s_nationkey") % 4).cast("string").alias("school"), F.lit("").alias("unit"), F.when(k % 2 == 0, "new").otherwise("done").alias("status"), k.alias("seq"), "s_nationkey")
    level = F.when(k % 3 == 0, "A+(TOP)").when(k % 3 == 1, "A+").otherwise("A1")
    seeds = s.select(k.alias("id"), F.when(k % 3 != 0, "https://example.org").alias("homepage_url"), F.when(k % 7 != 0, k).alias("rank"), F.col("s_name").alias("school_name_en"))
    links = s.select(k.alias("id"), F.when(k % 2 == 0, "queued").otherwise("fetched").alias("status"), decimal((k % 10) / 10).alias("score"), k.alias("seq"))
    o, ok = orders(spark, sf_dir), F.col("o_orderkey")
    bare = o.select(ok.alias("id"), F.col("o_orderpriority").alias("journal"), F.year("o_orderdate").alias("year"), F.when(ok % 2 == 0, "10.1/x").alias("doi"), F.when(ok % 3 != 0, F.array(F.lit("x"))).alias("affiliations"), ok.alias("seq"))
    p, pk = read(spark, sf_dir, "pages"), F.col("page_id")
    pages_ = p.select(pk.alias("id"), "url", "html", pk.alias("seq"), F.lit("").alias("school"), F.when(pk % 4 == 0, "pending").when(pk % 4 == 2, "done").when(pk % 4 == 3, "parsed").alias("parser_status"), F.when(pk % 5 == 0, "organization").otherwise("faculty_list").alias("page_type"), F.when(pk % 4 == 2, "done").otherwise("").alias("llm_status"))
    who = people_of(spark, sf_dir)
    found = {
        "entrypoints": listings.entrypoints(entry.filter("s_nationkey < 12"), 20, schools=["0", "1", "2", "3"], statuses=["new"]), "journals": listings.journals(s.select(k.alias("id"), F.col("s_name").alias("journal_name"), level.alias("achievement_level")), 15),
        "seeds": listings.school_seeds(seeds, 25), "links": listings.candidate_links(links, "queued", 12), "publication_only": listings.publication_only(who, 30), "no_affiliation": listings.papers_without_affiliation(bare, 40, ["1-URGENT"]),
        "to_extract": listings.pages_to_extract(pages_, 18), "to_escalate": listings.pages_to_escalate(pages_, 18), "issues": listings.issues(issues_of(spark, sf_dir), "open").withColumn("id", F.col("seq")), "audit": listings.page_audit(pages_), "people": listings.people(who),
    }
    return union([df.select(F.lit(name).alias("list"), F.col("id").cast("long").alias("id")) for name, df in found.items()])


@query("""
SELECT page_id, CASE WHEN lower(t) LIKE '%profile%' AND lower(t) NOT LIKE '%list%' THEN 'faculty_candidate' WHEN regexp_matches(lower(t), 'list|directory|api') THEN 'faculty_list' ELSE '' END AS kind
FROM (SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'Profile page' WHEN 1 THEN 'Profile LIST' WHEN 2 THEN 'JSON API' WHEN 3 THEN 'Directory' ELSE url END AS t FROM pages)""")
def entry_types(spark, sf_dir):
    k = F.col("page_id")
    t = F.when(k % 5 == 0, "Profile page").when(k % 5 == 1, "Profile LIST").when(k % 5 == 2, "JSON API").when(k % 5 == 3, "Directory").otherwise(F.col("url"))
    return read(spark, sf_dir, "pages", "page_id", "url").select("page_id", pages.entry_page_type(t).alias("kind"))


# -- runs and jobs ---------------------------------------------------------------------------------


def runs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as runs."""
    k = F.col("s_suppkey")
    rows = suppliers(spark, sf_dir).select(
        k.cast("long").alias("id"), F.concat(F.lit("run "), k.cast("string")).alias("run_name"), F.col("s_nationkey").cast("string").alias("journal_group"), F.lit(1993).alias("from_year"), F.lit(3).alias("works_per_journal"), F.lit("openalex,crossref").alias("sources"),
        F.when(k % 3 == 0, "completed").when(k % 3 == 1, "partial").otherwise("failed").alias("status"),
    )
    return schemas.conform(rows, "publication_runs")


@query("""
WITH r AS (SELECT CAST(s_suppkey AS BIGINT) AS id, s_nationkey AS g, CASE s_suppkey % 3 WHEN 0 THEN 'completed' WHEN 1 THEN 'partial' ELSE 'failed' END AS status FROM supplier)
SELECT 'latest_resumable' AS what, max(id) AS id, 'partial' AS status FROM r WHERE g = 3 AND status = 'partial' HAVING max(id) IS NOT NULL
UNION ALL SELECT 'latest', max(id), '' FROM r
UNION ALL SELECT 'by_id', id, status FROM r WHERE id = 2
UNION ALL SELECT 'created', max(id) + 1, 'created' FROM r
UNION ALL SELECT 'set', id, 'running' FROM r WHERE id = 1
UNION ALL SELECT 'count', count(*), '' FROM r""")
def run_lookups(spark, sf_dir):
    r = runs_of(spark, sf_dir)
    at = F.lit("2026-01-01 00:00:00").cast("timestamp")
    new = runs.create_run(r, run_name="x", journal_group="g", from_year=2020, works_per_journal=1, sources="crossref")
    found = {
        "latest_resumable": runs.latest_resumable(r, journal_group="3").select("id", "status"), "latest": runs.latest_id(r).withColumn("status", F.lit("")), "by_id": runs.by_id(r, 2).select("id", "status"),
        "created": new.filter("status = 'created'").select("id", "status"), "set": runs.set_status(r, 1, "running", at, started=True).filter("started_at is not null and finished_at is null").select("id", "status"),
    }
    counted = spark.range(1).select(F.lit(schemas.row_counts({"publication_runs": r}, "publication_runs")).cast("long").alias("id"), F.lit("").alias("status"))
    return union([df.select(F.lit(name).alias("what"), "id", "status") for name, df in (found | {"count": counted}).items()])


WORKS_SQL = """
w AS (SELECT CAST(c_nationkey AS BIGINT) AS journal_id, CASE WHEN o_orderkey % 3 = 0 THEN 'crossref' WHEN o_orderkey % 3 = 1 THEN 'openalex' ELSE 'other' END AS source, year(o_orderdate) AS year, 'Order ' || o_orderkey AS title FROM orders JOIN customer ON o_custkey = c_custkey)"""


@query(f"""
WITH {WORKS_SQL},
i AS (SELECT CAST(n_nationkey AS BIGINT) AS journal_id FROM nation WHERE n_nationkey % 4 <> 1),
t AS (SELECT * FROM (SELECT w.*, row_number() OVER (PARTITION BY journal_id, source ORDER BY year DESC, title) AS nth FROM w JOIN i USING (journal_id) WHERE source IN ('openalex', 'crossref') AND year BETWEEN 1993 AND 1996) WHERE nth <= 3),
n AS (SELECT journal_id, count(*) AS n, count(DISTINCT source) AS sources FROM t GROUP BY 1)
SELECT CAST(n_nationkey AS BIGINT) AS journal_id, CASE WHEN n_nationkey % 4 = 1 THEN 'completed' WHEN coalesce(sources, 0) = 0 THEN 'failed' ELSE 'completed' END AS status, CAST(CASE WHEN n_nationkey % 4 = 1 THEN 0 ELSE 1 END AS INTEGER) AS attempts,
       CAST(CASE WHEN n_nationkey % 4 = 1 THEN 0 ELSE coalesce(n, 0) END AS INTEGER) AS papers_seen, CAST(CASE WHEN n_nationkey % 4 = 1 THEN 0 ELSE coalesce(n, 0) END AS INTEGER) AS papers_saved
FROM nation LEFT JOIN n ON journal_id = n_nationkey""")
def batch_job(spark, sf_dir):
    """A run over nations as journals, orders as works, that already has completed items."""
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("journal_name"))
    none = spark.createDataFrame([], schemas.schema("publication_run_items"))
    r, items, run_id = runs.open_run(schemas.conform(spark.createDataFrame([], schemas.schema("publication_runs")), "publication_runs"), none, n, journal_group="g", from_year=1993, works_per_journal=3, sources="openalex,crossref")
    items = items.withColumn("status", F.when(F.col("journal_id") % 4 == 1, "completed").otherwise(F.col("status")))
    k = F.col("o_orderkey")
    works = orders(spark, sf_dir).join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").cast("long").alias("journal_id"), F.when(k % 3 == 0, "crossref").when(k % 3 == 1, "openalex").otherwise("other").alias("source"), F.year("o_orderdate").alias("year"), F.concat(F.lit("Order "), k.cast("string")).alias("title"))
    _, after, _, _ = runs.run_job(r, items, works, n, run_id, F.lit("2026-01-01").cast("timestamp"), 1996)
    return after.select("journal_id", "status", "attempts", "papers_seen", "papers_saved")


@query("""
SELECT n_name AS journal, CASE WHEN o_orderkey % 3 = 0 THEN 'crossref' ELSE 'openalex' END AS source, count(*) AS n
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey WHERE o_orderkey % 3 < 2 AND year(o_orderdate) BETWEEN 1994 AND 1997 AND length(n_name) >= 5 GROUP BY 1, 2""")
def collected_papers(spark, sf_dir):
    k, n = F.col("o_orderkey"), read(spark, sf_dir, "nation")
    works = orders(spark, sf_dir).join(read(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    works = works.select(F.lower("n_name").alias("journal"), F.when(k % 3 == 0, "crossref").when(k % 3 == 1, "openalex").otherwise("other").alias("source"), F.year("o_orderdate").alias("year"), k.alias("seq"))
    found, _ = papers.collect_papers(works, n.select(F.col("n_name").alias("journal_name")), 1994, 1997)
    return found.groupBy("journal", "source").agg(F.count(F.lit(1)).alias("n"))


# -- people ----------------------------------------------------------------------------------------


@query("""
WITH c AS (SELECT s_suppkey AS k, lower('Customer#' || lpad(CAST(s_suppkey * 2 AS VARCHAR), 9, '0')) AS name, s_suppkey % 100 / 100.0 AS score FROM supplier),
p AS (SELECT c_custkey AS k, lower(c_name) AS name FROM customer)
SELECT p.name AS normalized_name, CASE WHEN c.k IS NOT NULL THEN 'needs_review' ELSE 'new' END AS review_status, CASE WHEN c.k IS NOT NULL THEN 'paper ' || c.k ELSE '' END AS links FROM p LEFT JOIN c USING (name)
UNION ALL SELECT c.name, 'needs_review', 'paper ' || c.k FROM c LEFT JOIN p USING (name) WHERE p.k IS NULL""")
def merged_people(spark, sf_dir):
    """Suppliers as candidates under customers' names."""
    k, lists_ = F.col("s_suppkey"), "array<string>"
    name = F.concat(F.lit("CUSTOMER#"), F.lpad((k * 2).cast("string"), 9, "0"))
    candidates = suppliers(spark, sf_dir).select(
        name.alias("name"), F.array(F.concat(F.lit("paper "), k.cast("string"))).alias("paper_links"), F.array().cast(lists_).alias("paper_titles"), F.lit("{}").alias("level_counts_json"), decimal((k % 100) / 100).alias("name_rule_score"), F.lit("rule").alias("name_rule_reason"),
        F.lit(0).alias("top_total"), F.lit(0).alias("a_plus_total"), F.lit(1).alias("last_5_year_total"), F.array("s_address").alias("affiliations"), F.lit("needs_review").alias("review_status"),
    )
    who = people_of(spark, sf_dir).withColumns({"paper_links": F.array().cast(lists_), "paper_titles": F.array().cast(lists_), "level_counts_json": F.lit("{}"), "name_rule_score": decimal(F.lit(0)), "name_rule_reason": F.lit("")})
    after, _ = people.merge_candidates(who, candidates)
    return after.select("normalized_name", "review_status", F.array_join("paper_links", "|").alias("links"))


@query("""
SELECT c_custkey AS id, CASE WHEN n IS NULL THEN c_mktsegment ELSE 'School ' || n END AS school, CASE WHEN n IS NOT NULL AND n % 2 = 0 THEN 'needs_review' ELSE 'new' END AS review_status
FROM customer LEFT JOIN (SELECT s_suppkey AS n FROM supplier) ON n = c_custkey""")
def enriched_people(spark, sf_dir):
    who = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("school"), decimal(F.lit(0.5)).alias("confidence_score"), F.lit("new").alias("review_status"))
    k = F.col("s_suppkey")
    proposals = suppliers(spark, sf_dir).select(
        k.alias("person_id"), F.lit("school").alias("field"), F.concat(F.lit("School "), k.cast("string")).alias("new_value"), F.lit("dblp").alias("source"), decimal(F.when(k % 2 == 0, 0.6).otherwise(0.9)).alias("confidence"),
        F.lit("").alias("current_value"), F.lit("").alias("current_source"), F.lit("publication").alias("current_primary_source"),
    )
    return evidence.apply_updates(who, evidence.merge(proposals), ["school"]).select("id", "school", "review_status")


@query("""SELECT s_suppkey || ': school <- School ' || s_suppkey || ' (dblp)' AS line FROM supplier""")
def described_changes(spark, sf_dir):
    k = F.col("s_suppkey")
    merged = suppliers(spark, sf_dir).select(k.alias("person_id"), F.lit("school").alias("field"), F.concat(F.lit("School "), k.cast("string")).alias("value"), F.lit("dblp").alias("source"))
    return evidence.describe(merged).select("line")


@query("""
SELECT CAST(max(o_orderkey) + (SELECT count(*) FROM supplier) AS BIGINT) AS last, count(*) + (SELECT count(*) FROM supplier) AS n, CAST((SELECT count(*) FROM supplier) AS BIGINT) AS numbered FROM orders""")
def added_issues(spark, sf_dir):
    """Issues of suppliers after those of orders: numbers go on without a gap."""
    old = issues_of(spark, sf_dir)
    new = suppliers(spark, sf_dir).select(F.lit("source_error").alias("issue_type"), F.col("s_name").alias("message"), F.lit("open").alias("status"))
    after = people.add_issues(old, new)
    top = old.agg(F.max("seq").alias("top"))
    return after.crossJoin(F.broadcast(top)).agg(F.max("seq").alias("last"), F.count(F.lit(1)).alias("n"), F.count_distinct(F.when(F.col("seq") > F.col("top"), F.col("seq"))).alias("numbered"))


@query("""
SELECT c_custkey AS id, c_name AS affiliation, CASE WHEN c_custkey % 2 = 0 THEN 'late' ELSE 'old' END AS status FROM customer""")
def patched_rows(spark, sf_dir):
    """Rows that exist take the latest value that is not null; changes of others are ignored."""
    target = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("affiliation"), F.lit("old").alias("status"))
    changes = read(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.explode(F.array(F.struct(F.lit(1).alias("seq"), F.lit("early").alias("status")), F.struct(F.lit(2).alias("seq"), F.lit("late").alias("status")), F.struct(F.lit(3).alias("seq"), F.lit(None).cast("string").alias("status")))).alias("c")).select("id", "c.seq", "c.status")
    ghosts = changes.withColumn("id", F.col("id") + 10_000_000)
    return upsert.patch(target, changes.unionByName(ghosts), ["id"], ["status"]).select("id", "affiliation", "status")


@query("""
SELECT s_suppkey, CAST(least(0.9, 0.45 + CASE WHEN s_suppkey % 3 = 0 THEN 0.25 ELSE 0 END + CASE WHEN s_suppkey % 5 >= 2 THEN 0.1 ELSE 0 END + CASE WHEN s_suppkey % 100 >= 70 THEN 0.1 ELSE 0 END) AS DOUBLE) AS confidence,
       '{"top_total":' || (CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END) || ',"last_5_year_total":' || (s_suppkey % 5) || ',"level_counts_json":"x"}' AS stats
FROM supplier""")
def candidate_numbers(spark, sf_dir):
    k = F.col("s_suppkey")
    rows = suppliers(spark, sf_dir).select("s_suppkey", (k % 3 == 0).cast("int").alias("top_total"), (k % 5).cast("int").alias("last_5_year_total"), F.lit("x").alias("level_counts_json"), decimal((k % 100) / 100).alias("score"))
    told = papers.candidate_stats(rows).withColumn("confidence", papers.candidate_confidence(F.col("top_total"), F.lit(0), F.col("last_5_year_total"), F.col("score")))
    return told.select("s_suppkey", F.col("confidence").cast("double").alias("confidence"), F.to_json("publication_stats").alias("stats"))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'known' WHEN s_suppkey IS NOT NULL THEN ('Addr ' || s_suppkey) ELSE '' END AS affiliations
FROM orders LEFT JOIN supplier ON s_suppkey = o_orderkey""")
def backfilled_papers(spark, sf_dir):
    """Orders as papers, suppliers as works of the same DOI: only bare papers are filled."""
    k = F.col("o_orderkey")
    authors = F.array().cast(papers.AUTHOR_LIST)
    own = orders(spark, sf_dir).select("o_orderkey", F.concat(F.lit("10.9/"), k.cast("string")).alias("doi"), authors.alias("authors"), F.when(k % 2 == 0, F.array(F.lit("known"))).otherwise(F.array().cast("array<string>")).alias("affiliations"))
    works = suppliers(spark, sf_dir).select(F.concat(F.lit("https://doi.org/10.9/"), F.col("s_suppkey").cast("string")).alias("doi"), authors.alias("authors"), F.array("s_address", "s_address").alias("affiliations"), F.col("s_suppkey").alias("seq"))
    return papers.backfill_affiliations(own, works).select("o_orderkey", F.array_join("affiliations", "|").alias("affiliations"))


# -- texts -----------------------------------------------------------------------------------------


@query("""
SELECT doc_id, sha1(trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'))) AS clean, CASE WHEN doc_id % 3 = 0 THEN '10.1234/ab' || doc_id ELSE '' END AS doi, CASE WHEN doc_id % 3 = 0 THEN '10.1234/AB' || doc_id WHEN doc_id % 3 = 1 THEN '10.77' END AS found, CAST(CASE WHEN doc_id % 2 = 0 THEN doc_id END AS INTEGER) AS number
FROM documents""")
def text_keys(spark, sf_dir):
    k = F.col("doc_id")
    d = read(spark, sf_dir, "documents", "doc_id", "text")
    link = F.when(k % 3 == 0, F.concat(F.lit(" https://doi.org/10.1234/AB"), k.cast("string"))).otherwise("")
    said = F.when(k % 3 == 1, "10.77").otherwise(F.concat(F.lit("see "), link))
    return d.select("doc_id", T.content_hash(T.clean_text("text")).alias("clean"), T.normalize_doi(link).alias("doi"), T.extract_doi(said).alias("found"), T.safe_int(F.when(k % 2 == 0, F.concat(k.cast("string"), F.lit(".0"))).otherwise("x")).alias("number"))


@query("""SELECT sha1(trim(regexp_replace(replace(lower(coalesce(text, '')), 'ß', 'ss'), '\\s+', ' ', 'g'))) AS h, count(*) AS n FROM documents GROUP BY 1""")
def sql_function(spark, sf_dir):
    """The registered SQL function inside a SQL text."""
    T.register_sql_functions(spark)
    read(spark, sf_dir, "documents", "text").createOrReplaceTempView("texts_to_join")
    return spark.sql("SELECT sha1(normalize_text_for_join(text)) AS h, count(*) AS n FROM texts_to_join GROUP BY 1")


@query("""
SELECT s_suppkey, s_name || '|Bo ' || s_suppkey AS authors, CASE WHEN s_suppkey % 2 = 0 THEN ('Addr ' || s_suppkey) || '|Uni ' || (s_suppkey % 9) ELSE 'Uni ' || (s_suppkey % 9) END AS affiliations FROM supplier""")
def landing_pages(spark, sf_dir):
    """Pages made of suppliers: authors and affiliations in citation tags and JSON-LD."""
    k = F.col("s_suppkey")
    tags = F.concat(F.lit('<meta name="citation_author" content="'), "s_name", F.lit('">'), F.when(k % 2 == 0, F.concat(F.lit('<meta name="citation_author_institution" content="'), "s_address", F.lit('">'))).otherwise(""))
    ld = F.concat(F.lit('<script type="application/ld+json">{"author": [{"name": "Bo '), k.cast("string"), F.lit('", "affiliation": {"name": "Uni '), (k % 9).cast("string"), F.lit('"}}]}</script>'))
    rows = suppliers(spark, sf_dir).select("s_suppkey", F.concat(tags, ld).alias("html"))
    return pages.landing_metadata(rows, "s_suppkey").select("s_suppkey", F.array_join("authors", "|").alias("authors"), F.array_join("affiliations", "|").alias("affiliations"))


@query("""
WITH s AS (SELECT s_suppkey AS k FROM supplier)
SELECT 'https://ex.org/s/' || k AS url, CASE WHEN k % 4 = 0 THEN 'school_home' WHEN k % 4 = 1 THEN 'faculty_candidate' WHEN k % 4 = 2 THEN 'faculty_list' ELSE 'school_home' END AS page_type, CASE WHEN k % 4 IN (1, 2) THEN 'pending' ELSE 'skipped' END AS parser_status,
       CAST(CASE WHEN k % 4 = 0 THEN 0 WHEN k % 4 = 2 THEN 2 ELSE 0 END AS BIGINT) AS links, CAST(CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END AS BIGINT) AS issues
FROM s""")
def discovery_job(spark, sf_dir):
    """Suppliers as schools whose homepages are missing, a profile, a list or something else."""
    k = F.col("s_suppkey")
    url = F.concat(F.lit("https://ex.org/s/"), k.cast("string"))
    seeds = suppliers(spark, sf_dir).select(F.col("s_name").alias("school_name_en"), url.alias("homepage_url"))
    html = (
        F.when(k % 4 == 1, F.lit("<p>Professor of law, a@b.org, research</p>"))
        .when(k % 4 == 2, F.concat(F.lit("<p>Our staff</p><a href='/people/a"), k.cast("string"), F.lit("'>A</a><a href='/people/b'>B</a><a href='/people/c'>C</a><a href='/news'>N</a>")))
        .otherwise("<p>welcome</p>")
    )
    got = suppliers(spark, sf_dir).filter("s_suppkey % 4 <> 0").select(url.alias("url"), html.alias("html"))
    saved, links, issues = pages.discover_from_seeds(seeds, got, 2)
    n_links = links.groupBy(F.col("source_url").alias("url")).agg(F.count(F.lit(1)).alias("links"))
    n_issues = issues.groupBy(F.col("source_url").alias("url")).agg(F.count(F.lit(1)).alias("issues"))
    joined = saved.select("url", "page_type", "parser_status").join(n_links, "url", "left").join(n_issues, "url", "left")
    return joined.fillna(0, ["links", "issues"]).select("url", "page_type", "parser_status", F.col("links").cast("long").alias("links"), F.col("issues").cast("long").alias("issues"))


# -- people on pages -------------------------------------------------------------------------------


def page_of(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts))


@query("""
WITH c AS (SELECT c_custkey AS k, c_custkey % 5 AS kind, c_name, 'Aa' || c_nationkey AS nation, c_mktsegment FROM customer)
SELECT k AS page_id,
       CASE WHEN kind < 4 THEN c_name ELSE '' END AS name,
       CASE kind WHEN 2 THEN 'Lecturer of ' || nation WHEN 3 THEN 'Dean' ELSE '' END AS title,
       CASE kind WHEN 1 THEN 'Institute ' || k || ' of ' || nation WHEN 3 THEN 'Unit ' || nation ELSE '' END AS department,
       CASE kind WHEN 3 THEN 'p' || k || '@example.org' ELSE '' END AS email,
       CASE kind WHEN 0 THEN 'Born in ' || nation || ' . Moved ' || k || ' times.' ELSE '' END AS biography,
       CASE kind WHEN 1 THEN c_mktsegment || ' and more' ELSE '' END AS research,
       CASE kind WHEN 0 THEN 'PhD ' || k ELSE '' END AS education,
       CASE kind WHEN 2 THEN 'https://ex.org/real' || k || '.jpg' ELSE '' END AS photo_url,
       CASE kind WHEN 2 THEN 'https://ex.org/~' || k ELSE '' END AS personal_homepage,
       CAST([3, 3, 3, 4, 0][kind + 1] / 10.0 AS DOUBLE) AS confidence
FROM c""")
def profile_fields(spark, sf_dir):
    """Customers as profile pages of five shapes: nested sections, a heading in a link beside a label block, three titles and a lazy photo, classes, nothing."""
    k, kind, nation = F.col("c_custkey"), F.col("c_custkey") % 5, F.concat(F.lit("Aa"), F.col("c_nationkey").cast("string"))
    name = F.col("c_name")
    html = (
        F.when(kind == 0, page_of("<h1>", name, "</h1><h3>Biography</h3><ul><li><p>Born in <b>", nation, "</b>.</p></li></ul><div>Moved ", k, " times.</div><h3>Education</h3><dl><dd>PhD ", k, "</dd></dl><h4>Teaching</h4><p>no</p>"))
        .when(kind == 1, page_of("<h2 class='name'>", name, "</h2><div><a href='#'><h3>Research Interests</h3></a><p>", F.col("c_mktsegment"), "</p><p>and more</p></div><section><strong>Affiliation</strong>: Institute ", k, " of ", nation, "</section>"))
        .when(kind == 2, page_of("<i class='title'>Dean</i><p>x</p><p>y</p><h1>", name, "</h1><i class='title'>Lecturer of ", nation, "</i><p>z</p><i class='title'>Chair</i><main><img src='/real", k, ".jpg' data-src='/lazy.jpg'><img class='x-person' src='/logo.png'></main><a href='/~", k, "#top'>Homepage</a>"))
        .when(kind == 3, page_of("<noscript><h1>Menu</h1></noscript><h1>", name, "</h1><p class='position'>Dean</p><p class='x-division'>Unit ", nation, "</p><a href='mailto:p", k, "@example.org'>write</a>"))
    )
    rows = read(spark, sf_dir, "customer").select(k.cast("long").alias("page_id"), page_of("https://ex.org/x/", k).alias("url"), html.alias("html"))
    found = profiles.profiles(rows)
    return found.select("page_id", "name", "title", "department", "email", "biography", F.col("research_interests").alias("research"), "education", "photo_url", "personal_homepage", F.col("confidence_score").cast("double").alias("confidence"))


@query("""
WITH s AS (SELECT s_suppkey AS k, s_suppkey % 6 AS kind, s_name FROM supplier)
SELECT k AS page_id, CASE kind WHEN 0 THEN 'parsed' WHEN 1 THEN 'parsed' WHEN 2 THEN 'parsed' WHEN 3 THEN 'no_profile' WHEN 4 THEN 'skipped_name' ELSE 'parsed_before' END AS parser_status,
       CASE kind WHEN 0 THEN 'Bo ' || k || ',' || s_name WHEN 1 THEN s_name WHEN 2 THEN 'Bo ' || k || ',' || s_name ELSE '' END AS people,
       CAST(CASE kind WHEN 0 THEN 2 WHEN 1 THEN 0 WHEN 2 THEN 2 ELSE 0 END AS BIGINT) AS issues
FROM s""")
def extraction_job(spark, sf_dir):
    """Suppliers as pages that wait for extraction: a list, a profile, cards on a page that is no list, nothing, a name that is left out, one that does not wait."""
    k, kind, name = F.col("s_suppkey"), F.col("s_suppkey") % 6, F.col("s_name")
    cards = page_of("<ul><li><a href='/people/a", k, "'>", name, "</a> Dean</li><li><a href='/people/b", k, "'>Bo ", k, "</a> Lecturer</li></ul>")
    whole = lambda n: page_of("<h1>", n, "</h1><p class='position'>Dean</p><p class='x-division'>Unit</p><p>p@example.org</p><h3>Biography</h3><p>Born.</p><h3>Education</h3><p>PhD.</p>")
    html = F.when(kind.isin(0, 2), cards).when(kind.isin(1, 5), whole(name)).when(kind == 4, whole(F.lit("Zz"))).otherwise("<p>hello</p>")
    page_type = F.when(kind.isin(0, 3), "faculty_list").otherwise("faculty_candidate")
    rows = read(spark, sf_dir, "supplier").select(
        k.cast("long").alias("page_id"), page_of("https://ex.org/p/", k).alias("url"), html.alias("html"), page_type.alias("page_type"),
        F.when(kind == 5, "parsed_before").otherwise("pending").alias("parser_status"), F.lit("Ex").alias("school"), k.cast("long").alias("seq"),
    )
    name_score = decimal(F.when(F.col("name") == "Zz", 0.1).otherwise(0.9))
    people, issues, after = profiles.extract_profiles(rows, Lexicon({"none": ["no such word"]}), name_score, least=0.45)
    by_page = people.groupBy("page_id").agg(F.array_join(F.array_sort(F.collect_list("name")), ",").alias("people"))
    raised = issues.groupBy("page_id").agg(F.count(F.lit(1)).alias("issues"))
    joined = after.select("page_id", "parser_status").join(by_page, "page_id", "left").join(raised, "page_id", "left")
    return joined.select("page_id", "parser_status", F.coalesce("people", F.lit("")).alias("people"), F.coalesce("issues", F.lit(0)).cast("long").alias("issues"))


# -- stored snapshots ------------------------------------------------------------------------------


@query("""
WITH c AS (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS note, c_custkey AS seq FROM customer),
o AS (SELECT o_custkey AS k, arg_max(o_orderpriority, o_orderkey) FILTER (WHERE o_orderpriority <> '') AS note, max(o_orderkey) AS seq FROM orders WHERE o_custkey % 8 = 3 GROUP BY 1)
SELECT coalesce(c.k, o.k) AS k, c.name, coalesce(o.note, c.note) AS note, greatest(c.seq, o.seq) AS seq FROM c FULL JOIN o ON c.k = o.k""")
def stored_upserts(spark, sf_dir):
    """Customers as a stored snapshot, into which orders of some customers come; only the parts of these are written again."""
    path = fresh(spark, "snapshot")
    old = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("note"), F.col("c_custkey").cast("long").alias("seq"))
    new = read(spark, sf_dir, "orders").filter("o_custkey % 8 = 3").select(F.col("o_custkey").cast("long").alias("k"), F.lit(None).cast("string").alias("name"), F.col("o_orderpriority").alias("note"), F.col("o_orderkey").cast("long").alias("seq"))
    upsert.upsert_stored(path, old, ["k"], {})
    upsert.upsert_stored(path, new, ["k"], {"name": upsert.last_known, "note": upsert.last_nonempty})
    return upsert.read_stored(spark, path)
