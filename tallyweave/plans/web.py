"""Queries that run the page operators on the table of web pages and on documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import content_hash
from ..functions.urls import canonical_url, host
from ..operators import pages, profiles
from .entities import read


#: Where the walk over shared links starts.
SEED_HOST = "spam-farm.example.org"


def canonical_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages", "page_id", "url").select("page_id", canonical_url("url").alias("canonical"))


def url_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "pages", "page_id", "url").withColumn("c", canonical_url("url"))
    return rows.groupBy(host("c").alias("host")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("c").alias("n_urls"), F.min("page_id").alias("first_page"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = pages.useful_links(pages.page_links(read(spark, sf_dir, "pages")), 5)
    return links.select("page_id", "pos", "url", "anchor", "kind", F.col("score").cast("double").alias("score"), "rank")


def page_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = pages.classify_page("html", "url")
    return read(spark, sf_dir, "pages").select("page_id", c["page_type"].alias("page_type"), c["score"].cast("double").alias("score"))


def frontier_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that share a link with a page of the seed host, in two rounds."""
    links = read(spark, sf_dir, "pages").select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(pages.ANCHOR), 1))).alias("href"))
    to_link = links.select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("src"), F.concat(F.lit("l"), "href").alias("dst"))
    both = to_link.unionByName(to_link.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    seeds = read(spark, sf_dir, "pages", "page_id", "url").filter(host("url") == SEED_HOST).select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("node"))
    return pages.expand_frontier(seeds, both, 2)


def contact_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text").withColumn("email", pages.email_of("text"))
    return docs.filter("email != ''").select("doc_id", content_hash("email").alias("email_sha1"))


def page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = profiles.profiles(read(spark, sf_dir, "pages"))
    return found.select("page_id", "name", "title", "n_useful", F.col("confidence_score").cast("double").alias("confidence"), "visible_chars", "script_chars", profiles.needs_escalation()["reason"].alias("reason"))


QUERIES = {f.__name__: f for f in (canonical_urls, url_clusters, page_links, page_class, frontier_rounds, contact_extract, page_sections)}
