"""Queries that run the entity operators on the star-schema and event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.lexicon import Lexicon, NameRules, score_fields, score_name, score_text
from ..functions.text import content_hash, json_map, normalize_text, sorted_json
from ..operators import evidence, papers, review, runs, upsert


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def decimal(c: Column) -> Column:
    return c.cast("decimal(9,4)")


LEVELS = {"1-URGENT": "A+(TOP)", "2-HIGH": "A+", "3-MEDIUM": "A1", "4-NOT SPECIFIED": "A2"}


def order_level(priority: Column) -> Column:
    out = F.lit("A")
    for name, level in LEVELS.items():
        out = F.when(priority == name, level).otherwise(out)
    return out


def party_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as papers, their customers as authors: roles by status, tiers by priority."""
    orders = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    customers = read(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    rows = orders.join(customers, orders.o_custkey == customers.c_custkey, "left").filter("c_name is not null").select(
        F.col("c_name").alias("name"),
        F.when(F.col("o_orderstatus") == "O", papers.FIRST).otherwise(papers.CORRESPONDING).alias("author_role"),
        order_level(F.col("o_orderpriority")).alias("achievement_level"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.col("o_orderpriority").alias("journal"),
        F.year("o_orderdate").alias("year"),
        F.concat(F.lit("https://example.org/o/"), F.col("o_orderkey").cast("string")).alias("paper_url"),
        F.array("c_mktsegment").alias("affiliations"),
        decimal((F.col("o_custkey") % 100) / 100).alias("name_rule_score"),
        F.lit("by key").alias("name_rule_reason"),
        F.col("o_orderkey").alias("seq"),
    )
    rolled = papers.ranked(papers.roll_up(rows))
    lists = {c: F.array_join(c, "|").alias(c) for c in ("journals", "years", "author_roles", "affiliations")}
    totals = [c for c in rolled.columns if c.endswith("_total")]
    return rolled.select("name", *totals, "level_counts_json", *lists.values(), F.size("paper_links").cast("long").alias("n_links"), "review_status")


def venue_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as journals, customers as papers, suppliers as candidates."""
    nation = read(spark, sf_dir, "nation", "n_nationkey", "n_name")
    journals = nation.select(F.col("n_name").alias("journal_name"), F.when(F.col("n_nationkey") % 2 == 0, "A+").otherwise("A1").alias("achievement_level"))
    customers = read(spark, sf_dir, "customer", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    source = F.when(F.col("c_mktsegment") == "BUILDING", "openalex").when(F.col("c_mktsegment") == "AUTOMOBILE", "openalex,crossref").otherwise("crossref")
    rows = customers.select(
        F.col("n_name").alias("journal"), source.alias("source"), F.when(F.col("c_acctbal") < 500, "").otherwise("known").alias("first_author_name"),
        F.when(F.col("c_custkey") % 7 == 0, F.array().cast("array<string>")).otherwise(F.array("c_mktsegment")).alias("affiliations"),
    )
    candidates = read(spark, sf_dir, "supplier", "s_suppkey", "s_nationkey").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("n_name").alias("journal"), decimal((F.col("s_suppkey") % 100) / 100).alias("name_rule_score"))
    issues = nation.select(F.lit("publication_source_error").alias("issue_type"), F.concat(F.lit("no rows for "), "n_name").alias("message"))
    return papers.quality_report(journals, rows, candidates, issues)


def substring_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first benchmark item whose normalised text each document contains."""
    found = papers.attribute(read(spark, sf_dir, "documents", "doc_id", "text"), read(spark, sf_dir, "benchmark"), "text", "text", "item_id", "item_id")
    return found.filter("attributed is not null").select("doc_id", F.col("attributed").alias("item_id"))


def norm_text_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text")
    return docs.groupBy(content_hash(normalize_text("text")).alias("text_sha1")).agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc"))


def content_dupes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surplus copies of each text, beside the first document with it."""
    hashed = read(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", content_hash("text").alias("sha1"))
    firsts = hashed.groupBy("sha1").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return hashed.join(firsts, "sha1").filter("doc_id != first_doc").select("doc_id", "first_doc", "sha1")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value", "props")
    return e.select("user_id", F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("props")).alias("props"), "event_type", "value", F.col("event_id").alias("seq"))


def upsert_last_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert.upsert(None, feed(spark, sf_dir), ["user_id"], {"props": upsert.last_nonempty, "event_type": upsert.ordered_set, "value": upsert.largest})


def upsert_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = feed(spark, sf_dir)
    target = changes.filter("seq % 2 = 0")
    old = upsert.upsert(None, target, ["user_id"], {})
    return upsert.upsert(old, changes.filter("seq % 2 = 1"), ["user_id"], {"event_type": upsert.first})


def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = feed(spark, sf_dir).select("user_id", "event_type", "seq")
    target = upsert.upsert(None, changes.filter("event_type = 'click'"), ["user_id"], {}, default=upsert.first)
    return upsert.insert_or_ignore(target, changes, ["user_id"])


def additive_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = feed(spark, sf_dir).select("user_id", F.lit(1).cast("long").alias("attempts"), F.get_json_object(F.when(F.col("props") != "", F.col("props")), "$.k").try_cast("long").alias("seen"), "seq")
    return upsert.upsert(None, changes, ["user_id"], {"attempts": upsert.added, "seen": upsert.added}).drop("seq")


def duplicate_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    rows = c.select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_custkey") % 3 == 0, "").otherwise(F.col("c_name")).alias("email"), F.when(F.col("c_custkey") % 5 != 0, "").otherwise(F.col("c_name")).alias("phone"),
        F.col("c_acctbal").alias("balance"), F.when(F.col("c_custkey") % 11 == 0, "needs_review").otherwise("accepted").alias("status"),
    )
    quality = [(F.col("email") != "").cast("int") + (F.col("phone") != "").cast("int"), F.floor("balance")]
    merged = upsert.collapse(rows, ["nation", "segment"], quality, ["email", "phone"], ["balance"], {"status": "needs_review"})
    return merged.select("nation", "segment", "id", "email", "phone", "balance", "status", F.size("merged_ids").cast("long").alias("n_merged"))


def prefer_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("normalized_name"), "s_acctbal")
    changes = read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("normalized_name"))
    return upsert.prefer_existing(changes, people, preferred=F.col("s_acctbal") > 5000).select("c_custkey", "normalized_name", "person_id")


PART_LEXICON = Lexicon({"colours": ["red", "blue", "green"], "sizes": ["small", "large"], "objects": ["widget", "ring"]}, strong=["ring"], hard_negatives=["old"], soft_negatives=["cold"])


def lexicon_score_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_brand")
    scored = parts.withColumn("s", score_fields({"name": ("p_name", 0.35), "type": ("p_type", 0.30), "brand": ("p_brand", 0.08)}, PART_LEXICON, accept=0.6))
    return scored.select("p_partkey", F.col("s.score").cast("double").alias("score"), "s.status", "s.reason")


TEXT_LEXICON = Lexicon({"english": ["the", "and"], "german": ["der", "und"]}, {"english": 0.4, "german": 0.35}, hard_negatives=["idiot"], soft_negatives=["license"])


def lexicon_score_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text").withColumn("s", score_text(["text"], TEXT_LEXICON))
    return docs.select("doc_id", F.col("s.score").cast("double").alias("score"), "s.status", "s.reason")


def gate_with_reject_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", "doc_id", "text", "source").select(F.col("source").alias("title"), F.col("text").alias("abstract"), F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("url"))
    kept, rejected = papers.gate(docs, TEXT_LEXICON)
    return kept.select("url", F.lit("kept").alias("outcome"), F.lit("").alias("message")).unionByName(rejected.select(F.col("source_url").alias("url"), F.lit("rejected").alias("outcome"), "message"))


NAME_RULES = NameRules(tokens=["small", "red", "ring"], stop_tokens=["gear"], token_shape="^[a-z]{3,6}$", context="large")


def rule_score_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = read(spark, sf_dir, "part", "p_partkey", "p_name", "p_type").withColumn("s", score_name("p_name", NAME_RULES, F.col("p_type")))
    return parts.select("p_partkey", F.col("s.score").cast("double").alias("score"), "s.flag", "s.reason")


def variant_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names against aliases with a hyphen that share one of their parts."""
    parts = read(spark, sf_dir, "part", "p_name").distinct()
    aliases = parts.select(F.upper(F.concat_ws("-", F.col("p_name"), F.lit("Section B"))).alias("alias"))
    return papers.match_venues(parts, aliases, "p_name", "alias", ["alias"])


def window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    current = 1999
    orders = read(spark, sf_dir, "orders", "o_orderkey", "o_orderdate").withColumn("year", F.year("o_orderdate"))
    return orders.filter(papers.in_window("year", papers.default_from_year(current), current)).select("o_orderkey", "year")


def semi_group_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    groups = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.upper("n_name").alias("journal_name"), F.col("r_name").alias("collection_group"))
    journals = nation.select(F.col("n_name").alias("journal_name"), F.when(F.col("n_nationkey") % 3 == 0, "A+(TOP)").otherwise("A2").alias("achievement_level"), F.col("n_nationkey").cast("string").alias("issn_cn"))
    return papers.journals_of_group(journals, groups, "ASIA")


def order_papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as papers: the supplier of the first line is the first author, the others correspond."""
    lines = read(spark, sf_dir, "lineitem", "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity").groupBy("l_orderkey", "l_suppkey").agg(F.min("l_linenumber").alias("n"), F.count(F.lit(1)).alias("k"))
    who = F.array_sort(F.collect_list(F.struct("n", "l_suppkey", "k")))
    names = lines.groupBy("l_orderkey").agg(who.alias("w"))
    name = lambda x: F.concat(F.lit("S"), x["l_suppkey"].cast("string"))
    return names.select(
        F.col("l_orderkey").alias("paper_id"),
        name(F.element_at("w", 1)).alias("first_author_name"),
        F.transform("w", name).alias("corresponding_author_names"),
        F.transform("w", lambda x: papers.author(name(x), F.lit(""), F.lit(""), F.lit(""), F.lit(False), F.when(x["k"] > 1, F.array(F.concat(F.lit("dept"), x["n"].cast("string")))).otherwise(F.array().cast("array<string>")))).alias("authors"),
        F.array(F.concat(F.lit("order"), F.col("l_orderkey").cast("string"))).alias("affiliations"),
    )


def role_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = papers.author_roles(order_papers(spark, sf_dir))
    return rows.select("paper_id", "name", "author_role", F.array_join("affiliations", "; ").alias("affiliations"))


def zip_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors without affiliation filled from a list: by place where lengths agree, else with the list."""
    rows = order_papers(spark, sf_dir)
    found = F.when(F.col("paper_id") % 2 == 0, F.transform("authors", lambda a: F.concat(F.lit("at "), a["name"]))).otherwise(F.array(F.lit("x"), F.lit("y")))
    merged = papers.merge_affiliations(F.col("authors"), F.col("corresponding_author_names"), F.col("found"))
    filled = rows.withColumn("found", found).withColumn("m", merged)
    return filled.select("paper_id", F.array_join(F.transform("m", lambda a: F.concat(a["name"], F.lit(":"), F.array_join(a["affiliations"], ","))), ";").alias("authors"))


def json_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events", "event_id", "event_type", "props")
    counts = json_map(F.when(F.col("event_id") % 10 == 0, "[1, 2]").when(F.col("event_id") % 10 == 1, "{bad").otherwise(F.col("props")))
    return e.withColumn("m", counts).groupBy("event_type").agg(F.count_if(F.size("m") == 0).alias("n_unusable"), F.sum(F.try_element_at("m", F.lit("k"))).cast("long").alias("total"), F.max(sorted_json(F.col("m"))).alias("largest"))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return c.select(
        key.alias("id"), F.col("c_name").alias("name"), key.alias("seq"),
        F.when(key % 4 == 0, "").otherwise(F.col("c_mktsegment")).alias("school"), F.when(key % 3 == 0, "").otherwise("https://example.org/").alias("personal_homepage"),
        F.when(key % 5 == 0, "").otherwise("a@example.org").alias("email"), decimal((key % 10) / 10).alias("confidence_score"),
        F.when(key % 6 == 0, "accepted").when(key % 6 == 1, "rejected").when(key % 6 == 2, "new").otherwise("needs_review").alias("review_status"),
        F.when(key % 2 == 0, "accepted").otherwise("needs_review").alias("discipline_review_status"), decimal((key % 7) / 7).alias("discipline_score"), F.lit("").alias("review_decision"), F.lit("").alias("review_decision_note"),
    )


def issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issues that the candidate rules raise on orders, in order of the orders."""
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    rows = o.select(F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("seq"), "o_orderkey", "o_orderstatus", "o_totalprice")
    none = F.when(F.col("o_orderkey") % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("x")))
    status = F.when(F.col("o_orderstatus") == "P", "needs_review").otherwise("strong_candidate")
    rules = papers.candidate_rules((F.col("o_orderkey") % 2).cast("int"), decimal((F.col("o_orderkey") % 10) / 10), status, (F.col("o_totalprice") / 50000).cast("int"), none)
    return papers.rule_issues(rows, rules, ["person_id", "seq", "o_orderstatus"]).withColumn("status", F.when(F.col("o_orderstatus") == "F", "resolved").otherwise("open"))


def issue_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return issues(spark, sf_dir).groupBy("issue_type", "severity", "status").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"), F.max("person_id").alias("last_person"))


def issue_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = review.issue_buckets(issues(spark, sf_dir))
    return b.select("person_id", *(F.array_join(c, " | ").alias(c) for c in ("open_issue_types", "open_severities", "resolved_issue_types")), "open_weight", "open_issues")


def review_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = review.review_queue(people(spark, sf_dir), issues(spark, sf_dir))
    return review.queue_order(q).select("id", F.col("priority_shown").cast("double").alias("priority"), "tier", *review.GAPS)


def gap_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.gap_report(people(spark, sf_dir), issues(spark, sf_dir))


def roster_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return review.rosters(people(spark, sf_dir)).groupBy("roster").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def decision_writeback(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus")
    entered = o.select(
        F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderstatus") == "O", " Approved ").when(F.col("o_orderstatus") == "F", "rejected").otherwise("").alias("review_decision"),
        F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("note "), F.col("o_orderkey").cast("string"))).otherwise("").alias("review_decision_note"),
        F.when(F.col("o_orderkey") % 5 == 0, "missing_affiliation | publication_only_needs_review").otherwise("").alias("resolved_issue_types"),
    )
    decided, closed = review.write_back(people(spark, sf_dir), issues(spark, sf_dir), review.read_decisions(entered))
    open_left = closed.filter("status = 'open'").groupBy(F.col("person_id").alias("__p")).agg(F.count(F.lit(1)).alias("open_issues"))
    return decided.join(open_left, F.col("id") == F.col("__p"), "left").select("id", "review_status", "review_decision", "review_decision_note", F.coalesce("open_issues", F.lit(0)).cast("long").alias("open_issues"))


def evidence_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proposals from orders for two fields of each customer."""
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    source = F.when(F.col("o_orderpriority") == "1-URGENT", "semantic_scholar").when(F.col("o_orderpriority") == "2-HIGH", "dblp").when(F.col("o_orderpriority") == "3-MEDIUM", "crossref").otherwise("unknown")
    proposals = o.select(
        F.col("o_custkey").alias("person_id"), F.when(F.col("o_orderstatus") == "O", "school").otherwise("title").alias("field"), F.concat(F.lit("v"), (F.col("o_orderkey") % 13).cast("string")).alias("new_value"), source.alias("source"),
        decimal((F.col("o_orderkey") % 9) / 10).alias("confidence"), F.when(F.col("o_custkey") % 2 == 0, "v1").otherwise("").alias("current_value"), F.lit("crossref").alias("current_source"),
        F.when(F.col("o_custkey") % 17 == 0, "official_site").otherwise("publication").alias("current_primary_source"),
    )
    m = evidence.merge(proposals)
    return m.select("person_id", "field", "value", "source", F.col("rank").cast("int").alias("rank"), F.col("confidence").cast("double").alias("confidence"), "requires_review", "n_values")


def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months as runs, orders as items."""
    o = read(spark, sf_dir, "orders", "o_orderdate", "o_orderstatus", "o_orderkey")
    status = F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 50 == 0), "failed").when((F.col("o_orderstatus") == "P") & (F.month("o_orderdate") == 3), "pending").otherwise("completed")
    items = o.select((F.year("o_orderdate") * 100 + F.month("o_orderdate")).cast("long").alias("run_id"), status.alias("status"))
    return runs.run_status(items)


def ffill_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last known value of each user carried on over events without one."""
    e = read(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value")
    order = Window.partitionBy("user_id").orderBy("event_id").rowsBetween(Window.unboundedPreceding, 0)
    return e.withColumn("carried", F.last(F.when(F.col("event_type") == "click", F.col("value")), ignorenulls=True).over(order)).select("event_id", "user_id", "carried")


def best_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations looked up by name among suppliers' venues: the exact name, else the first hit."""
    nation = read(spark, sf_dir, "nation")
    wanted = nation.select(F.col("n_name").alias("journal"))
    s = read(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    venues = s.select(F.lower("n_name").alias("query"), F.when(F.col("s_suppkey") % 4 == 3, F.col("n_name")).otherwise(F.col("s_name")).alias("display_name"), F.concat(F.lit("https://example.org/"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_suppkey").alias("rank"))
    return papers.resolve_venues(wanted, venues)


QUERIES = {
    f.__name__: f
    for f in (
        party_rollup, venue_quality_report, substring_attribution, norm_text_hash, content_dupes, upsert_last_nonempty, upsert_last_wins, insert_ignore, additive_counters,
        duplicate_collapse, prefer_existing, lexicon_score_fields, lexicon_score_text, gate_with_reject_log, rule_score_names, variant_match, window_filter, semi_group_select,
        role_explode, zip_fill, json_stats, issue_rules, issue_buckets, review_queue, gap_report, roster_split, decision_writeback, evidence_merge, run_status, ffill_pairs, best_lookup,
    )
}
