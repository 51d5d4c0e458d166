"""People: candidates from papers, profiles from pages, and rescoring, with the issues that each raises."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.lexicon import Lexicon, score_fields
from ..functions.text import is_blank, normalize_text, text_or_empty
from .papers import candidate_confidence, candidate_rules, rule_issues
from .upsert import prefer_existing

#: Columns of a person that a candidate replaces.
REPLACED = ("paper_links", "paper_titles", "level_counts_json")
#: Buckets that new issues are numbered in; a broadcast holds one row of each.
ISSUE_BUCKETS = 4096
ACCEPT, REVIEW, SURE = 0.70, 0.45, 0.65


def merge_candidates(people: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """People after the candidates came in, and the issues that these raise.

    A candidate (one row of the author roll-up) belongs to the person of the
    same folded name, official ones first: lists are replaced, scores raised, a
    reason filled in, and `new` becomes needs_review. Others are new people
    that need review; their id is a hash of the name.
    """
    named = candidates.withColumn("normalized_name", normalize_text("name"))
    official = F.col("primary_source_type") == "official_site"
    matched = prefer_existing(named, people, preferred=official)
    known = matched.filter("person_id is not null").select("person_id", *(F.col(c).alias(f"__{c}") for c in (*REPLACED, "name_rule_score", "name_rule_reason")))
    joined = people.join(known, people.id == known.person_id, "left")
    hit = F.col("person_id").isNotNull()
    changes: dict[str, Column] = {c: F.when(hit, F.col(f"__{c}")).otherwise(F.col(c)) for c in REPLACED}
    changes["name_rule_score"] = F.greatest("name_rule_score", "__name_rule_score")
    changes["name_rule_reason"] = F.when(is_blank("name_rule_reason"), text_or_empty("__name_rule_reason")).otherwise(F.col("name_rule_reason"))
    changes["review_status"] = F.when(hit & (F.col("review_status") == "new"), "needs_review").otherwise(F.col("review_status"))
    updated = joined.withColumns(changes).select(*people.columns)
    confidence = candidate_confidence(F.col("top_total"), F.col("a_plus_total"), F.col("last_5_year_total"), F.col("name_rule_score"))
    fresh = matched.filter("person_id is null").select(
        F.xxhash64("normalized_name").alias("id"), "name", "normalized_name", F.coalesce(F.try_element_at("affiliations", F.lit(1)), F.lit("")).alias("school"),
        F.lit("publication").alias("primary_source_type"), *REPLACED, "name_rule_score", "name_rule_reason", confidence.alias("confidence_score"), F.lit("needs_review").alias("review_status"),
    )
    flag = (F.coalesce("name_rule_score", F.lit(0)) >= ACCEPT).cast("int")
    rules = candidate_rules(flag, F.coalesce("name_rule_score", F.lit(0)), F.col("review_status"), F.col("last_5_year_total"), F.col("affiliations"))
    asked = matched.withColumn("person_id", F.coalesce("person_id", F.xxhash64("normalized_name"))).withColumn("source_url", F.coalesce(F.try_element_at("paper_links", F.lit(1)), F.lit("")))
    return updated.unionByName(fresh, allowMissingColumns=True), rule_issues(asked, rules, ["person_id", "source_url"])


def accept_profiles(profiles: DataFrame, lexicon: Lexicon, name_score: Column, least: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Profiles with relevance and review status, and up to three issues for each.

    A profile needs review if its name score, its confidence or its relevance
    is in doubt. Rows whose name score is below `least` are left out only if it
    is given.
    """
    fields = {"department": ("department", 0.35), "title": ("title", 0.30), "research_interests": ("research_interests", 0.25), "biography": ("biography", 0.08), "publications": ("publications", 0.08)}
    scored = profiles.withColumns({"name_rule_score": name_score, "relevance": score_fields(fields, lexicon)})
    if least is not None:
        scored = scored.filter(F.col("name_rule_score") >= least)
    doubts = {
        "name_filter_uncertain": ("medium", F.col("name_rule_score") < ACCEPT, "name score in review band"),
        "low_confidence": ("medium", F.col("confidence_score") < SURE, "extraction confidence below threshold"),
        "discipline_uncertain": ("medium", F.col("relevance.status") == "needs_review", "relevance in review band"),
    }
    some = doubts["name_filter_uncertain"][1] | doubts["low_confidence"][1] | doubts["discipline_uncertain"][1]
    kept = scored.withColumn("review_status", F.when(some, "needs_review").otherwise("new"))
    return kept, rule_issues(kept, doubts, ["page_id", "url"])


def rescore(people: DataFrame, lexicon: Lexicon, fields: dict[str, tuple[str, float]]) -> tuple[DataFrame, DataFrame]:
    """All people with a new relevance score, and how many fall in each band."""
    scored = people.withColumn("__r", score_fields(fields, lexicon))
    scored = scored.withColumns({"discipline_score": F.col("__r.score"), "discipline_review_status": F.col("__r.status"), "discipline_is_relevant": F.col("__r.is_relevant").cast("int"), "discipline_reason": F.col("__r.reason")}).drop("__r")
    return scored, scored.groupBy("discipline_review_status").agg(F.count(F.lit(1)).alias("people"))


def add_issues(issues: DataFrame, new: DataFrame) -> DataFrame:
    """issues and the new rows after them, numbered on in the order of their contents; nothing is merged.

    Numbers are dealt in two levels (buckets of a hash of the row, then rows in
    a bucket), so every run gives the same ones and no task needs all rows.
    """
    last = issues.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("last"))
    own = F.struct(*(F.col(c) for c in new.columns))
    keyed = new.withColumn("bucket", F.pmod(F.xxhash64(F.to_json(own)), F.lit(ISSUE_BUCKETS)))
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    starts = sizes.withColumn("start", F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).drop("n")
    nth = F.row_number().over(Window.partitionBy("bucket").orderBy(F.to_json(own)))
    numbered = keyed.withColumn("nth", nth).join(F.broadcast(starts), "bucket").crossJoin(F.broadcast(last))
    rows = numbered.select(*new.columns, (F.col("last") + F.col("start") + F.col("nth")).cast("long").alias("seq"))
    return issues.unionByName(rows, allowMissingColumns=True)
