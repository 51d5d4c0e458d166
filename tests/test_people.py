from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.functions.lexicon import Lexicon
from tallyweave.operators import listings, people
from tallyweave.schemas import conform

PEOPLE = "id long, name string, normalized_name string, school string, primary_source_type string, paper_links array<string>, paper_titles array<string>, level_counts_json string, name_rule_score string, name_rule_reason string, confidence_score string, review_status string"
CANDIDATES = "name string, affiliations array<string>, last_5_year_total long, top_total long, a_plus_total long, level_counts_json string, paper_links array<string>, paper_titles array<string>, name_rule_score string, name_rule_reason string, review_status string"
LEX = Lexicon({"a": ["logistics"]}, strong=["logistics"])


def scored(df, *columns):
    return df.withColumns({c: F.col(c).cast("decimal(9,4)") for c in columns})


def test_merge_candidates(spark):
    store = scored(spark.createDataFrame([(1, "Ann", "ann", "S", "publication", [], [], "{}", "0.1", "", "0.5", "accepted"), (2, "ANN", "ann", "T", "official_site", [], [], "{}", "0.9", "kept", "0.5", "new")], PEOPLE), "name_rule_score", "confidence_score")
    rows = [("Ann", ["U"], 1, 0, 0, '{"A":1}', ["u1"], ["t1"], "0.6", "r", "needs_review"), ("Bo", [], 6, 1, 0, "{}", ["u2"], ["t2"], "0.8", "q", "strong_candidate")]
    after, raised = people.merge_candidates(store, scored(spark.createDataFrame(rows, CANDIDATES), "name_rule_score"))
    got = {r.name: r for r in after.collect()}
    assert (got["Ann"].review_status, got["Ann"].paper_links) == ("accepted", [])
    assert (got["ANN"].review_status, got["ANN"].paper_links, float(got["ANN"].name_rule_score), got["ANN"].name_rule_reason) == ("needs_review", ["u1"], 0.9, "kept")
    assert (float(got["Bo"].confidence_score), got["Bo"].review_status, got["Bo"].school) == (0.9, "needs_review", "")
    assert sorted((r.person_id == 2, r.issue_type) for r in raised.collect()) == [(False, "high_output_no_affiliation"), (False, "missing_affiliation"), (True, "publication_only_needs_review")]


def test_profiles_and_rescore(spark):
    rows = scored(spark.createDataFrame([(1, "u", "logistics", "logistics", "logistics", "", "", "0.9"), (2, "v", "", "", "", "logistics", "", "0.3")], "page_id long, url string, department string, title string, research_interests string, biography string, publications string, confidence_score string"), "confidence_score")
    kept, raised = people.accept_profiles(rows, LEX, F.when(F.col("page_id") == 1, 0.9).otherwise(0.5))
    assert {r.page_id: r.review_status for r in kept.collect()} == {1: "needs_review", 2: "needs_review"}
    assert sorted((r.page_id, r.issue_type) for r in raised.collect()) == [(1, "discipline_uncertain"), (2, "discipline_uncertain"), (2, "low_confidence"), (2, "name_filter_uncertain")]
    assert people.accept_profiles(rows, LEX, F.when(F.col("page_id") == 1, 0.9).otherwise(0.2), least=0.45)[0].count() == 1
    _, bands = people.rescore(rows, LEX, {"department": ("department", 0.8)})
    assert {r.discipline_review_status: r.people for r in bands.collect()} == {"needs_review": 1, "rejected": 1}


def test_lists(spark):
    seeds = conform(spark.createDataFrame([(2, "B", "u"), (None, "A", "u"), (1, "C", "u"), (3, "D", "")], "rank int, school_name_en string, homepage_url string"), "school_seeds")
    assert [r.school_name_en for r in listings.school_seeds(seeds).collect()] == ["C", "B", "A"]
    journals = conform(spark.createDataFrame([("z", "a+(top)"), ("y", "A1"), ("x", "A+")], "journal_name string, achievement_level string"), "journals")
    assert [r.journal_name for r in listings.journals(journals, limit=2).collect()] == ["z", "x"]
    links = conform(spark.createDataFrame([("a", "0.5", 1), ("b", "0.9", 2), ("c", "0.9", 3)], "url string, score string, seq long"), "candidate_links")
    assert [r.url for r in listings.candidate_links(links, limit=2).collect()] == ["b", "c"]
    pages = conform(spark.createDataFrame([("a", "<p>", "faculty_list"), ("b", "", "faculty_list"), ("c", "<p>", "other")], "url string, html string, page_type string"), "pages")
    assert [r.url for r in listings.pages_to_extract(pages).collect()] == ["a"]
    assert listings.pages_to_escalate(pages).count() == 2 and "html" not in listings.page_audit(pages).columns
    papers = conform(spark.createDataFrame([("t", "10.1/x", []), ("s", "", []), ("r", "10.1/y", ["U"])], "title string, doi string, affiliations array<string>"), "papers")
    assert [r.title for r in listings.papers_without_affiliation(papers).collect()] == ["t"]
    assert listings.people(conform(spark.createDataFrame([(1,)], "id long"), "people")).columns.count("source_url") == 1
    old = conform(spark.createDataFrame([("x", 4)], "issue_type string, seq long"), "review_issues")
    both = people.add_issues(old, old.drop("seq").filter("true"))
    assert sorted(r.seq for r in both.collect())[0] == 4 and both.count() == 2 and listings.issues(both, "open").count() == 2
