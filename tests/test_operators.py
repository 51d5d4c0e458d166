from __future__ import annotations

import random

from pyspark.sql import functions as F

from tallyweave.operators import evidence, papers, review, runs
from tallyweave.operators import upsert as U
from tallyweave.schemas import add_missing, conform


def test_upsert_against_a_fold(spark):
    """The aggregation gives what applying changes one by one gives, however rows are dealt."""
    rng = random.Random(5)
    rows = [(rng.choice("abcd"), rng.choice(["", "x", "y"]), rng.choice(["s1", "s2", "s3"]), rng.randint(0, 9), i) for i in range(120)]
    want: dict = {}
    for k, doi, source, n, _ in rows:
        w = want.setdefault(k, {"doi": "", "source": [], "first": n, "last": n, "top": n})
        w["doi"] = doi or w["doi"]
        w["source"] += [source] * (source not in w["source"])
        w["last"], w["top"] = n, max(n, w["top"])
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, doi string, source string, n int, seq long").withColumns({"first": F.col("n"), "last": F.col("n"), "top": F.col("n")}).drop("n")
    got = U.upsert(None, df.repartition(5), ["k"], {"doi": U.last_nonempty, "source": U.ordered_set, "first": U.first, "top": U.largest})
    assert {r.k: {"doi": r.doi, "source": r.source.split(","), "first": r.first, "last": r["last"], "top": r.top} for r in got.collect()} == want


def test_upsert_null_keys_stay_apart(spark):
    rows = spark.createDataFrame([("t", None, "a", 1), ("t", None, "b", 2), ("t", 2020, "a", 3), ("t", 2020, "b", 4)], "title string, year int, doi string, seq long")
    assert U.upsert(None, rows, ["title", "year"], {}, null_keys_differ=True).count() == 3


def test_upsert_table_twice_is_stable(spark):
    rows = conform(spark.createDataFrame([("J", "1", 1), ("K", "2", 2)], "normalized_journal_name string, issn_cn string, seq long"), "journals")
    once = U.upsert_table("journals", None, rows)
    assert U.upsert_table("journals", once, rows).count() == once.count() == 2


def test_insert_or_ignore_and_patch(spark):
    target = spark.createDataFrame([("a", "old", 1)], "k string, v string, seq long")
    changes = spark.createDataFrame([("a", "new", 2), ("b", "first", 3), ("b", "second", 4)], "k string, v string, seq long")
    assert {r.k: r.v for r in U.insert_or_ignore(target, changes, ["k"]).collect()} == {"a": "old", "b": "first"}
    assert {r.k: r.v for r in U.patch(target, changes, ["k"], ["v"]).collect()} == {"a": "new"}


def test_collapse_fills_and_keeps_the_best(spark):
    rows = spark.createDataFrame(
        [(1, "n", "mail", "", "0.5", "accepted"), (2, "n", "", "tel", "0.9", "needs_review"), (3, "m", "", "", "0.1", "accepted")],
        "id long, key string, email string, phone string, conf string, status string",
    ).withColumn("conf", F.col("conf").cast("decimal(9,4)"))
    out = {r.key: r for r in U.collapse(rows, ["key"], [F.col("conf")], ["email", "phone"], ["conf"], {"status": "needs_review"}).collect()}
    assert (out["n"].id, out["n"].email, out["n"].phone, out["n"].status, out["n"].merged_ids) == (2, "mail", "tel", "needs_review", [1])
    assert out["m"].merged_ids == []


PAPER = f"title string, journal string, year int, doi string, url string, first_author_name string, corresponding_author_names array<string>, affiliations array<string>, authors {papers.AUTHOR_LIST}"


def paper(title, first, corr=(), affs=(), authors=(), doi="", journal="J"):
    return (title, journal, 2024, doi, "u", first, list(corr), list(affs), [(n, "", "", "", False, list(a)) for n, a in authors])


def test_author_roles(spark):
    rows = spark.createDataFrame([paper("t", "Ann", ["Ann", "Bob", ""], ["P"], [("Ann", ["A"]), ("Bob", [])])], PAPER)
    got = {(r.name, r.author_role): r.affiliations for r in papers.author_roles(rows).collect()}
    assert got == {("Ann", papers.FIRST): ["A"], ("Bob", papers.CORRESPONDING): ["P"]}


def test_roll_up_counts_and_lists(spark):
    rows = spark.createDataFrame(
        [("Ann B", papers.FIRST, "A+(TOP)", "t1", "J1", 2020, "u1", ["X"], "0.5", "r1", 1), ("ann  b", papers.CORRESPONDING, "A1", "t2", "J1", 2021, "u2", ["Y", "X"], "0.8", "r2", 2)],
        "name string, author_role string, achievement_level string, title string, journal string, year int, paper_url string, affiliations array<string>, name_rule_score string, name_rule_reason string, seq long",
    ).withColumn("name_rule_score", F.col("name_rule_score").cast("decimal(9,4)"))
    r = papers.roll_up(rows).first()
    assert (r.name, r.last_5_year_total, r.first_author_total, r.top_total, r.a_plus_total, r.a1_total) == ("Ann B", 2, 1, 1, 1, 1)
    assert (r.level_counts_json, r.affiliations, r.paper_links, r.name_rule_reason, r.review_status) == ('{"A1":1,"TOP":1}', ["X", "Y"], ["u1", "u2"], "r2", "strong_candidate")


def test_merge_affiliations(spark):
    rows = spark.createDataFrame([paper("t", "A", authors=[("A", []), ("B", ["b"])])], PAPER)
    names = F.array(F.lit("A"), F.lit("B"))

    def filled(*affs):
        return [list(a.affiliations) for a in rows.select(papers.merge_affiliations(F.col("authors"), names, F.array(*map(F.lit, affs))).alias("m")).first().m]

    assert filled("x", "y") == [["x"], ["b"]]
    assert filled("x", "y", "z") == [["x", "y", "z"], ["b"]]


def test_backfill(spark):
    rows = spark.createDataFrame([paper("t", "A", doi="10.1/x", authors=[("A", [])]), paper("s", "B", affs=["own"], doi="10.1/x")], PAPER)
    works = spark.createDataFrame([("https://doi.org/10.1/X", [("A", "", "", "", False, ["Uni"])], ["Uni"])], f"doi string, authors {papers.AUTHOR_LIST}, affiliations array<string>")
    got = {r.title: r.affiliations for r in papers.backfill_affiliations(rows, works).collect()}
    assert got == {"t": ["Uni"], "s": ["own"]}
    landing = spark.createDataFrame([("10.1/x", ["A"], ["Page", "page"])], "doi string, authors array<string>, affiliations array<string>")
    got = {r.title: r.affiliations for r in papers.backfill_affiliations(rows, works.limit(0), landing).collect()}
    assert got == {"t": ["Page"], "s": ["own"]}


def test_works_and_items(spark, tmp_path):
    (tmp_path / "w.json").write_text(
        '{"id":"W1","doi":"https://doi.org/10.1/A","title":" T ","publication_year":2023,"primary_location":{"landing_page_url":"","source":{"display_name":""}},'
        '"authorships":[{"author_position":"last","is_corresponding":true,"author":{"id":"a2","display_name":"Bo"},"institutions":[{"display_name":"U"}]},{"author_position":"first","author":{"id":"a1","display_name":"Al"},"institutions":[{"display_name":"U"},{"display_name":"V"}]}]}\n'
    )
    r = papers.papers_from_works(spark.read.schema(papers.WORK).json(str(tmp_path / "w.json")), "Fallback").first()
    assert (r.title, r.journal, r.doi, r.first_author_name, r.corresponding_author_names, r.affiliations) == ("T", "Fallback", "10.1/a", "Al", ["Bo"], ["U", "V"])
    (tmp_path / "i.json").write_text(
        '{"title":["X","Y"],"container-title":["J"],"DOI":"10.2/B","author":[{"given":"Al","family":"Bo","sequence":"first","ORCID":"o","affiliation":[{"name":"U"}]},{"name":"Group"}],"issued":{"date-parts":[[2021,2]]}}\n'
    )
    r = papers.papers_from_items(spark.read.schema(papers.ITEM).json(str(tmp_path / "i.json"))).first()
    assert (r.title, r.year, r.url, r.first_author_name, [a.name for a in r.authors], r.authors[0].is_corresponding, r.corresponding_author_names) == ("X Y", 2021, "https://doi.org/10.2/B", "Al Bo", ["Al Bo", "Group"], True, [])


def test_venue_match_and_collect(spark):
    journals = spark.createDataFrame([("OMEGA-LONG NAME", "A"), ("Silent Journal", "A1")], "journal_name string, achievement_level string")
    works = spark.createDataFrame([("Omega", 2023, "openalex"), ("Omega", 2001, "openalex"), ("Science", 2023, "crossref")], "journal string, year int, source string")
    found, issues = papers.collect_papers(works, journals, 2020, 2024)
    assert [(r.journal, r.year) for r in found.collect()] == [("OMEGA-LONG NAME", 2023)]
    assert issues.count() == 3


def test_attribution_prefers_order(spark):
    names = spark.createDataFrame([("Science", 2), ("Management Science", 1)], "journal_name string, o int")
    rows = spark.createDataFrame([("no rows: MANAGEMENT  science!",), ("science failed",), ("none",)], "message string")
    for size in (papers.DIMENSION_BYTES, 150):
        old, papers.DIMENSION_BYTES = papers.DIMENSION_BYTES, size
        got = {r.message: r.attributed for r in papers.attribute(rows, names, "message", "journal_name", "o").collect()}
        papers.DIMENSION_BYTES = old
        assert got == {"no rows: MANAGEMENT  science!": "Management Science", "science failed": "Science", "none": None}


def test_attribution_inside_words(spark):
    names = spark.createDataFrame([("Science", 3), ("Art History", 1), ("journal", 4), ("io", 5), ("Mart", 2), ("%", 0)], "journal_name string, o int")
    want = {"bioscience journal": "Science", "smart history today": "Art History", "the smarter set": "Mart", "a radio": "io", "x": None, None: None}
    rows = spark.createDataFrame([(m,) for m in want], "message string")
    for size in (papers.DIMENSION_BYTES, 150):
        old, papers.DIMENSION_BYTES = papers.DIMENSION_BYTES, size
        try:
            got = {r.message: r.attributed for r in papers.attribute(rows, names, "message", "journal_name", "o").collect()}
        finally:
            papers.DIMENSION_BYTES = old
        assert got == want


def test_evidence_rules(spark):
    rows = spark.createDataFrame(
        [
            (1, "school", "New", "semantic_scholar", 0.9, "Old", "crossref", ""), (1, "school", "Weak", "crossref", 0.99, "Old", "crossref", ""), (1, "school", "Same", "semantic_scholar", 0.9, "Same", "crossref", ""),
            (2, "school", "X", "semantic_scholar", 0.9, "", "", "official_site"), (3, "title", "T", "crossref", 0.5, "", "", ""), (4, "title", "Weaker", "crossref", 0.9, "Strong", "semantic_scholar", ""),
        ],
        "person_id long, field string, new_value string, source string, confidence double, current_value string, current_source string, current_primary_source string",
    )
    got = {(r.person_id, r.field): r for r in evidence.merge(rows).collect()}
    assert set(got) == {(1, "school"), (3, "title")}
    assert got[1, "school"].value == "New" and got[1, "school"].n_values == 2 and not got[1, "school"].requires_review
    assert got[3, "title"].requires_review
    people = spark.createDataFrame([(1, "Old", "", "accepted"), (3, "", "", "new")], "id long, school string, title string, review_status string").withColumn("confidence_score", F.lit("0.1").cast("decimal(9,4)"))
    out = {r.id: r for r in evidence.apply_updates(people, evidence.merge(rows), ["school", "title"]).collect()}
    assert (out[1].school, out[1].school_source, out[1].review_status, out[3].title, out[3].review_status) == ("New", "semantic_scholar", "accepted", "T", "needs_review")


def test_tiers_and_roster(spark):
    rows = spark.createDataFrame([("9",), ("8",), ("7.9",), ("5",), ("2",), ("1.9",)], "s string").select(review.tier(F.col("s").cast("decimal(9,4)")).alias("t"))
    assert [r.t for r in rows.collect()] == ["high", "high", "medium", "medium", "low", "deferred"]
    people = spark.createDataFrame([(1, "approved"), (2, "accepted"), (3, "new"), (4, "rejected"), (5, "needs_review")], "id long, review_status string")
    assert sorted((r.id, r.roster) for r in review.rosters(people).collect()) == [(1, "confirmed"), (2, "confirmed"), (4, "rejected"), (5, "deferred")]


def test_write_back_is_idempotent(spark):
    people = spark.createDataFrame([(1, "new", "", ""), (2, "new", "", "")], "id long, review_status string, review_decision string, review_decision_note string")
    issues = spark.createDataFrame([(1, "a", "open"), (1, "b", "open"), (2, "a", "open")], "person_id long, issue_type string, status string")
    entered = spark.createDataFrame([(1, "Approved ", "", "a", 1), (1, "", "note", "", 2), (2, "", "", "", 3)], "person_id long, review_decision string, review_decision_note string, resolved_issue_types string, seq long")
    decisions = review.read_decisions(entered)
    once = review.write_back(people, issues, decisions)
    twice = review.write_back(*once, decisions)
    for people_, issues_ in (once, twice):
        assert {r.id: (r.review_status, r.review_decision_note) for r in people_.collect()} == {1: ("accepted", "note"), 2: ("new", "")}
        assert {(r.person_id, r.issue_type): r.status for r in issues_.collect()} == {(1, "a"): "resolved", (1, "b"): "open", (2, "a"): "open"}


def test_runs_resume(spark):
    runs_ = spark.createDataFrame([(1, "g", "completed"), (2, "g", "partial"), (3, "h", "created")], "id long, journal_group string, status string")
    assert [r.id for r in runs.latest_resumable(runs_, journal_group="g").collect()] == [2]
    items = spark.createDataFrame([(2, 10, "A", "completed", 1, 5, 5, ""), (2, 11, "B", "pending", 0, 0, 0, ""), (2, 12, "C", "pending", 0, 0, 0, "")], "run_id long, journal_id long, journal_name string, status string, attempts int, papers_seen int, papers_saved int, last_error string")
    works = spark.createDataFrame([(10, "openalex"), (11, "openalex"), (11, "openalex")], "journal_id long, source string")
    journals = spark.createDataFrame([(10, "A"), (11, "B"), (12, "C")], "id long, journal_name string")
    got, after = runs.run_batch(items, works, journals, 2, ["openalex", "crossref"])
    assert got.count() == 2
    state = {r.journal_id: (r.status, r.attempts, r.papers_seen) for r in after.collect()}
    assert state == {10: ("completed", 1, 5), 11: ("completed", 1, 2), 12: ("failed", 1, 0)}
    assert runs.run_status(after).first().run_status == "partial"


def test_schema_evolution(spark):
    df = spark.createDataFrame([(1,)], "id long")
    assert add_missing(df, status=("string", "new"), id=("long", 0)).first().asDict() == {"id": 1, "status": "new"}
    assert conform(df, "people").first().review_status == "new"


def test_stored_snapshots(spark, tmp_path):
    """Only parts with a changed key are written, and the result equals that of a full rewrite."""
    import os

    from tallyweave.operators import upsert

    def files():
        return {(d, f) for d, _, names in os.walk(tmp_path / "s") for f in names if f.endswith(".parquet")}

    path, schema = str(tmp_path / "s"), "k long, a string, b string, seq long"
    policies = {"a": upsert.last_nonempty, "b": upsert.first}
    first = spark.createDataFrame([(i, f"a{i}", f"b{i}", i) for i in range(300)] + [(None, "n", "n", 300)], schema)
    assert upsert.upsert_stored(path, first, ["k"], policies, parts=16) == 16
    whole = upsert.upsert(None, first, ["k"], policies)
    for rows in ([(5, "", "new", 400), (7, "x", "y", 401), (5, "z", None, 402)], [(None, "m", "m", 403), (1000, "new", "new", 404)], []):
        changes = spark.createDataFrame(rows, schema)
        before = files()
        written = upsert.upsert_stored(path, changes, ["k"], policies, parts=999)
        gone = {d for d, _ in before - files()}
        assert len(gone) == written <= 2
        whole = upsert.upsert(whole, changes, ["k"], policies)
        rows = lambda df: sorted(map(str, df.select("k", "a", "b", "seq").collect()))
        assert rows(upsert.read_stored(spark, path)) == rows(whole)
    assert upsert.stored_parts(spark, path) == 16 and upsert.stored_parts(spark, str(tmp_path / "none")) is None
