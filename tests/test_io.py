from __future__ import annotations

from tallyweave.sources import readers, writers
from tallyweave.streaming.upserts import stream_upserts


def test_journals_and_seeds(spark, tmp_path):
    (tmp_path / "j.csv").write_text("﻿期刊名称,学校级别\n Omega ,A+\n,A\n", encoding="utf-8")
    assert [(r.journal_name, r.achievement_level, r.issn_cn) for r in readers.journals(spark, str(tmp_path / "j.csv")).collect()] == [("Omega", "A+", "")]
    (tmp_path / "s.csv").write_text("rank,school_name_en\n1,A\nx,B\n3,\n")
    assert [(r["rank"], r.school_name_en) for r in readers.school_seeds(spark, str(tmp_path / "s.csv"), limit=2).collect()] == [(1, "A"), (None, "B")]


def test_row_pairs(spark):
    rows = spark.createDataFrame([("s", 0, "Rank", "Name", "", "", "", ""), ("s", 1, "1", "Zh1", "", "", "", ""), ("s", 2, "", "En1", "u1", "2", "", ""), ("s", 3, "2", "Zh2", "", "", "", ""), ("s", 4, "", "En1", "u2", "", "", "")], "block string, row_idx int, c0 string, c1 string, c2 string, c3 string, c4 string, c5 string")
    assert [(r["rank"], r.school_name_zh, r.school_name_en, r.homepage_url) for r in readers.pair_rows(rows).collect()] == [("1", "Zh1", "En1", "u1")]


def test_round_trip_and_missing_export(spark, tmp_path):
    (tmp_path / "e.csv").write_text("school,entry_url,status\nS,https://a.b/,\n,x,new\n")
    entry = readers.school_entrypoints(spark, str(tmp_path / "e.csv"))
    assert [r.status for r in entry.collect()] == ["new"]
    assert writers.export(entry, "school_entrypoints", str(tmp_path / "out")) == 1
    assert readers.school_entrypoints(spark, str(tmp_path / "out")).select("school", "entry_url").first() == ("S", "https://a.b/")
    assert readers.export(spark, str(tmp_path / "none.csv"), ["id", "name"]).count() == 0


def test_decisions_file(spark, tmp_path):
    (tmp_path / "d.csv").write_text("person_id,review_decision,review_decision_note,resolved_issue_types\n1,Approved,,a | b\n2,,,\nx,rejected,,\n")
    got = readers.decisions(spark, str(tmp_path / "d.csv")).collect()
    assert [(r.person_id, r.review_decision, r.resolved_issue_types) for r in got] == [(1, "accepted", ["a", "b"])]


def test_rosters_in_one_pass(spark, tmp_path):
    rows = spark.createDataFrame([(1, "confirmed"), (2, "rejected"), (3, "confirmed")], "id long, roster string")
    assert writers.export_rosters(rows, str(tmp_path / "r"), ["id"]) == {"confirmed": 2, "deferred": 0, "rejected": 1}


def test_stream_of_upserts(spark, tmp_path):
    schema = "source_type string, name string, base_url string, seq long"
    feed = tmp_path / "in"
    paths = []
    for k, rows in enumerate([[("a", "x", "u1", 1), ("a", "y", "u2", 2)], [("a", "x", "u3", 3)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(feed))
        query = stream_upserts(spark.readStream.schema(schema).parquet(str(feed)), "sources", str(tmp_path / "out"), str(tmp_path / "cp"), paths.append)
        query.awaitTermination(120)
    assert {(r.name, r.base_url) for r in spark.read.parquet(paths[-1]).collect()} == {("x", "u3"), ("y", "u2")}


def test_exports_keep_the_surveyed_columns(spark, tmp_path):
    people = spark.createDataFrame([(1, "A", "graphs", "2024")], "id long, name string, research_direction string, updated_at string")
    writers.export(people, "people", str(tmp_path / "people"))
    row = spark.read.option("header", True).csv(str(tmp_path / "people")).first()
    assert (row.research_direction, row.updated_at) == ("graphs", "2024")
    assert {"created_at", "resolved_at"} <= set(writers.EXPORTS["issues"]) and {"raw_html_path", "fetched_at"} <= set(writers.EXPORTS["pages"])
    assert {"discipline_reason", "open_issue_source_urls"} <= set(writers.EXPORTS["people_review"]) and {"pub_journals", "resolved_issue_types"} <= set(writers.EXPORTS["review_queue"])


def test_exports_have_their_exact_headers(spark, tmp_path):
    assert {k: len(v) for k, v in writers.EXPORTS.items()} == {"papers": 17, "candidates": 14, "people_candidates": 20, "quality_report": 11, "people": 36, "pages": 13, "issues": 11, "people_review": 28, "review_queue": 42, "gap_report": 6, "school_seeds": 7, "school_entrypoints": 11}
    rows = spark.createDataFrame([(7, "T", ["a", "b"], [("n",)])], "seq long, title string, affiliations array<string>, authors array<struct<name: string>>")
    writers.export(rows, "papers", str(tmp_path / "papers"))
    r = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "papers")).first()
    assert (r.id, r.title, r.affiliations_json, r.authors_json) == ("7", "T", '["a","b"]', '[{"name":"n"}]')


def test_outputs_of_a_run(spark, tmp_path):
    items = spark.createDataFrame([(4, "Omega"), (5, "Alpha")], "run_id long, journal_name string")
    journals = spark.createDataFrame([("Omega", "A+"), ("Alpha", "A1")], "journal_name string, achievement_level string")
    papers = spark.createDataFrame([("Omega", "openalex", "x", ["u"]), ("Alpha", "crossref", "", [])], "journal string, source string, first_author_name string, affiliations array<string>")
    candidates = spark.createDataFrame([("A", "Omega", 0.9), ("B", "Alpha", 0.1)], "name string, journal string, name_rule_score double")
    issues = spark.createDataFrame([("publication_source_error", "no papers for omega")], "issue_type string, message string")
    got = writers.export_run(4, items, journals, papers, candidates, candidates, issues, str(tmp_path))
    assert got == {"papers": 2, "publication_candidates": 2, "publication_candidates_named": 1, "publication_people_candidates": 2, "publication_quality_report": 2, "publication_quality_report_4": 1}
    assert writers.finished_run(spark, str(tmp_path)) == (4, got)
    r = spark.read.option("header", True).csv(str(tmp_path / "publication_quality_report_4")).first()
    assert (r.journal, r.achievement_level, r.openalex_count, r.source_errors) == ("Omega", "A+", "1", "1")


def test_a_run_that_breaks_off_has_no_manifest(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    items = spark.createDataFrame([(4, "Omega")], "run_id long, journal_name string")
    journals = spark.createDataFrame([("Omega", "A+")], "journal_name string, achievement_level string")
    papers = spark.createDataFrame([("t", "Omega", "openalex", "x", ["u"])], "title string, journal string, source string, first_author_name string, affiliations array<string>")
    candidates = spark.createDataFrame([("A", "Omega", 0.9)], "name string, journal string, name_rule_score double")
    issues = spark.createDataFrame([("publication_source_error", "no papers for omega")], "issue_type string, message string")
    frames = (items, journals, papers, candidates, candidates)
    writers.export_run(4, *frames, issues, str(tmp_path))
    broken = candidates.withColumn("name", F.raise_error(F.lit("broken")).cast("string"))
    try:
        writers.export_run(5, *frames[:4], broken, issues, str(tmp_path))
    except Exception as error:
        assert "broken" in str(error)
    assert writers.finished_run(spark, str(tmp_path)) is None


def test_seq_does_not_depend_on_splits(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for k in range(7):
        (folder / f"part-{k}.csv").write_text("a,b\n" + "".join(f"{k}-{i},\"x\ny\"\n" for i in range(k)))
    want = {f"{k}-{i}": sum(range(k)) + i for k in range(7) for i in range(k)}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("1", "40", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = readers.read_csv(spark, str(folder))
            assert rows.columns == ["a", "b", "seq"] and {r.a: r.seq for r in rows.collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_sorted_exports(spark, tmp_path):
    rows = spark.range(500).selectExpr("id", "id AS seq", "cast(id * 37 % 10 AS decimal(9,4)) AS priority_score", "concat('n', id) AS name", "concat('s', id % 7) AS school").repartition(6)
    import csv
    import glob

    def read(name):
        out = []
        for path in sorted(glob.glob(f"{tmp_path}/{name}/part-*.csv")):
            with open(path, newline="") as file:
                out += list(csv.DictReader(file))
        return out

    assert writers.export(rows, "review_queue", f"{tmp_path}/review_queue") == 500
    queue = [(-float(r["priority_score"]), int(r["person_id"])) for r in read("review_queue")]
    assert queue == sorted(queue) and len(queue) == 500
    assert writers.export(rows, "people", f"{tmp_path}/people") == 500
    people = [(r["school"], r["name"], int(r["id"])) for r in read("people")]
    assert people == sorted(people) and len(people) == 500
