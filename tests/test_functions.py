from __future__ import annotations

from pyspark.sql import functions as F

from tallyweave.functions import text as T
from tallyweave.functions import urls as U
from tallyweave.functions.lexicon import Lexicon, NameRules, score_fields, score_name, score_text


def value(spark, c, schema="x string", row=(None,)):
    return spark.createDataFrame([row], schema).select(c.alias("v")).first().v


def test_text_keys(spark):
    rows = spark.createDataFrame([("  A  B\x1cß ",), (None,), ("",)], "x string")
    assert [r.v for r in rows.select(T.normalize_text("x").alias("v")).collect()] == ["a b ss", "", ""]
    assert value(spark, T.normalize_doi(F.lit(" https://doi.org/10.1/AB "))) == "10.1/ab"
    assert value(spark, T.extract_doi(F.lit("https://doi.org/10.1234/x.y?z"))) == "10.1234/x.y?z"
    assert value(spark, T.extract_doi(F.lit("nothing"))) is None
    assert value(spark, T.first_issn(F.lit("ISSN 1234-567x, 1111-2222"))) == "1234-567x"
    assert value(spark, T.split_pipe(F.lit(" a | b ||"))) == ["a", "b"]
    assert value(spark, T.distinct_folded(F.array(F.lit("Ab"), F.lit("aB"), F.lit(" c "), F.lit("")))) == ["Ab", "c"]


def test_json_guards(spark):
    assert value(spark, T.json_list(F.lit('["a", "b"]'))) == ["a", "b"]
    assert value(spark, T.json_list(F.lit('{"a": 1}'))) == []
    assert value(spark, T.json_map(F.lit("[1]"))) == {}
    assert value(spark, T.sorted_json(F.create_map(F.lit("b"), F.lit(1), F.lit("a"), F.lit(2)))) == '{"a":2,"b":1}'
    assert value(spark, T.safe_int(F.lit("12.0"))) == 12 and value(spark, T.safe_int(F.lit("x"))) is None


def test_levels(spark):
    rows = spark.createDataFrame([("A+(TOP)",), ("A+",), ("A",), ("A1",), ("A2",), ("B",), (None,)], "x string")
    assert [r.v for r in rows.select(T.level_key("x").alias("v")).collect()] == ["TOP", "A+", "A", "A1", "A2", "B", ""]


def test_venue_variants(spark):
    assert value(spark, T.venue_variants(F.lit("OMEGA-LONG NAME"))) == ["omega long name", "omega", "long name"]
    assert value(spark, T.normalize_venue_for_match(F.lit("Art &amp; Life"))) == "art and life"


def test_canonical_url(spark):
    cases = {
        "http://WWW.EX.EDU/f/a1/?b=2&a=1#bio": "https://www.ex.edu/f/a1/?a=1&b=2",
        "https://a.b//": "https://a.b/",
        "http://A.B:80": "https://a.b/",
        "mailto:x@y": "mailto:x@y",
        "": "",
        "https://a.b/x?k=&z": "https://a.b/x?k=&z=",
    }
    rows = spark.createDataFrame(list(cases.items()), "u string, w string")
    for r in rows.select("w", U.canonical_url("u").alias("v")).collect():
        assert r.v == r.w


def test_links(spark):
    assert value(spark, U.absolute_url(F.lit("/p/1"), F.lit("https://a.b/x/y"))) == "https://a.b/p/1"
    assert value(spark, U.absolute_url(F.lit("p/1"), F.lit("https://a.b/x/y"))) == "https://a.b/x/p/1"
    assert value(spark, U.same_site(F.lit("a.ex.edu"), F.lit("b.ex.edu"))) is True
    assert value(spark, U.classify_link(F.lit("https://a.b/login"), F.lit("Log in")))["kind"] == "noise"
    assert value(spark, U.classify_link(F.lit("https://a.b/people/jane"), F.lit("Professor Jane")))["kind"] == "faculty_candidate"


LEX = Lexicon({"a": ["supply chain", "logistics"], "b": ["analytics"]}, {"a": 0.4}, strong=["logistics"], hard_negatives=["poetry"])


def test_lexicon_bands(spark):
    rows = spark.createDataFrame([("logistics and supply chain", "analytics"), ("a logistic text", ""), ("poetry", ""), (None, None)], "t string, u string")
    got = [r.s for r in rows.select(score_fields({"t": ("t", 0.35), "u": ("u", 0.30)}, LEX, accept=0.6).alias("s")).collect()]
    assert got[0].status == "accepted" and got[0].is_relevant and "logistics" in got[0].reason
    assert [g.status for g in got[1:]] == ["rejected"] * 3 and float(got[3].score) == 0
    one = [r.s for r in rows.select(score_text(["t"], LEX).alias("s")).collect()]
    assert float(one[0].score) == 0.34 and one[2].status == "rejected"


def test_name_rules(spark):
    rules = NameRules(tokens=["kim"], stop_tokens=["bot"], token_shape="^[a-z]{2,6}$", script="[\\u4e00-\\u9fff]")
    rows = spark.createDataFrame([("Kim Lee",), ("bot kim",), ("王",), ("",)], "n string")
    got = [r.s for r in rows.select(score_name("n", rules).alias("s")).collect()]
    assert [float(g.score) for g in got] == [0.70, 0.05, 0.98, 0.0]
    assert [g.flag for g in got] == [1, 0, 1, 0]


def test_sql_function(spark):
    T.register_sql_functions(spark)
    assert spark.sql("SELECT normalize_text_for_join('  A   b ') AS v").first().v == "a b"
