"""Review queues, gap reports, rosters, and the write-back of decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_text, is_blank, safe_double, split_pipe, text_or_empty

#: Weight of an issue type in the priority; others weigh 1 (fixed values).
SEVERITY = {
    "high_output_no_affiliation": 10,
    "missing_affiliation": 8,
    "low_confidence": 7,
    "name_filter_uncertain": 6,
    "publication_only_needs_review": 5,
    "weak_name_score": 4,
    "llm_used": 2,
}
TIERS = ((8.0, "high"), (5.0, "medium"), (2.0, "low"))
GAPS = ("gap_missing_school", "gap_missing_homepage", "gap_missing_email", "gap_low_confidence", "gap_name_conflict", "gap_discipline_uncertain", "gap_high_output_no_affiliation")
CONFIDENT, RELEVANT = 0.6, 0.5
#: Label, severity and advice of each category of the gap report, in its order (fixed values of the file format).
GAP_TEXTS = {
    "missing_school": ("机构缺失", "high", "补强机构信息：优先通过论文作者页、ORCID、Semantic Scholar 查找机构"),
    "missing_homepage_email": ("homepage/email 缺失", "medium", "通过官网或 LinkedIn 补全 contact 信息，P12 优先级处理"),
    "low_confidence": ("低置信度", "medium", "低置信度记录人工复核时优先确认身份唯一性，避免同名误归并"),
    "name_conflict": ("同名冲突", "high", "同名冲突需人工确认是否为同一人，避免错误合并"),
    "discipline_uncertain": ("学科不确定", "medium", "学科评分低于 0.5 且状态为 needs_review 需人工确认相关性"),
    "source_errors": ("数据质量问题", "medium", "高/中严重度数据问题优先修复，尤其是 affiliation 相关问题"),
    "abstract_missing": ("abstract 缺失", "low", "如需 abstract 字段，后续可从 Crossref 或 Semantic Scholar 补充"),
}


def decimal(x: float | str) -> Column:
    return F.lit(str(x)).cast("decimal(9,4)")


def severity_weight(issue_type: Column) -> Column:
    out = F.lit(1)
    for name, weight in SEVERITY.items():
        out = F.when(issue_type == name, weight).otherwise(out)
    return out


def issue_buckets(issues: DataFrame, seq: str = "seq") -> DataFrame:
    """For each person the open issues as lists, and the types that were resolved.

    Lists hold distinct values in order of arrival; open_types keeps repeats,
    as distinct (type, count), so that a flood of issues stays small.
    """
    owned = issues.filter("person_id is not null")
    columns = {"issue_type": "open_issue_types", "severity": "open_severities", "message": "open_messages"}
    flat = owned.select("person_id", "status", seq, F.explode(F.array(*(F.struct(F.lit(k).alias("k"), clean_text(k).alias("v")) for k in columns))).alias("x"))
    distinct = flat.filter("x.v != ''").groupBy("person_id", "status", "x.k", "x.v").agg(F.min(seq).alias("at"), F.count(F.lit(1)).alias("n"))

    def listed(status: str, kind: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.when((F.col("status") == status) & (F.col("k") == kind), F.struct("at", "v")))), lambda x: x["v"])

    weight = F.when((F.col("status") == "open") & (F.col("k") == "issue_type"), F.col("n") * severity_weight(F.col("v"))).otherwise(0)
    return distinct.groupBy("person_id").agg(
        *(listed("open", k).alias(name) for k, name in columns.items()),
        listed("resolved", "issue_type").alias("resolved_issue_types"),
        F.sum(weight).alias("open_weight"),
        F.sum(F.when((F.col("status") == "open") & (F.col("k") == "issue_type"), F.col("n")).otherwise(0)).alias("open_issues"),
    )


def with_issues(people: DataFrame, buckets: DataFrame, id_column: str = "id") -> DataFrame:
    lists = [c for c in buckets.columns if c not in ("person_id", "open_weight", "open_issues")]
    joined = people.join(buckets.withColumnRenamed("person_id", "__person"), people[id_column] == F.col("__person"), "left").drop("__person")
    empty = F.array().cast("array<string>")
    return joined.withColumns({c: F.coalesce(c, empty) for c in lists} | {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("open_weight", "open_issues")})


def priority(confidence: Column, weight: Column, no_school: Column, no_homepage: Column, no_email: Column, accepted: Column) -> Column:
    """max(0, 10 * confidence - weight / 2 - 2, 1 and 1.5 for what is missing - 1.5 unless accepted)."""
    minus = lambda c, x: F.when(c, decimal(x)).otherwise(decimal(0))
    raw = decimal(10) * confidence.cast("decimal(9,4)") - decimal(0.5) * weight.cast("decimal(9,0)")
    return F.greatest(decimal(0), raw - minus(no_school, 2) - minus(no_homepage, 1) - minus(no_email, 1.5) - minus(~accepted, 1.5))


def tier(score: Column) -> Column:
    out = F.lit("deferred")
    for least, name in reversed(TIERS):
        out = F.when(score >= least, name).otherwise(out)
    return out


def relevance_uncertain() -> Column:
    return (text_or_empty("discipline_review_status") == "needs_review") & (safe_double(F.col("discipline_score").cast("string")) < RELEVANT)


def gap_flags(open_types: Column, confidence: Column) -> dict[str, Column]:
    flags = (
        is_blank("school"), is_blank("personal_homepage"), is_blank("email"), confidence < CONFIDENT,
        F.array_contains(open_types, "name_filter_uncertain"), relevance_uncertain(), F.array_contains(open_types, "high_output_no_affiliation"),
    )
    return {name: flag.cast("int") for name, flag in zip(GAPS, flags, strict=True)}


def review_queue(people: DataFrame, issues: DataFrame, id_column: str = "id") -> DataFrame:
    """People with their open issues, priority, tier and gap flags; `queue_order` sorts it."""
    rows = with_issues(people, issue_buckets(issues), id_column)
    confidence = safe_double(F.col("confidence_score").cast("string")).cast("decimal(9,4)")
    score = priority(confidence, F.col("open_weight"), is_blank("school"), is_blank("personal_homepage"), is_blank("email"), text_or_empty("discipline_review_status") == "accepted")
    scored = rows.withColumns({"priority_score": score} | gap_flags(F.col("open_issue_types"), confidence))
    return scored.withColumns({"tier": tier(F.col("priority_score")), "priority_shown": F.round("priority_score", 3)})


def queue_order(queue: DataFrame, seq: str = "seq") -> DataFrame:
    return queue.orderBy(F.desc("priority_score"), seq)


def gap_report(people: DataFrame, issues: DataFrame, seq: str = "seq") -> DataFrame:
    """Seven rows: category, count and up to three examples in input order.

    One pass over people and one over issues; an example is a running minimum,
    so nothing is collected.
    """
    confidence = safe_double(F.col("confidence_score").cast("string"))
    copies = people.filter(~is_blank("name")).groupBy(F.lower(F.trim("name")).alias("n"), F.lower(F.trim(text_or_empty("school"))).alias("s")).agg(F.count(F.lit(1)).alias("k"), F.min(seq).alias(seq), F.min("name").alias("name")).filter("k > 1")
    tests = [
        ("missing_school", people, [is_blank("school")]),
        ("missing_homepage_email", people, [is_blank("personal_homepage"), is_blank("email")]),
        ("low_confidence", people, [confidence < CONFIDENT]),
        ("name_conflict", copies, [F.lit(True)]),
        ("discipline_uncertain", people, [relevance_uncertain()]),
        ("source_errors", issues.withColumn("name", F.concat_ws(": ", "issue_type", F.substring(text_or_empty("message"), 1, 40))), [F.col("severity").isin("high", "medium")]),
    ]
    out = None
    for k, (category, rows, conditions) in enumerate(tests, 1):
        met = F.greatest(*(c.cast("int") for c in conditions), F.lit(0)) == 1
        count = sum((F.count_if(c) for c in conditions), F.lit(0))
        counted = rows.agg(count.cast("long").alias("count"))
        examples = rows.filter(met).orderBy(seq, "name").limit(3).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(seq, F.col("name").alias("t")))), lambda x: x["t"]), "; ").alias("examples"))
        row = counted.crossJoin(examples).select(F.lit(k).alias("position"), F.lit(category).alias("category"), "count", F.coalesce("examples", F.lit("")).alias("examples"))
        out = row if out is None else out.unionByName(row)
    stub = people.sparkSession.range(1).select(F.lit(7).alias("position"), F.lit("abstract_missing").alias("category"), F.lit(0).cast("long").alias("count"), F.lit("").alias("examples"))
    return out.unionByName(stub)


def gap_texts(report: DataFrame) -> DataFrame:
    """A gap report with the label, severity and advice of each category, as it is exported."""
    told = F.create_map(*(F.lit(x) for k, v in GAP_TEXTS.items() for x in (k, "\x1f".join(v))))
    parts = F.split(told[F.col("category")], "\x1f")
    return report.withColumns({"gap_category_label": parts[0], "severity": parts[1], "recommendation": parts[2]})


def rosters(people: DataFrame) -> DataFrame:
    """People with the roster that each belongs to; new ones belong to none."""
    status = F.lower(text_or_empty("review_status"))
    name = F.when(status.isin("accepted", "approved"), "confirmed").when(status == "needs_review", "deferred").when(status == "rejected", "rejected")
    return people.withColumn("roster", name).filter("roster is not null")


def read_decisions(rows: DataFrame) -> DataFrame:
    """Decisions as entered: lower case, `approved` read as accepted, types split; empty rows are left out."""
    decision = F.lower(F.trim(text_or_empty("review_decision")))
    out = rows.withColumns({
        "review_decision": F.when(decision == "approved", "accepted").otherwise(decision),
        "review_decision_note": F.trim(text_or_empty("review_decision_note")),
        "resolved_issue_types": split_pipe("resolved_issue_types"),
    })
    return out.filter("review_decision != '' or review_decision_note != '' or size(resolved_issue_types) > 0")


def write_back(people: DataFrame, issues: DataFrame, decisions: DataFrame, id_column: str = "id", seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """People and issues after the decisions; several for a person apply in order of seq."""
    said = F.col("review_decision") != ""
    noted = F.col("review_decision_note") != ""
    last = decisions.groupBy(F.col("person_id").alias("__id")).agg(F.max_by("review_decision", F.when(said, F.col(seq))).alias("__decision"), F.max_by("review_decision_note", F.when(noted, F.col(seq))).alias("__note"))
    joined = people.join(last, people[id_column] == F.col("__id"), "left")
    own = lambda c: F.col(c) if c in people.columns else F.lit(None).cast("string")
    status = F.when(F.col("__decision").isin("accepted", "rejected", "needs_review"), F.col("__decision")).otherwise(F.col("review_status"))
    decided = joined.withColumns({"review_status": status, "review_decision": F.coalesce("__decision", own("review_decision")), "review_decision_note": F.coalesce("__note", own("review_decision_note"))}).drop("__id", "__decision", "__note")
    resolved = decisions.select(F.col("person_id").alias("__id"), F.explode("resolved_issue_types").alias("__type")).distinct().withColumn("__hit", F.lit(True))
    hit = (issues.person_id == resolved["__id"]) & (issues.issue_type == resolved["__type"]) & (issues.status == "open")
    closed = issues.join(resolved, hit, "left").withColumn("status", F.when(F.col("__hit"), "resolved").otherwise(F.col("status"))).select(*issues.columns)
    return decided, closed


def run_record(spark, run_id: str, at: str, revision: str, inputs: list[str], outputs: dict[str, int]) -> DataFrame:
    """One row that describes a report run; id, clock and revision are the caller's."""
    return spark.createDataFrame([(run_id, at, revision, inputs, outputs)], "run_id string, at string, revision string, inputs array<string>, outputs map<string, int>")
