"""Papers, their authors, and the reports over both."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..durability import kept
from ..functions.lexicon import Lexicon, NameRules, score_name, score_text
from ..functions.text import clean_text, distinct_folded, distinct_nonempty, extract_doi, first_issn, is_blank, level_key, normalize_doi, normalize_publication_name, normalize_text, nz, score_of, sorted_json, text_or_empty, tier_order, venue_variants

#: Paper roles of an author.
FIRST, CORRESPONDING = "first_author", "corresponding_author"


# -- scans of bibliographic dumps ------------------------------------------------------------------

WORK = (
    "id string, doi string, title string, publication_year int, primary_location struct<landing_page_url: string, source: struct<display_name: string>>, "
    "authorships array<struct<author_position: string, is_corresponding: boolean, author: struct<id: string, display_name: string, orcid: string>, institutions: array<struct<display_name: string>>>>"
)
ITEM = (
    "title array<string>, `container-title` array<string>, DOI string, URL string, abstract string, "
    "author array<struct<given: string, family: string, name: string, ORCID: string, sequence: string, affiliation: array<struct<name: string>>>>, "
    "`published-print` struct<`date-parts`: array<array<int>>>, `published-online` struct<`date-parts`: array<array<int>>>, published struct<`date-parts`: array<array<int>>>, issued struct<`date-parts`: array<array<int>>>"
)


def author(name: Column, author_id: Column, orcid: Column, position: Column, corresponding: Column, affiliations: Column) -> Column:
    return F.struct(name.alias("name"), author_id.alias("author_id"), orcid.alias("orcid"), position.alias("position"), corresponding.alias("is_corresponding"), affiliations.alias("affiliations"))


def empty_list(kind: str = "string") -> Column:
    return F.array().cast(f"array<{kind}>")


def papers_from_works(works: DataFrame, fallback_journal: Column | str = "") -> DataFrame:
    """Papers of a dump whose works carry authorships with institutions (schema WORK)."""
    fallback = F.lit(fallback_journal) if isinstance(fallback_journal, str) else fallback_journal
    authors = F.transform(
        F.coalesce("authorships", F.lit(None)),
        lambda a: author(
            text_or_empty(a["author"]["display_name"]), text_or_empty(a["author"]["id"]), text_or_empty(a["author"]["orcid"]), text_or_empty(a["author_position"]),
            F.coalesce(a["is_corresponding"], F.lit(False)), distinct_nonempty(F.transform(F.coalesce(a["institutions"], F.lit(None)), lambda i: i["display_name"])),
        ),
    )
    with_authors = works.withColumn("authors", F.coalesce(F.filter(authors, lambda a: a["name"] != ""), F.array().cast(AUTHOR_LIST)))
    first = F.coalesce(F.try_element_at(F.filter("authors", lambda a: a["position"] == "first"), F.lit(1)), F.try_element_at("authors", F.lit(1)))
    return with_authors.select(
        clean_text("title").alias("title"),
        F.coalesce(nz("primary_location.source.display_name"), fallback).alias("journal"),
        F.col("publication_year").alias("year"),
        normalize_doi("doi").alias("doi"),
        text_or_empty("id").alias("url"),
        F.lit("").alias("abstract"),
        "authors",
        text_or_empty(first["name"]).alias("first_author_name"),
        F.transform(F.filter("authors", lambda a: a["is_corresponding"]), lambda a: a["name"]).alias("corresponding_author_names"),
        F.array_distinct(F.flatten(F.transform("authors", lambda a: a["affiliations"]))).alias("affiliations"),
        F.lit("openalex").alias("source"),
        F.coalesce(nz("primary_location.landing_page_url"), nz("doi"), nz("id"), F.lit("")).alias("paper_url"),
        text_or_empty("id").alias("source_api_url"),
    )


AUTHOR_LIST = "array<struct<name: string, author_id: string, orcid: string, position: string, is_corresponding: boolean, affiliations: array<string>>>"


def papers_from_items(items: DataFrame, fallback_journal: Column | str = "") -> DataFrame:
    """Papers of a dump whose items carry given and family names (schema ITEM)."""
    fallback = F.lit(fallback_journal) if isinstance(fallback_journal, str) else fallback_journal
    named = F.transform(
        "author",
        lambda a: author(
            F.coalesce(nz(clean_text(F.concat_ws(" ", a["given"], a["family"]))), clean_text(a["name"])), F.lit(""), text_or_empty(a["ORCID"]), text_or_empty(a["sequence"]),
            (text_or_empty(a["sequence"]) == "first") & ~is_blank(a["ORCID"]), distinct_nonempty(F.coalesce(F.transform(a["affiliation"], lambda x: x["name"]), empty_list())),
        ),
    )
    dated = [F.try_element_at(F.try_element_at(F.col(f"`{c}`.`date-parts`"), F.lit(1)), F.lit(1)) for c in ("published-print", "published-online", "published", "issued")]
    with_authors = items.withColumn("authors", F.coalesce(F.filter(named, lambda a: a["name"] != ""), F.array().cast(AUTHOR_LIST)))
    first = F.coalesce(F.try_element_at(F.filter("authors", lambda a: a["position"] == "first"), F.lit(1)), F.try_element_at("authors", F.lit(1)))
    return with_authors.select(
        clean_text(F.array_join("title", " ")).alias("title"),
        F.coalesce(nz(clean_text(F.array_join("`container-title`", " "))), fallback).alias("journal"),
        F.coalesce(*dated).alias("year"),
        normalize_doi("DOI").alias("doi"),
        F.coalesce(nz("URL"), F.when(~is_blank("DOI"), F.concat(F.lit("https://doi.org/"), "DOI")), F.lit("")).alias("url"),
        text_or_empty("abstract").alias("abstract"),
        "authors",
        text_or_empty(first["name"]).alias("first_author_name"),
        empty_list().alias("corresponding_author_names"),
        F.array_distinct(F.flatten(F.transform("authors", lambda a: a["affiliations"]))).alias("affiliations"),
        F.lit("crossref").alias("source"),
        F.coalesce(nz("URL"), F.lit("")).alias("paper_url"),
        F.lit("").alias("source_api_url"),
    )


def venue_issns(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("issn", first_issn(column))


def resolve_venues(wanted: DataFrame, venues: DataFrame, hits: str = "rank") -> DataFrame:
    """wanted(journal) with source_id: the venue of the same folded name, else the first hit, else empty.

    venues(query, display_name, id, rank): what a search for `query` gave.
    """
    exact = normalize_text("query") == normalize_text("display_name")
    order = F.struct((~exact).alias("inexact"), F.col(hits), F.col("id"))
    best = venues.groupBy(normalize_text("query").alias("__q")).agg(F.min_by("id", order).alias("__id"))
    joined = wanted.withColumn("__k", normalize_text("journal")).join(best, F.col("__k") == F.col("__q"), "left")
    return joined.withColumn("source_id", F.substring_index(text_or_empty("__id"), "/", -1)).drop("__k", "__q", "__id")


def lookup_by_doi(papers: DataFrame, works: DataFrame, columns: Sequence[str]) -> DataFrame:
    """papers with columns of the first work of the same DOI (prefixed work_)."""
    keyed = works.withColumn("__doi", normalize_doi("doi")).filter("__doi != ''")
    firsts = keyed.groupBy("__doi").agg(*(F.first(c).alias(f"work_{c}") for c in columns)) if "seq" not in works.columns else keyed.groupBy("__doi").agg(*(F.min_by(F.struct(c), "seq")[c].alias(f"work_{c}") for c in columns))
    return papers.withColumn("__key", normalize_doi("doi")).join(firsts, F.col("__key") == F.col("__doi"), "left").drop("__key", "__doi")


def unique_hits(people: DataFrame, profiles: DataFrame, wanted: Column | None = None) -> DataFrame:
    """people with profile columns, only where exactly one profile has the name and `wanted` holds."""
    by_name = Window.partitionBy("__name")
    found = profiles.withColumn("__name", normalize_text("name")).withColumn("__hits", F.count(F.lit(1)).over(by_name)).filter("__hits = 1")
    found = found.filter(wanted if wanted is not None else F.lit(True)).drop("__hits", "name")
    return people.withColumn("__own", normalize_text("name")).join(found, F.col("__own") == F.col("__name"), "left").drop("__own", "__name")


def first_hits(people: DataFrame, hits: DataFrame, columns: Sequence[str], order: Sequence[str] = ("rank",)) -> DataFrame:
    """people with `columns` of the first of the hits(name, ...) that a search for the name gave; null where there is none.

    Of hits of one place the least in its columns counts, so every run gives
    the same; a name without letters finds nothing.
    """
    named = hits.withColumn("__name", normalize_text("name")).filter("__name != ''")
    firsts = named.groupBy("__name").agg(F.min_by(F.struct(*columns), F.struct(*order, *columns)).alias("__hit"))
    joined = people.withColumn("__own", normalize_text("name")).join(firsts, F.col("__own") == F.col("__name"), "left")
    return joined.select(*people.columns, *(F.col(f"__hit.{c}").alias(c) for c in columns))


def affiliation_by_first_link(people: DataFrame, works: DataFrame) -> DataFrame:
    """people(paper_links) with the first affiliation of the work that the first link's DOI names."""
    keyed = people.withColumn("doi", F.coalesce(extract_doi(F.try_element_at("paper_links", F.lit(1))), F.lit("")))
    return lookup_by_doi(keyed, works, ["affiliations"]).withColumn("affiliation", F.coalesce(F.try_element_at("work_affiliations", F.lit(1)), F.lit(""))).drop("work_affiliations")


# -- filters and joins -----------------------------------------------------------------------------


def default_from_year(current_year: int) -> int:
    return current_year - 4


def in_window(year: Column | str, from_year: int, current_year: int) -> Column:
    y = F.col(year) if isinstance(year, str) else year
    return F.coalesce(y.between(from_year, current_year), F.lit(False))


def with_journal(papers: DataFrame, journals: DataFrame, one_each: bool = False) -> DataFrame:
    """papers with achievement_level and issn of the journal of the same normalised name.

    A title with several ISSNs keeps them all, as separate rows, unless one_each.
    """
    dim = journals.select(normalize_text("journal_name").alias("__journal"), "achievement_level", "issn_cn")
    if one_each:
        dim = dim.groupBy("__journal").agg(F.min(F.struct("issn_cn", "achievement_level")).alias("j")).select("__journal", "j.achievement_level", "j.issn_cn")
    return papers.withColumn("__key", normalize_text("journal")).join(dim, F.col("__key") == F.col("__journal"), "left").drop("__key", "__journal")


def match_venues(left: DataFrame, right: DataFrame, left_name: str, right_name: str, columns: Sequence[str]) -> DataFrame:
    """Pairs of rows whose venue names share a variant, each pair once."""
    a = left.withColumn("__v", F.explode(venue_variants(left_name)))
    b = right.select(*columns, F.explode(venue_variants(right_name)).alias("__v"))
    return a.join(b, "__v").drop("__v").distinct()


def journals_of_group(journals: DataFrame, groups: DataFrame, group: str, most: int | None = None) -> DataFrame:
    """Journals of the group by tier and name; a group without members is an error."""
    members = groups.filter(F.col("collection_group") == group)
    if members.isEmpty():
        raise ValueError(f"no journals in group {group!r}")
    names = members.select(normalize_text("journal_name").alias("__name"))
    found = journals.withColumn("__name", normalize_text("journal_name")).join(names, "__name", "left_semi").drop("__name")
    found = found.orderBy(tier_order("achievement_level"), "journal_name", "issn_cn")
    return found.limit(most) if most else found


def gate(papers: DataFrame, lexicon: Lexicon, texts: Sequence[str] = ("title", "abstract")) -> tuple[DataFrame, DataFrame]:
    """Papers that pass the relevance score, and issue rows for those that don't."""
    scored = papers.withColumn("relevance", score_text(list(texts), lexicon))
    rejected = scored.filter(F.col("relevance.status") == "rejected")
    issues = rejected.select(
        F.lit("papers").alias("related_table"), F.lit("paper_rejected_by_relevance").alias("issue_type"), F.lit("low").alias("severity"),
        F.concat(F.lit("rejected: "), F.substring(text_or_empty("title"), 1, 80)).alias("message"), text_or_empty("url").alias("source_url"), F.lit("open").alias("status"),
    )
    return scored.filter(F.col("relevance.status") != "rejected"), issues


def attribute(messages: DataFrame, names: DataFrame, message: str, name: str, order: str, label: str | None = None) -> DataFrame:
    """messages with the label of the first name (by `order`) that each normalised message contains, wherever it begins.

    The names are a dimension: their ranks come from one sort. Each message is
    scanned once by an automaton over all names; names beyond DIMENSION_BYTES are
    dealt to several automata of that size, one pass each, and the least rank
    wins, so that no worker holds more and the rows are the same at every size.
    """
    dim = names.select(F.col(label or name).alias("attributed"), F.col(order).alias("name_order"), normalize_publication_name(name).alias("name_key")).filter("name_key != ''")
    dim = kept(dim.withColumn("name_rank", F.row_number().over(Window.orderBy("name_order", "attributed", "name_key")).cast("long")))
    size = dim.agg(F.coalesce(F.sum(F.octet_length("name_key") + 64), F.lit(0))).first()[0]
    slices = max(1, -(-size // DIMENSION_BYTES))
    found = messages.withColumn("name_rank", F.lit(None).cast("long"))
    for k in range(slices):
        own = dim.filter(F.pmod(F.xxhash64("name_key"), F.lit(slices)) == k).groupBy("name_key").agg(F.min("name_rank").alias("name_rank"))
        rank = first_name(found.sparkSession, {r.name_key: r.name_rank for r in own.collect()})
        found = found.withColumn("name_rank", F.least("name_rank", rank(normalize_publication_name(message))))
        if slices > 1:
            found = kept(found)
    return found.join(dim.select("name_rank", "attributed"), "name_rank", "left").drop("name_rank")


#: UTF-8 bytes of names (and what goes with them) that one automaton may hold.
DIMENSION_BYTES = 8 << 20


@lru_cache(maxsize=1)
def name_automaton(names: tuple[tuple[str, int], ...]):
    import ahocorasick

    built = ahocorasick.Automaton()
    for key, rank in names:
        built.add_word(key, rank)
    if names:
        built.make_automaton()
    return built


def first_name(spark: SparkSession, ranks: Mapping[str, int]):
    """The least rank of the names that a text contains, as a function of columns; null if there is none."""
    shared = spark.sparkContext.broadcast(tuple(ranks.items()))

    @F.pandas_udf("long")
    def rank(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        names = shared.value
        automaton = name_automaton(names)
        for batch in batches:
            yield pd.Series([min((r for _, r in automaton.iter(t)), default=None) if names else None for t in batch], dtype="Int64")

    return rank


def collect_papers(works: DataFrame, journals: DataFrame, from_year: int, current_year: int, sources: Sequence[str] = ("openalex", "crossref"), broad_lexicon: Lexicon | None = None) -> tuple[DataFrame, DataFrame]:
    """Papers of the journals within the window, under the journals' own names, and issue rows.

    A journal and source without any row becomes a source error issue; with a
    lexicon, irrelevant papers are dropped and logged.
    """
    inside = works.filter(in_window("year", from_year, current_year) & F.col("source").isin(*sources))
    listed = journals.select(F.col("journal_name").alias("__listed"))
    found = match_venues(inside, listed, "journal", "__listed", ["__listed"]).withColumn("journal", F.col("__listed")).drop("__listed")
    asked = listed.crossJoin(F.broadcast(journals.sparkSession.createDataFrame([(s,) for s in sources], "__source string")))
    met = found.select(F.col("journal").alias("__listed"), F.col("source").alias("__source")).distinct()
    missing = asked.join(met, ["__listed", "__source"], "left_anti")
    issues = missing.select(
        F.lit("journals").alias("related_table"), F.lit("publication_source_error").alias("issue_type"), F.lit("medium").alias("severity"),
        F.concat_ws(" ", F.col("__source"), F.lit("gave no papers for"), F.col("__listed")).alias("message"), F.lit("").alias("source_url"), F.lit("open").alias("status"),
    )
    if broad_lexicon is None:
        return found, issues
    kept, rejected = gate(found, broad_lexicon)
    return kept.drop("relevance"), issues.unionByName(rejected)


# -- authors ---------------------------------------------------------------------------------------


def author_roles(papers: DataFrame) -> DataFrame:
    """One row for the first author and each other corresponding author of a paper.

    affiliations: those of the author element of that name, else the paper's.
    """
    first = F.struct(text_or_empty("first_author_name").alias("name"), F.lit(FIRST).alias("author_role"))
    others = F.transform(F.filter(F.coalesce("corresponding_author_names", empty_list()), lambda n: n != text_or_empty("first_author_name")), lambda n: F.struct(n.alias("name"), F.lit(CORRESPONDING).alias("author_role")))
    rows = papers.withColumn("who", F.explode(F.concat(F.array(first), others))).filter(~is_blank("who.name"))
    element = F.try_element_at(F.filter("authors", lambda a: a["name"] == F.col("who.name")), F.lit(1))
    own = F.when(F.size(element["affiliations"]) > 0, element["affiliations"])
    return rows.withColumns({"name": F.col("who.name"), "author_role": F.col("who.author_role"), "affiliations": F.coalesce(own, "affiliations", empty_list())}).drop("who")


def annotate_names(rows: DataFrame, rules: NameRules, name: str = "name", least: float | None = None) -> DataFrame:
    """rows with name_rule_flag, name_rule_score and name_rule_reason; filtered only if `least` is given."""
    scored = rows.withColumn("__n", score_name(name, rules))
    scored = scored.withColumns({"name_rule_flag": F.col("__n.flag"), "name_rule_score": F.col("__n.score"), "name_rule_reason": F.col("__n.reason")}).drop("__n")
    return scored if least is None else scored.filter(F.col("name_rule_score") >= least)


LISTS = ("affiliations", "paper_links", "paper_titles", "journals", "years", "author_roles")


def roll_up(rows: DataFrame, seq: str = "seq", accept: float = 0.7, review: float = 0.45) -> DataFrame:
    """One row for each folded name: role and level counts, ordered-distinct lists, best name score, status.

    rows(name, author_role, achievement_level, title, journal, year, paper_url,
    affiliations array, name_rule_score, name_rule_reason, seq). Lists are
    made from each name's distinct values with their first place, so a name
    with very many rows collects only what differs.
    """
    keyed = rows.withColumn("__key", normalize_text("name")).withColumn("__level", level_key("achievement_level"))
    top, level = F.upper(text_or_empty("achievement_level")).contains("TOP"), F.upper(F.trim(text_or_empty("achievement_level")))
    best = F.struct("name_rule_score", (-F.col(seq)).alias("early"))
    summed = keyed.groupBy("__key").agg(
        F.min_by("name", seq).alias("name"),
        F.count(F.lit(1)).alias("last_5_year_total"),
        F.count_if(F.col("author_role") == FIRST).alias("first_author_total"),
        F.count_if(F.col("author_role") == CORRESPONDING).alias("corresponding_author_total"),
        F.count_if(top).alias("top_total"),
        F.count_if(level.startswith("A+")).alias("a_plus_total"),
        F.count_if(level == "A").alias("a_total"),
        F.count_if(level == "A1").alias("a1_total"),
        F.count_if(level == "A2").alias("a2_total"),
        F.max("name_rule_score").alias("name_rule_score"),
        F.max_by("name_rule_reason", best).alias("name_rule_reason"),
    )
    levels = keyed.filter("__level != ''").groupBy("__key", "__level").agg(F.count(F.lit(1)).cast("int").alias("n")).groupBy("__key").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("__level", "n")))).alias("levels"))
    values = {
        "affiliations": F.col("affiliations"), "paper_links": F.array("paper_url"), "paper_titles": F.array("title"),
        "journals": F.array("journal"), "years": F.array(F.col("year").cast("string")), "author_roles": F.array("author_role"),
    }

    def tagged(kind: str, items: Column) -> Column:
        return F.transform(F.coalesce(items, empty_list()), lambda x: F.struct(F.lit(kind).alias("list"), clean_text(x).alias("value")))

    listed = F.explode(F.flatten(F.array(*(tagged(k, v) for k, v in values.items()))))
    items = keyed.select("__key", seq, listed.alias("v")).filter("v.value != ''").groupBy("__key", "v.list", "v.value").agg(F.min(seq).alias("at"))
    gathered = items.groupBy("__key").agg(*(F.transform(F.array_sort(F.collect_list(F.when(F.col("list") == k, F.struct("at", "value")))), lambda x: x["value"]).alias(k) for k in LISTS))
    joined = summed.join(gathered, "__key", "left").join(levels, "__key", "left")
    score = F.coalesce("name_rule_score", F.lit(0))
    return joined.select(
        "name", "last_5_year_total", "first_author_total", "corresponding_author_total", "top_total", "a_plus_total", "a_total", "a1_total", "a2_total",
        F.coalesce(sorted_json(F.col("levels")), F.lit("{}")).alias("level_counts_json"),
        *(F.coalesce(k, empty_list()).alias(k) for k in LISTS),
        F.col("name_rule_score"), F.col("name_rule_reason"),
        F.when((score >= accept) & ((F.col("top_total") > 0) | (F.col("a_plus_total") > 0) | (F.col("last_5_year_total") >= 2)), "strong_candidate").when(score >= review, "needs_review").otherwise("rejected").alias("review_status"),
    )


def ranked(candidates: DataFrame) -> DataFrame:
    return candidates.orderBy(F.desc("top_total"), F.desc("a_plus_total"), F.desc("last_5_year_total"), "name")


def candidate_confidence(top: Column, a_plus: Column, papers: Column, name_score: Column) -> Column:
    """.45, and .25 for a top paper, .1 for two papers, .1 for a sure name; at most .9."""
    d = lambda x: F.lit(x).cast("decimal(9,4)")
    parts = F.when(top + a_plus > 0, d("0.25")).otherwise(d("0")) + F.when(papers >= 2, d("0.1")).otherwise(d("0")) + F.when(name_score >= 0.7, d("0.1")).otherwise(d("0"))
    return score_of(F.least(d("0.9"), d("0.45") + parts))


def candidate_stats(candidates: DataFrame) -> DataFrame:
    """Candidates with their counts as one struct."""
    counts = [c for c in candidates.columns if c.endswith("_total")]
    return candidates.withColumn("publication_stats", F.struct(*counts, F.col("level_counts_json")))


def rule_issues(rows: DataFrame, rules: Mapping[str, tuple[str, Column, Column | str]], keep: Sequence[str]) -> DataFrame:
    """One issue row for each rule that holds: rules = {type: (severity, condition, message)}."""
    found = [F.when(c, F.struct(F.lit(t).alias("issue_type"), F.lit(s).alias("severity"), (F.lit(m) if isinstance(m, str) else m).alias("message"))) for t, (s, c, m) in rules.items()]
    return rows.select(*keep, F.explode(F.array_compact(F.array(*found))).alias("i")).select(*keep, "i.*", F.lit("open").alias("status"))


def candidate_rules(flag: Column, score: Column, status: Column, papers: Column, affiliations: Column) -> dict[str, tuple[str, Column, str]]:
    none = F.coalesce(F.size(affiliations) <= 0, F.lit(True))
    return {
        "missing_affiliation": ("medium", none, "no affiliation"),
        "weak_name_score": ("low", (flag > 0) & (score < 0.7), "name score is low"),
        "publication_only_needs_review": ("medium", status == "needs_review", "candidate needs review"),
        "high_output_no_affiliation": ("high", (flag > 0) & (papers >= 5) & none, "five papers or more and no affiliation"),
    }


def merge_affiliations(authors: Column, names: Column, affiliations: Column) -> Column:
    """Authors with blanks filled: by place if the lists are as long, else with the whole list."""
    made = F.transform(names, lambda n, i: author(n, F.lit(""), F.lit(""), F.lit(""), F.lit(False), F.when(F.size(affiliations) == F.size(names), F.array(F.try_element_at(affiliations, i + 1))).otherwise(affiliations)))
    by_place = F.transform(authors, lambda a, i: F.when(F.coalesce(F.size(a["affiliations"]), F.lit(0)) <= 0, a.withField("affiliations", F.array_compact(F.array(F.try_element_at(affiliations, i + 1))))).otherwise(a))
    all_of = F.transform(authors, lambda a: F.when(F.coalesce(F.size(a["affiliations"]), F.lit(0)) <= 0, a.withField("affiliations", affiliations)).otherwise(a))
    return F.when(F.size(authors) <= 0, made).when(F.size(authors) == F.size(affiliations), by_place).otherwise(all_of)


def missing_affiliations(papers: DataFrame) -> DataFrame:
    return papers.filter(~is_blank("doi") & (F.coalesce(F.size("affiliations"), F.lit(0)) <= 0))


def backfill_affiliations(papers: DataFrame, works: DataFrame, landing: DataFrame | None = None) -> DataFrame:
    """Papers with a DOI and no affiliation get the authors of the dump's work, else what their landing page names.

    landing(doi, authors array, affiliations array) as found by the page jobs.
    """
    found = lookup_by_doi(papers, works, ["authors", "affiliations"])
    bare = ~is_blank("doi") & (F.coalesce(F.size("affiliations"), F.lit(0)) <= 0)
    from_work = bare & (F.coalesce(F.size("work_affiliations"), F.lit(0)) > 0)
    found = found.withColumns({"authors": F.when(from_work, F.col("work_authors")).otherwise(F.col("authors")), "affiliations": F.when(from_work, F.array_distinct("work_affiliations")).otherwise(F.col("affiliations"))}).drop("work_authors", "work_affiliations")
    if landing is None:
        return found
    pages = landing.select(normalize_doi("doi").alias("__doi"), F.col("authors").alias("__names"), distinct_folded(F.col("affiliations")).alias("__affs")).dropDuplicates(["__doi"])
    joined = found.withColumn("__key", normalize_doi("doi")).join(pages, F.col("__key") == F.col("__doi"), "left")
    fills = bare & (F.coalesce(F.size("__affs"), F.lit(0)) > 0)
    merged = F.when(fills, merge_affiliations(F.col("authors"), F.coalesce("__names", empty_list()), F.col("__affs"))).otherwise(F.col("authors"))
    return joined.withColumns({"authors": merged, "affiliations": F.when(fills, F.col("__affs")).otherwise(F.col("affiliations"))}).drop("__key", "__doi", "__names", "__affs")


# -- quality report --------------------------------------------------------------------------------


def quality_report(journals: DataFrame, papers: DataFrame, candidates: DataFrame, issues: DataFrame) -> DataFrame:
    """Counts for each journal: papers by source, merged, candidates, gaps, attributed errors; idle journals are left out."""
    dim = journals.select("journal_name", "achievement_level", normalize_publication_name("journal_name").alias("__key"), F.struct(tier_order("achievement_level").alias("tier"), "journal_name").alias("__order"))
    per_key = dim.filter("__key != ''").groupBy("__key").agg(F.max_by("journal_name", "__order").alias("journal_name"), F.max_by("achievement_level", "__order").alias("achievement_level"))
    in_source = lambda s: text_or_empty("source").contains(s)
    paper_counts = papers.withColumn("__key", normalize_publication_name("journal")).groupBy("__key").agg(
        F.count(F.lit(1)).alias("papers"),
        F.count_if(in_source("openalex")).alias("openalex_papers"),
        F.count_if(in_source("crossref")).alias("crossref_papers"),
        F.count_if(in_source("openalex") & in_source("crossref")).alias("merged_papers"),
        F.count_if(is_blank("first_author_name")).alias("missing_author"),
        F.count_if(F.coalesce(F.size("affiliations"), F.lit(0)) <= 0).alias("missing_affiliation"),
    )
    candidate_counts = candidates.withColumn("__key", normalize_publication_name("journal")).groupBy("__key").agg(F.count(F.lit(1)).alias("candidates"), F.count_if(F.col("name_rule_score") >= 0.45).alias("scored_candidates"))
    errors = attribute(issues.filter(F.col("issue_type") == "publication_source_error"), dim, "message", "journal_name", "__order")
    error_counts = errors.filter("attributed is not null").groupBy(F.col("attributed").alias("journal_name")).agg(F.count(F.lit(1)).alias("errors"))
    joined = per_key.join(paper_counts, "__key", "left").join(candidate_counts, "__key", "left").join(error_counts, "journal_name", "left")
    numbers = ["papers", "openalex_papers", "crossref_papers", "merged_papers", "candidates", "scored_candidates", "missing_author", "missing_affiliation", "errors"]
    filled = joined.select("journal_name", "achievement_level", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers))
    return filled.filter("papers + candidates + errors > 0")
