"""Column expressions for the keys and small values that joins and reports rest on.

Empty strings and nulls both mean "missing" throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space and the four ASCII separators.
SPACE = r"[\p{IsWhite_Space}\x1c-\x1f]+"
#: Character references that publishers leave in titles (fixed values).
ENTITIES = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": " "}
DOI = r"(10\.\d{4,}/[^\s]+)"
ISSN = r"\b\d{4}-[\dXx]{4}\b"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nz(c: Column | str) -> Column:
    """The text, or null where it is empty."""
    return F.nullif(col(c), F.lit(""))


def text_or_empty(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit(""))


def is_blank(c: Column | str) -> Column:
    return text_or_empty(c) == ""


def clean_text(c: Column | str) -> Column:
    """White space collapsed and trimmed."""
    return F.trim(F.regexp_replace(text_or_empty(c), SPACE, " "))


def normalize_text(c: Column | str) -> Column:
    """Case-folded and collapsed: the join key of names and titles."""
    return F.trim(F.regexp_replace(F.replace(F.lower(text_or_empty(c)), F.lit("ß"), F.lit("ss")), SPACE, " "))


def normalize_doi(c: Column | str) -> Column:
    return F.lower(F.regexp_replace(F.trim(text_or_empty(c)), r"^https?://doi\.org/", ""))


def extract_doi(c: Column | str) -> Column:
    """The first DOI in a text or URL; null if there is none."""
    found = F.regexp_extract(text_or_empty(c), DOI, 1)
    return F.coalesce(nz(found), F.when(text_or_empty(c).startswith("10."), col(c)))


def first_issn(c: Column | str) -> Column:
    return F.regexp_extract(text_or_empty(c), ISSN, 0)


def normalize_publication_name(c: Column | str) -> Column:
    """Letters and digits of a venue name, single-spaced."""
    return F.trim(F.regexp_replace(F.lower(text_or_empty(c)), "[^a-z0-9]+", " "))


def normalize_venue_for_match(c: Column | str) -> Column:
    """The same with character references resolved and "&" read as "and"."""
    out = text_or_empty(c)
    for entity, plain in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(plain))
    return normalize_publication_name(F.replace(out, F.lit("&"), F.lit(" and ")))


def venue_variants(c: Column | str) -> Column:
    """Distinct names a venue may go by: whole, before the first hyphen, after it; of 5 characters or more."""
    x = text_or_empty(c)
    before = F.substring_index(x, "-", 1)
    after = F.regexp_replace(x, "^[^-]*-?", "")
    names = F.array(normalize_venue_for_match(x), normalize_venue_for_match(before), F.when(x.contains("-"), normalize_venue_for_match(after)).otherwise(F.lit("")))
    return F.array_distinct(F.filter(names, lambda n: F.length(n) >= 5))


def split_pipe(c: Column | str) -> Column:
    return F.filter(F.transform(F.split(text_or_empty(c), r"\|"), lambda x: F.trim(x)), lambda x: x != "")


def distinct_nonempty(items: Column) -> Column:
    """Trimmed items in first-seen order, without blanks and repeats."""
    return F.array_distinct(F.filter(F.transform(items, clean_text), lambda x: x != ""))


def distinct_folded(items: Column) -> Column:
    """As distinct_nonempty, but names that differ only in case are one."""
    kept = distinct_nonempty(items)
    return F.filter(kept, lambda x, i: ~F.exists(F.slice(kept, F.lit(1), i), lambda y: normalize_text(y) == normalize_text(x)))


def json_list(c: Column | str, item: str = "string") -> Column:
    """A JSON array as a column; anything else is an empty array."""
    x = F.ltrim(text_or_empty(c))
    return F.coalesce(F.when(x.startswith("["), F.from_json(x, f"array<{item}>")), F.array().cast(f"array<{item}>"))


def json_map(c: Column | str, value: str = "int") -> Column:
    """A JSON object as a map; anything else is an empty map."""
    x = F.ltrim(text_or_empty(c))
    return F.coalesce(F.when(x.startswith("{"), F.from_json(x, f"map<string,{value}>")), F.create_map().cast(f"map<string,{value}>"))


def sorted_json(m: Column) -> Column:
    """A map as JSON text with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(m))))


def join_links(links: Column, most: int = 20) -> Column:
    return F.array_join(F.slice(links, 1, most), " | ")


def safe_int(c: Column | str) -> Column:
    return nz(F.trim(text_or_empty(c))).try_cast("double").try_cast("int")


def safe_double(c: Column | str) -> Column:
    return F.coalesce(nz(F.trim(text_or_empty(c))).try_cast("double"), F.lit(0.0))


def level_key(level: Column | str) -> Column:
    """Level that a paper is counted under: TOP where the text has it, else the text itself."""
    x = text_or_empty(level)
    return F.when(F.upper(x).contains("TOP"), "TOP").otherwise(x)


def tier_order(level: Column | str) -> Column:
    """Sort key of tiers: TOP, A+, A, A1, A2, others."""
    x = text_or_empty(level)
    return F.when(x.ilike("%TOP%"), 0).when(x.ilike("A+%"), 1).when(x.ilike("A1%"), 3).when(x.ilike("A2%"), 4).when(x.ilike("A%"), 2).otherwise(5)


def band(score: Column | str, accept: float, review: float, names: Sequence[str] = ("accepted", "needs_review", "rejected")) -> Column:
    return F.when(col(score) >= accept, names[0]).when(col(score) >= review, names[1]).otherwise(names[2])


def content_hash(c: Column | str) -> Column:
    return F.sha1(text_or_empty(c))


def score_of(c: Column, digits: int = 2) -> Column:
    """A score as an exact decimal, rounded half up."""
    return F.round(c, digits).cast("decimal(9,4)")


def register_sql_functions(spark) -> None:
    """normalize_text_for_join(x) for SQL texts; Catalyst inlines its body."""
    pattern = SPACE.replace("\\", "\\\\")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION normalize_text_for_join(x STRING) RETURNS STRING "
        f"RETURN trim(regexp_replace(replace(lower(coalesce(x, '')), 'ß', 'ss'), '{pattern}', ' '))"
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once however often the body has it."""
    return F.transform(F.array(value), body)[0]
