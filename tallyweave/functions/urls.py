"""URLs as column expressions: canonical form, sites, and what kind of page a link leads to."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, let, text_or_empty

_PARTS = r"(?s)^https?://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
#: Word lists and scores of the link classifier (fixed values).
STATIC_FILE = r"(?i)\.(?:pdf|docx?|xlsx?|pptx?|zip|jpg|jpeg|png|gif|svg)$"
NOISE = (
    r"news|events?|alumni|admissions?|library|athletics|giving|facebook|twitter|instagram|linkedin|"
    r"youtube|calendar|maps?|contact|privacy|accessibility|copyright|apply|tuition|donate|socialmedia|"
    r"student|undergraduate|graduate|catalog|login|gdpr|human-resources|careers?|jobs?|registrar|"
    r"titleix|publicsafety|website-feedback|visit|tours?|history|awards?|commencement"
)
FACULTY = r"faculty|people|profile|profiles|directory|staff|professor|lecturer|instructor|postdoc|phd|doctoral|fellows?"
PERSON = r"profile|profiles/[^/]+|/people/[^/]+|/faculty/[^/]+|person|bio"
ORGANIZATION = r"department|school|college|center|centre|institute|program|research|lab|academics?"
TARGET_FIELD = (
    r"management|business|operations?|information systems?|analytics|decision|industrial engineering|"
    r"systems engineering|data science|statistics|economics|finance|marketing|accounting|mse|orfe|"
    r"管理|运筹|决策|信息系统|数据|统计|金融|市场"
)
#: kind: (score, boost for a target field, most)
LINK_SCORES = {"noise": (0.1, 0, 0.1), "faculty_candidate": (0.78, 0.08, 0.9), "faculty_list": (0.68, 0.08, 0.84), "organization": (0.55, 0.12, 0.72), "unknown": (0.25, 0, 0.25)}


def is_http(url: Column | str) -> Column:
    return F.lower(text_or_empty(url)).rlike("^https?://")


def host(url: Column | str) -> Column:
    """Host in lower case without a default port."""
    return F.regexp_replace(F.lower(F.regexp_extract(F.regexp_replace(text_or_empty(url), "(?i)^https?://", "http://"), _PARTS, 1)), ":(80|443)$", "")


def path(url: Column | str) -> Column:
    return F.regexp_extract(F.regexp_replace(text_or_empty(url), "(?i)^https?://", "http://"), _PARTS, 2)


def _encoded(x: Column) -> Column:
    return F.replace(F.replace(F.url_encode(x), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def _decoded(x: Column) -> Column:
    return F.coalesce(F.try_url_decode(x), x)


def canonical_url(url: Column | str) -> Column:
    """https, lower-case host, no default port, one trailing slash, sorted query, no fragment.

    What is not http(s) stays as it is.
    """
    plain = F.regexp_replace(F.trim(text_or_empty(url)), "(?i)^https?://", "http://")
    query = F.regexp_extract(plain, _PARTS, 3)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    split = F.transform(pairs, lambda p: F.struct(_decoded(F.substring_index(p, "=", 1)).alias("k"), _decoded(F.when(p.contains("="), F.regexp_replace(p, "^[^=]*=", "")).otherwise(F.lit(""))).alias("v")))
    text = F.array_join(F.transform(F.array_sort(split), lambda p: F.concat(_encoded(p["k"]), F.lit("="), _encoded(p["v"]))), "&")
    clean_path = F.regexp_replace(F.when(path(plain) == "", "/").otherwise(path(plain)), "/+$", "/")
    return F.when(is_http(plain), F.concat(F.lit("https://"), host(plain), clean_path, F.when(text != "", F.concat(F.lit("?"), text)).otherwise(F.lit("")))).otherwise(F.trim(text_or_empty(url)))


def same_site(a: Column | str, b: Column | str) -> Column:
    """Hosts that are equal, nested, or agree in their last two labels."""
    x, y = F.lower(col(a)), F.lower(col(b))
    return (x == y) | x.endswith(F.concat(F.lit("."), y)) | y.endswith(F.concat(F.lit("."), x)) | (F.substring_index(x, ".", -2) == F.substring_index(y, ".", -2))


def classify_link(url: Column | str, anchor: Column | str) -> Column:
    """struct(kind, score) of a link by its address and anchor text."""
    def judged(seen: Column) -> Column:
        kind = (
            F.when(path(url).rlike(STATIC_FILE) | seen.rlike(NOISE), "noise")
            .when(seen.rlike(FACULTY), F.when(seen.rlike(PERSON), "faculty_candidate").otherwise("faculty_list"))
            .when(seen.rlike(ORGANIZATION), "organization")
            .otherwise("unknown")
        )
        return let(F.struct(kind.alias("kind"), seen.rlike(TARGET_FIELD).alias("in_field")), scored)

    def scored(x: Column) -> Column:
        score = F.lit(None).cast("double")
        for name, (base, boost, most) in LINK_SCORES.items():
            score = F.when(x["kind"] == name, F.when(x["in_field"], min(most, round(base + boost, 2))).otherwise(base)).otherwise(score)
        return F.struct(x["kind"].alias("kind"), score.cast("decimal(9,4)").alias("score"))

    return let(F.lower(F.concat_ws(" ", col(url), text_or_empty(anchor))), judged)


def absolute_url(href: Column | str, base: Column | str) -> Column:
    """An href seen on page `base` as a full URL."""
    h, b = F.trim(text_or_empty(href)), text_or_empty(base)
    scheme_host = F.regexp_extract(b, r"^(https?://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(b, r"[?#].*$", ""), r"(?<=[^/])/[^/]*$", "/")
    return (
        F.when(is_http(h), h)
        .when(h.startswith("//"), F.concat(F.regexp_extract(b, r"^(https?:)", 1), h))
        .when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h)
        .when(h.startswith("/"), F.concat(scheme_host, h))
        .when(h.startswith("?") | h.startswith("#") | (h == ""), F.concat(F.regexp_replace(b, r"[?#].*$", ""), h))
        .otherwise(F.concat(F.when(folder.rlike(r"^https?://[^/]+$"), F.concat(folder, F.lit("/"))).otherwise(folder), h))
    )
