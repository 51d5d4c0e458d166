"""People on web pages: one profile of a page, cards of a list, and the job that extracts both.

All rules are expressions, windows and aggregations over a page's element rows
(see `html`). What belongs together is joined by structure: a section is the
following siblings of its heading up to the next stop heading, a card's parts
are the elements that name it as an ancestor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..durability import kept
from ..functions.lexicon import Lexicon
from ..functions.text import clean_text, is_blank, nz, score_of, text_or_empty
from ..functions.urls import absolute_url, canonical_url, path
from .html import CARD_CHARS, LABEL_TAGS, PAGE, computed, elements
from .listings import pages_to_extract
from .people import accept_profiles

# -- fixed values -----------------------------------------------------------------------------------
# What pages of people are read by. Stored profiles, their confidence and the issues that these raise
# follow from these words, patterns and limits, so they have to be just these.

TITLES = (
    "Assistant Professor", "Associate Professor", "Professor", "Postdoctoral Fellow", "Postdoctoral Researcher", "PhD Student", "Doctoral Student",
    "Research Scientist", "Lecturer", "Instructor", "Professor of Practice", "Dean", "Chair",
)
GENERIC_NAMES = ("faculty", "people", "profiles?", "directory", "staff", "students?", "research", "department", "school", "college")
GENERIC_PHRASES = ("faculty profiles?", "faculty directory", "research centers?", "open positions?")
STOP_HEADINGS = (
    "Education", "Teaching", "Publications?", "Selected Publications?", "Biography", "Bio", "About", "Contact", "Email", "Courses?", "Awards?",
    "Affiliation", "Affiliations?", "TC Affiliations", "Faculty Expertise", "Office Hours?", "Research", "Research Interests?", "Scholarly Interests",
    "Advisor", "Advisors?", "Active Professional Organizations?", "Current Projects?", "Grants?",
)
#: Field: labels of headings, in the order in which they are tried.
HEADINGS = {
    "research_interests": ("Scholarly Interests", "Research Interests?", "Research Areas?", "Areas of Expertise", "Faculty Expertise", "Research Summary"),
    "biography": ("Biographical Information", "Biography", "Bio", "About", "Profile"),
    "publications": ("Publications?", "Selected Publications"),
    "education": ("Educational Background", "Education", "Degrees?"),
}
#: Field: labels in running text.
LABELS = {
    "research_interests": r"Scholarly Interests|Research Interests?|Research Areas?|Areas of Expertise|Faculty Expertise",
    "biography": r"Biographical Information|Biography|Bio",
    "publications": r"Publications?|Selected Publications",
    "education": r"Educational Background|Education\s*:|Degrees?\s*:",
    "advisor": r"\b(?:Advisor|Advisors?|Supervisor|Supervisors?)\b\s*:",
    "department": r"Affiliation|Department",
}
#: The same on cards.
CARD_LABELS = {
    "research_interests": r"Research Interests?|Research Areas?|Areas of Expertise",
    "education": r"Education|Educational Background|Degrees?",
    "advisor": r"Advisor|Advisors?|Supervisor|Supervisors?",
}
#: What ends a stretch of running text, and what ends that of an advisor or a department.
STOPS = (
    "Education", "Teaching", "Publications", "Selected Publications", "Biography", "Biographical Information", "Research", "Research Interests",
    "Scholarly Interests", "Faculty Expertise", "Contact", "Email",
)
FEW_STOPS = ("Education", "Research", "Publications", "Biography", "Contact", "Email")
#: Labels of blocks whose value follows in the same element.
AFFILIATIONS, EXPERTISE = ("TC Affiliations", "Affiliations?", "Affiliation"), ("Faculty Expertise",)
#: Class names, in the order in which they are tried: whole ones, then parts.
NAME_CLASSES, TITLE_CLASSES = ("profile-name", "fic-name", "name"), ("job-title", "position", "title")
DEPARTMENT_CLASSES = ("department", "division", "program", "school", "college")
PHOTO_CLASSES = ("profile", "portrait", "headshot", "person")
PHOTO_WORDS, NO_PHOTO = "profile|portrait|headshot|person|faculty", "logo|icon|sprite|seal|shield|wordmark|placeholder|banner"
IMAGE_SOURCES = ("src", "data-src", "data-original", "data-lazy-src")
PROFILE_LINK, HOMEPAGE = "profile|people|faculty|person|bio", "website|homepage|personal"
CARD_DEPARTMENT = r"(Department of [A-Z][A-Za-z &,-]+|School of [A-Z][A-Za-z &,-]+|College of [A-Z][A-Za-z &,-]+)"
RESEARCH_SENTENCE = (
    r"(?i)((?:His|Her|Their|[A-Z][A-Za-z.-]+(?:\s+[A-Z][A-Za-z.-]+){0,3})\s+research\s+"
    r"(?:examines|focuses on|centers on|explores|addresses)\s+.+?)(?:\.\s|$)"
)
EMAIL = r"(?i)[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}"
PROFILE_PATH = r"(?i)/(people|faculty|profile|profiles)/[^/]+/?$"
ESCALATION_LABELS = r"(?i)Biography|Research|Education|Advisor|PhD|Postdoctoral|Publications"
REASONS = (
    "likely_profile_with_fewer_than_3_useful_fields", "target_labels_present_but_sections_not_isolated", "script_or_json_heavy_page",
    "low_html_parser_confidence", "html_parser_sufficient_or_not_profile_like",
)
SECTION_CHARS, SOURCE_CHARS, DEPARTMENT_CHARS, TITLE_CHARS = 1200, 10_000, 250, 200
JSON_CONFIDENCE = {True: "0.33", False: "0.22"}

# -- words and patterns in texts --------------------------------------------------------------------

TITLE = rf"(?i)\b({'|'.join(TITLES)})\b"
GENERIC = rf"(?i)^({'|'.join(GENERIC_NAMES)})$|{'|'.join(GENERIC_PHRASES)}"
STOP_HEADING = rf"(?i)^({'|'.join(STOP_HEADINGS)})$"
#: So many siblings of a heading hold SECTION_CHARS, even if each is one character.
MOST_PARTS = SECTION_CHARS // 2
COLUMNS = ("name", "school", "department", "title", "email", "url", "personal_homepage", "research_interests", "biography", "publications", "photo_url", "education", "advisor", "source_text", "confidence_score")


def after_label(text: Column | str, labels: str, stops: Sequence[str] = STOPS) -> Column:
    """What follows a label in running text, up to the next stop word; else empty."""
    value = F.regexp_extract(text, rf"(?i)(?:{labels})\s*:?\s*(.+)", 1)
    return clean_text(F.substring(F.split(value, f"(?i)(?:{'|'.join(stops)})", 2)[0], 1, SECTION_CHARS))


def research_sentence(text: Column | str) -> Column:
    """A sentence that says what someone's research is about; else empty."""
    guard = F.lower(text).rlike(r"research\s+(?:examines|focuses on|centers on|explores|addresses)\s")
    return F.when(guard, F.substring(clean_text(F.regexp_extract(text, RESEARCH_SENTENCE, 1)), 1, SECTION_CHARS)).otherwise("")


def recased(name: Column) -> Column:
    """Names in capitals or small letters alone get capital initials."""
    plain = (name == F.upper(name)) | (name == F.lower(name))
    return F.when(plain & name.rlike(r"\p{L}"), F.initcap(name)).otherwise(name)


def good_name(text: Column) -> Column:
    return F.length(text).between(2, 80) & ~text.rlike(GENERIC)


def joined_email(user: Column, domain: Column) -> Column:
    both = F.concat(F.trim(user), F.lit("@"), F.trim(domain))
    return F.when(both.rlike(f"{EMAIL}$") & both.rlike(EMAIL.replace("(?i)", "(?i)^")), both)


def share_of(names: Sequence[str]) -> Column:
    """Share of the columns that are not empty, to two places."""
    filled = sum((F.when(~is_blank(c), 1).otherwise(0) for c in names), F.lit(0))
    return score_of(F.round(filled.cast("decimal(9,4)") / len(names), 2))


class Rows:
    """Column expressions over element rows."""

    @staticmethod
    def attr(name: str) -> Column:
        return nz(F.try_element_at("attrs", F.lit(name)))

    @staticmethod
    def classes() -> Column:
        return F.coalesce(F.try_element_at("attrs", F.lit("class")), F.lit(""))

    @staticmethod
    def tag(*names: str) -> Column:
        return F.col("tag").isin(*names)

    @classmethod
    def has_class(cls, name: str) -> Column:
        return F.array_contains(F.split(cls.classes(), r"\s+"), name)

    @classmethod
    def class_part(cls, part: str) -> Column:
        return cls.classes().contains(part)

    @classmethod
    def source(cls) -> Column:
        """An image's address."""
        listed = F.coalesce(cls.attr("srcset"), cls.attr("data-srcset"), F.lit(""))
        return F.trim(F.coalesce(*(cls.attr(a) for a in IMAGE_SOURCES), nz(F.regexp_extract(listed, r"^\s*([^\s,]+)", 1)), F.lit("")))

    @classmethod
    def photo(cls) -> Column:
        """struct(score, place, pos, src, alt) of an image that may show the person; null for others.

        place: the first of the selectors that finds it.
        """
        alt = clean_text(F.coalesce(cls.attr("alt"), F.lit("")))
        shown = F.concat_ws(" ", cls.source(), alt, cls.classes())
        place = F.coalesce(*(F.when(cls.class_part(w), k) for k, w in enumerate(PHOTO_CLASSES)), *(F.when(F.array_contains("inside", t), len(PHOTO_CLASSES) + k) for k, t in enumerate(("main", "article"))))
        score = F.when(shown.rlike(f"(?i){PHOTO_WORDS}"), 3).otherwise(1)
        usable = cls.tag("img") & (cls.source() != "") & ~shown.rlike(f"(?i){NO_PHOTO}") & place.isNotNull()
        return F.when(usable, F.struct(score.alias("score"), place.alias("place"), "pos", cls.source().alias("src"), F.lower(alt).alias("alt")))

    @staticmethod
    def first(condition: Column, *columns: Column | str) -> Column:
        """The first element of a group for which the condition holds."""
        return F.min(F.when(condition, F.struct("pos", *columns)))


def best_photo(photos: Column, name: Column) -> Column:
    """Address of the best image; one whose alt text has the first part of the name gains two."""
    first = F.lower(F.split(F.trim(name), r"\s+")[0])
    gain = lambda x: F.when((first != "") & x["alt"].contains(first), 2).otherwise(0)
    ranked = F.transform(photos, lambda x: F.struct((-(x["score"] + gain(x))).alias("rank"), x["place"].alias("place"), x["pos"].alias("pos"), x["src"].alias("src")))
    return F.coalesce(F.array_min(ranked)["src"], F.lit(""))


# -- profiles ---------------------------------------------------------------------------------------


def sections(el: DataFrame) -> DataFrame:
    """page_id and the labelled sections of each page that has any; also `affiliation` and `expertise` blocks.

    el: element rows, all of a page in one partition. A heading's section is
    its following siblings up to the next stop heading; if there are none and
    the heading is inside a link, the link's siblings. Labels are tried in
    order, headings with the same label in the page's order.
    """
    heading = F.col("tag").isin(*LABEL_TAGS) & (F.col("text") != "")
    labels = {f: F.coalesce(*(F.when(F.col("text").rlike(f"(?i){p}"), k) for k, p in enumerate(patterns))) for f, patterns in HEADINGS.items()}
    row = lambda **changed: F.struct(*(changed.get(c, F.col(c)).alias(c) for c in ("page_id", "pos", "parent", "tag", "text", "around")), F.lit("tag" in changed).cast("int").alias("proxy"), F.col("pos").alias("at"))
    proxy = row(pos=F.col("parent"), parent=F.col("above"), tag=F.lit("proxy"))
    rows = el.filter((F.col("text") != "") & (F.col("tag") != PAGE) & (F.col("json_card") < 0))
    rows = rows.select(F.explode(F.when(heading & (F.col("parent_tag") == "a"), F.array(row(), proxy)).otherwise(F.array(row()))).alias("r")).select("r.*")
    is_label = F.col("tag").isin(*LABEL_TAGS, "proxy")
    rows = rows.withColumns({f"{f}_label": F.when(is_label, c) for f, c in labels.items()})
    stop = F.col("tag").isin("h2", "h3", "h4", "dt") & F.col("text").rlike(STOP_HEADING)
    family = Window.partitionBy("page_id", "parent").orderBy("pos", "proxy")
    rows = rows.withColumn("stretch", F.sum(stop.cast("int")).over(family.rowsBetween(Window.unboundedPreceding, 0)))
    values = {}
    for name, names in (("affiliation", AFFILIATIONS), ("expertise", EXPERTISE)):
        own = is_label & (F.col("proxy") == 0) & F.col("text").rlike(rf"(?i)^(?:{'|'.join(names)})\s*:?$")
        value = F.trim(F.regexp_replace(F.regexp_replace("around", rf"(?i)^(?:{'|'.join(names)})\s*:?\s*", ""), r"^[ :]+|[ :]+$", ""))
        values[name] = F.when(own & (value != "") & (value != F.col("text")), clean_text(F.substring(value, 1, SECTION_CHARS)))
    wanted = F.coalesce(*(F.col(f"{f}_label") for f in HEADINGS)).isNotNull() | F.coalesce(*values.values()).isNotNull()
    rows = rows.withColumns(values).withColumn("wanted", wanted)
    stretch = Window.partitionBy("page_id", "parent", "stretch")
    rows = rows.withColumn("any", F.max("wanted").over(stretch)).filter("any")
    later = F.collect_list(F.when(F.col("proxy") == 0, F.col("text"))).over(stretch.orderBy("pos", "proxy").rowsBetween(1, MOST_PARTS))
    found = rows.withColumn("section", F.when(F.col("wanted"), clean_text(F.substring(F.array_join(later, " "), 1, SECTION_CHARS)))).filter("wanted")
    best = [F.min(F.when((F.col(f"{f}_label").isNotNull()) & (F.col("section") != ""), F.struct(f"{f}_label", "at", "proxy", "section")))["section"].alias(f) for f in HEADINGS]
    return found.groupBy("page_id").agg(*best, *(F.min(F.when(F.col(v).isNotNull(), F.struct("pos", v)))[v].alias(v) for v in values))


def profiles(pages: DataFrame) -> DataFrame:
    """One profile for each page, with its confidence: see `profiles_of`; pages(page_id, url, html[, school])."""
    return profiles_of(pages, elements(pages))


def profiles_of(pages: DataFrame, el: DataFrame) -> DataFrame:
    """page_id, COLUMNS, n_useful, visible_chars and script_chars of each page of pages(page_id, url[, school]).

    el: the pages' element rows. The name is that of the first selector whose
    first element is a good one, else the start of the page's title. Of several
    elements that hold a title the one nearest to the name counts. A page
    without rows has an empty profile.
    """
    own = el.repartition("page_id")
    r = Rows
    told = r.tag(PAGE, "title", "h1", "h2", "img", "a") | (r.classes() != "") | r.attr("data-user").isNotNull()
    page = own.filter((F.col("json_card") < 0) & told)
    in_tag = lambda t, tag: F.array_contains("inside", t) & r.tag(tag)
    names = [r.has_class(c) for c in NAME_CLASSES] + [r.class_part("name"), in_tag("main", "h1"), in_tag("article", "h1"), r.tag("h1"), r.tag("h2")]
    name_rows = [r.first(c & ~r.tag(PAGE), F.struct("text", r.has_class("sr-only").alias("hidden")).alias("x")).alias(f"name_{k}") for k, c in enumerate(names)]
    title_rank = F.coalesce(*(F.when(r.class_part(c), k) for k, c in enumerate(TITLE_CLASSES)))
    titles = F.collect_list(F.when(title_rank.isNotNull() & F.col("text").rlike(TITLE), F.struct(title_rank.alias("rank"), "pos", F.substring("text", 1, TITLE_CHARS).alias("text"))))
    departments = [r.first(c, "text").alias(f"department_{k}") for k, c in enumerate([*(r.class_part(d) for d in DEPARTMENT_CLASSES), r.has_class("affiliation")])]
    mailto = F.regexp_extract(F.coalesce(r.attr("href"), F.lit("")), EMAIL, 0)
    picked = page.groupBy("page_id").agg(
        *name_rows,
        r.first(r.tag("title"), "text").alias("page_title"),
        titles.alias("titles"),
        *departments,
        r.first(joined_email(r.attr("data-user"), r.attr("data-domain")).isNotNull(), joined_email(r.attr("data-user"), r.attr("data-domain")).alias("email")).alias("spelled"),
        r.first(r.tag("a") & F.lower(r.attr("href")).startswith("mailto:") & (mailto != ""), mailto.alias("email")).alias("mailto"),
        r.first(r.tag("a") & r.attr("href").isNotNull() & F.lower("text").rlike(HOMEPAGE), r.attr("href").alias("href")).alias("home"),
        F.collect_list(r.photo()).alias("photos"),
        F.max(F.when(r.tag(PAGE), F.col("text"))).alias("source_text"),
        F.max(F.when(r.tag(PAGE), F.try_element_at("attrs", F.lit("script_chars")).cast("int"))).alias("script_chars"),
    )
    listed = sections(own)
    carried = F.col("school") if "school" in pages.columns else F.lit("")
    base = pages.select("page_id", "url", text_or_empty(carried).alias("school"))
    rows = base.join(picked.join(listed, "page_id", "left"), "page_id", "left").withColumn("source_text", text_or_empty("source_text"))
    chosen = [F.when(~F.col(f"name_{k}.x.hidden") & good_name(F.col(f"name_{k}.x.text")), F.struct(F.col(f"name_{k}.x.text").alias("name"), F.col(f"name_{k}.pos").alias("pos"))) for k in range(len(names))]
    short = F.trim(F.split(text_or_empty("page_title.text"), "[-|–—,/]")[0])
    by_class = [F.when((F.col(f"department_{k}.text") != "") & (F.length(f"department_{k}.text") <= DEPARTMENT_CHARS), F.col(f"department_{k}.text")) for k in range(len(departments))]
    rows = computed(
        rows.select(
            "page_id", "url", "school", "titles", "source_text", "photos", "affiliation", "expertise", *HEADINGS, F.coalesce(*chosen).alias("named"), short.alias("short"), F.col("page_title.pos").alias("short_pos"),
            F.regexp_replace(F.coalesce(*by_class), r"(?i)^Affiliation\s+", "").alias("unit"), F.coalesce("spelled.email", "mailto.email").alias("email"), F.col("home.href").alias("home"), F.coalesce("script_chars", F.lit(0)).alias("script_chars"),
        )
    )
    text, at = F.col("source_text"), F.coalesce("named.pos", "short_pos", F.lit(0))
    near = F.transform("titles", lambda t: F.struct(t["rank"].alias("rank"), F.abs(t["pos"] - at).alias("off"), t["pos"].alias("pos"), t["text"].alias("text")))
    stated = {f: F.coalesce(nz(f), *([nz("expertise")] if f == "research_interests" else []), nz(after_label(text, LABELS[f]))) for f in HEADINGS}
    stated["research_interests"] = F.coalesce(stated["research_interests"], nz(research_sentence(text)))
    out = computed(
        rows.select(
            "page_id",
            F.coalesce(recased(F.col("named.name")), F.when(good_name(F.col("short")), F.col("short")), F.lit("")).alias("name"),
            "school",
            F.coalesce(nz(F.substring("affiliation", 1, DEPARTMENT_CHARS)), nz("unit"), F.substring(after_label(text, LABELS["department"], FEW_STOPS), 1, DEPARTMENT_CHARS)).alias("department"),
            F.coalesce(F.array_min(near)["text"], F.regexp_extract(text, TITLE, 1)).alias("title"),
            F.coalesce("email", F.regexp_extract(text, EMAIL, 0)).alias("email"),
            "url",
            F.when(~is_blank("home"), absolute_url("home", "url")).alias("home"),
            *(F.coalesce(stated[f], F.lit("")).alias(f) for f in ("research_interests", "biography", "publications")),
            F.coalesce("photos", F.array()).alias("photos"),
            F.coalesce(stated["education"], F.lit("")).alias("education"),
            after_label(text, LABELS["advisor"], FEW_STOPS).alias("advisor"),
            F.substring(text, 1, SOURCE_CHARS).alias("source_text"),
            F.length(text).alias("visible_chars"),
            "script_chars",
        )
    )
    out = computed(out.withColumn("photo", best_photo(F.col("photos"), F.col("name"))).drop("photos"))
    photo = F.when(F.col("photo") != "", canonical_url(absolute_url("photo", "url")))
    out = computed(out.withColumns({"photo_url": F.coalesce(photo, F.lit("")), "personal_homepage": F.coalesce(F.when(F.col("home").isNotNull(), canonical_url("home")), F.lit(""))}))
    useful = ["name", "title", "email", "school", "department", "research_interests", "biography", "education", "advisor", "photo_url"]
    count = sum((F.when(~is_blank(c), 1).otherwise(0) for c in useful), F.lit(0))
    return out.withColumns({"n_useful": count, "confidence_score": share_of(useful)}).select("page_id", *COLUMNS, "n_useful", "visible_chars", "script_chars")


def is_probable_profile() -> Column:
    """A name, and either some confidence with a fact about a person or a person's address with less."""
    some = ~is_blank("email") | ~is_blank("title") | ~is_blank("research_interests") | ~is_blank("biography")
    named = ~is_blank("name") & ~F.col("name").rlike(GENERIC)
    return named & (((F.col("confidence_score") >= 0.45) & some) | (path("url").rlike(PROFILE_PATH) & (F.col("confidence_score") >= 0.35)))


def needs_escalation(least: float = 0.65) -> Column:
    """struct(needed, reason) of a profile row: pages about a person that rules read too poorly, by the first reason that holds."""
    text = F.col("source_text")
    no_section = is_blank("research_interests") & is_blank("biography") & is_blank("education") & is_blank("publications")
    reason = (
        F.when((F.col("n_useful") < 3) & (~is_blank("name") | text.rlike(TITLE) | text.rlike(EMAIL)), REASONS[0])
        .when(text.rlike(ESCALATION_LABELS) & no_section, REASONS[1])
        .when((F.col("script_chars") > 5000) & (F.col("visible_chars") < 1000), REASONS[2])
        .when((F.col("confidence_score") < least) & (~is_blank("name") | ~is_blank("email") | ~is_blank("title")), REASONS[3])
    )
    return F.struct(reason.isNotNull().alias("needed"), F.coalesce(reason, F.lit(REASONS[4])).alias("reason"))


def mark_escalations(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """pages with llm_status needs_llm or not_needed, and an issue for each page that needs it."""
    read = profiles(pages).select(F.col("page_id").alias("__id"), needs_escalation().alias("__e"))
    judged = pages.join(read, pages["page_id"] == F.col("__id"), "left")
    marked = judged.withColumn("llm_status", F.when(F.col("__e.needed"), "needs_llm").otherwise("not_needed"))
    issues = marked.filter("__e.needed").select(
        F.lit("pages").alias("related_table"), F.col("page_id").alias("related_id"), F.lit("llm_used").alias("issue_type"), F.lit("low").alias("severity"),
        F.concat(F.lit("Page marked for future LLM extraction: "), "__e.reason").alias("message"), F.col("url").alias("source_url"), F.lit("open").alias("status"),
    )
    return marked.drop("__id", "__e"), issues


# -- cards ------------------------------------------------------------------------------------------


def list_cards(pages: DataFrame) -> DataFrame:
    """People of list pages, one row a card: see `cards_of`; pages(page_id, url, html[, school])."""
    return cards_of(pages, elements(pages))


def cards_of(pages: DataFrame, el: DataFrame) -> DataFrame:
    """page_id, card (its place) and COLUMNS of the cards on pages(page_id, url[, school]).

    Cards are list items, articles, div elements with a class that names
    people, and JSON cards. A card's elements name it as an ancestor, so nested
    cards need no comparison of places. A card needs a name, and a title, an
    address or a link; the link is the best one, its text the name, else that
    of a heading, else the card's first words. Of cards with one folded name
    and address the first counts, JSON cards before all others; these are told
    apart by their place too.
    """
    r = Rows
    useful = r.tag("a", "img", "h2", "h3", "h4", "card") | r.class_part("name") | r.attr("data-user").isNotNull() | (F.array_position("cards", F.col("pos")) > 0)
    parts = el.filter((F.size("cards") > 0) & useful).withColumn("card", F.explode("cards"))
    inner = F.col("pos") != F.col("card")
    href = F.coalesce(r.attr("href"), F.lit(""))
    anchor = inner & r.tag("a") & F.map_contains_key("attrs", F.lit("href"))
    score = F.when(href.rlike(f"(?i){PROFILE_LINK}"), -3).otherwise(-1)
    mailto = F.regexp_extract(href, EMAIL, 0)
    spelled = joined_email(r.attr("data-user"), r.attr("data-domain"))
    heads = [r.tag("h2"), r.tag("h3"), r.tag("h4"), r.has_class("name"), r.class_part("name")]
    picked = parts.groupBy("page_id", "card").agg(
        F.min(F.when(~inner, F.col("text"))).alias("text"),
        F.max(F.when(~inner, F.col("tag") == "card")).alias("is_json"),
        *(F.max(F.when(~inner, F.coalesce(r.attr(a), F.lit("")))).alias(a) for a in ("name", "search", "departmentCode")),
        F.min(F.when(anchor & good_name(F.col("text")), F.struct(score.alias("rank"), "pos", "text", href.alias("href")))).alias("link"),
        r.first(anchor, href.alias("href")).alias("any_link"),
        *(r.first(inner & c, "text").alias(f"head_{k}") for k, c in enumerate(heads)),
        r.first(inner & spelled.isNotNull(), spelled.alias("email")).alias("spelled"),
        r.first(anchor & F.lower(href).startswith("mailto:") & (mailto != ""), mailto.alias("email")).alias("mailto"),
        F.collect_list(F.when(inner, r.photo())).alias("photos"),
    )
    carried = F.col("school") if "school" in pages.columns else F.lit("")
    base = pages.select("page_id", F.col("url").alias("base"), text_or_empty(carried).alias("school"))
    rows = picked.join(base, "page_id")
    text = F.col("text")
    headed = [F.when(good_name(F.col(f"head_{k}.text")), F.col(f"head_{k}.text")) for k in range(len(heads))]
    words = F.trim(F.split(text, r"\s{2,}|\||,", 2)[0])
    rows = computed(
        rows.select(
            "page_id", "card", "school", "base", "is_json", "text", "search", "departmentCode", "photos", F.col("name").alias("item"), F.coalesce("link.text", *headed).alias("named"), words.alias("words"),
            F.regexp_extract(F.col("text"), TITLE, 1).alias("title"), F.coalesce("spelled.email", "mailto.email", F.regexp_extract(text, EMAIL, 0)).alias("email"),
            F.col("link").isNotNull().alias("linked"), F.col("link.href").alias("href"), F.col("any_link.href").alias("any_href"),
        )
    )
    rows = computed(rows.withColumn("named", F.coalesce(recased(F.col("named")), F.when(good_name(F.col("words")), F.col("words")))))
    by_rule = F.length("text").between(8, CARD_CHARS) & F.col("named").isNotNull() & ((F.col("title") != "") | (F.col("email") != "") | F.col("linked"))
    by_item = F.col("is_json") & (F.col("item") != "") & ~F.col("item").rlike(GENERIC)
    rows = computed(rows.withColumn("whole", by_rule).filter(F.col("whole") | by_item))
    either = lambda a, b: F.when(F.col("whole"), a).otherwise(b)
    empty = F.lit("")
    rows = computed(
        rows.select(
            "page_id", "card", "school", "is_json", "whole", "base", either(F.col("named"), F.col("item")).alias("name"),
            either(F.substring(clean_text(F.regexp_extract(text, CARD_DEPARTMENT, 1)), 1, DEPARTMENT_CHARS), F.col("departmentCode")).alias("department"),
            either(F.col("title"), F.regexp_extract("search", TITLE, 1)).alias("title"), either(F.col("email"), empty).alias("email"),
            absolute_url(F.coalesce(nz(either(F.col("href"), F.col("any_href"))), "base"), "base").alias("url"),
            *(either(after_label(text, CARD_LABELS[f]), empty).alias(f) for f in ("research_interests", "education", "advisor")),
            either(best_photo(F.col("photos"), F.col("named")), empty).alias("photo"),
            F.substring(either(text, F.col("search")), 1, SOURCE_CHARS).alias("source_text"),
        )
    )
    photo = F.when(F.col("photo") != "", canonical_url(absolute_url("photo", "base")))
    rows = computed(rows.withColumns({"url": canonical_url("url"), "photo_url": F.coalesce(photo, empty)}))
    told = ["name", "title", "email", "school", "department", "research_interests", "education", "advisor", "photo_url"]
    by_title = F.when(F.col("title") != "", F.lit(JSON_CONFIDENCE[True])).otherwise(F.lit(JSON_CONFIDENCE[False]))
    rows = rows.withColumn("confidence_score", F.when(F.col("whole"), share_of(told)).otherwise(score_of(by_title.cast("decimal(9,4)"))))
    rows = rows.withColumns(dict.fromkeys(("personal_homepage", "biography", "publications"), empty))
    alike = Window.partitionBy("page_id", F.lower("name"), "url").orderBy(F.desc("is_json"), "card")
    return rows.withColumn("nth", F.row_number().over(alike)).filter("nth = 1 or is_json").select("page_id", "card", *COLUMNS)


# -- the extraction job -----------------------------------------------------------------------------


def extract_profiles(
    pages: DataFrame, lexicon: Lexicon, name_score: Column | None = None, least: float | None = None, limit: int | None = None, skipped: str = "skipped_name"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """People, issues, and pages(page_id, url, html, page_type, parser_status, seq[, school]) with their new status.

    Pages that wait for it are parsed once. List pages give their cards; pages
    without any their profile if it is probably one; what is left its cards
    after all. Each person is scored and reviewed as `accept_profiles` does;
    with `least`, those whose name scores less are left out. Pages get parsed,
    `skipped` if none of their people was kept, or no_profile; all others stay.
    """
    waiting = pages_to_extract(pages, limit)
    el = kept(elements(waiting))
    base = waiting.select("page_id", "url", "page_type", *(["school"] if "school" in pages.columns else []))
    cards = kept(cards_of(base, el))
    lists = base.filter("page_type = 'faculty_list'").select("page_id")
    from_lists = cards.join(lists, "page_id", "left_semi")
    left = base.join(from_lists.select("page_id").distinct(), "page_id", "left_anti")
    single = profiles_of(left, el.join(left.select("page_id"), "page_id", "left_semi")).filter(is_probable_profile()).select("page_id", F.lit(0).alias("card"), *COLUMNS)
    single = kept(single)
    rest = left.join(single.select("page_id"), "page_id", "left_anti").select("page_id")
    found = from_lists.unionByName(single).unionByName(cards.join(rest, "page_id", "left_semi"))
    people, issues = accept_profiles(found, lexicon, name_score if name_score is not None else F.lit(1).cast("decimal(9,4)"), least)
    people = kept(people)
    seen = found.select("page_id").distinct().join(people.select("page_id", F.lit(True).alias("saved")).distinct(), "page_id", "left")
    status = seen.select(F.col("page_id").alias("__id"), F.when(F.col("saved"), "parsed").otherwise(skipped).alias("__status"))
    asked = waiting.select(F.col("page_id").alias("__asked")).distinct()
    after = pages.join(asked, pages["page_id"] == F.col("__asked"), "left").join(status, F.col("page_id") == F.col("__id"), "left")
    now = F.when(F.col("__asked").isNull(), F.col("parser_status")).otherwise(F.coalesce("__status", F.lit("no_profile")))
    return people, issues, after.withColumn("parser_status", now).select(*pages.columns)
