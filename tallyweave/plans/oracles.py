"""DuckDB statements that give the same rows as the registered queries."""

from __future__ import annotations

from ..functions.urls import FACULTY, NOISE, ORGANIZATION, PERSON, TARGET_FIELD
from ..operators.pages import PROFILE_HINT

_NORM = "trim(regexp_replace(replace(lower(coalesce({0}, '')), 'ß', 'ss'), '\\s+', ' ', 'g'))"
_VENUE = "trim(regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]+', ' ', 'g'))"


def _norm(c: str) -> str:
    return _NORM.format(c)


def _venue(c: str) -> str:
    return _VENUE.format(c)


_LEVEL = "CASE o_orderpriority WHEN '1-URGENT' THEN 'A+(TOP)' WHEN '2-HIGH' THEN 'A+' WHEN '3-MEDIUM' THEN 'A1' WHEN '4-NOT SPECIFIED' THEN 'A2' ELSE 'A' END"

PARTY_ROLLUP = f"""
WITH base AS (
    SELECT c_name AS name, c_custkey % 100 / 100.0 AS score, CASE WHEN o_orderstatus = 'O' THEN 'first_author' ELSE 'corresponding_author' END AS role, {_LEVEL} AS lev,
           o_orderpriority AS journal, CAST(year(o_orderdate) AS VARCHAR) AS yr, c_mktsegment AS seg, o_orderkey AS seq
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_name IS NOT NULL),
keyed AS (SELECT *, CASE WHEN lev LIKE '%TOP%' THEN 'TOP' ELSE lev END AS k FROM base),
lev AS (SELECT name, '{{' || string_agg('"' || k || '":' || n, ',' ORDER BY k) || '}}' AS js FROM (SELECT name, k, count(*) AS n FROM keyed GROUP BY 1, 2) GROUP BY 1),
j AS (SELECT name, string_agg(v, '|' ORDER BY a) AS s FROM (SELECT name, journal AS v, min(seq) AS a FROM base GROUP BY 1, 2) GROUP BY 1),
y AS (SELECT name, string_agg(v, '|' ORDER BY a) AS s FROM (SELECT name, yr AS v, min(seq) AS a FROM base GROUP BY 1, 2) GROUP BY 1),
r AS (SELECT name, string_agg(v, '|' ORDER BY a) AS s FROM (SELECT name, role AS v, min(seq) AS a FROM base GROUP BY 1, 2) GROUP BY 1)
SELECT b.name, count(*) AS last_5_year_total, count(*) FILTER (WHERE role = 'first_author') AS first_author_total, count(*) FILTER (WHERE role = 'corresponding_author') AS corresponding_author_total,
       count(*) FILTER (WHERE b.lev LIKE '%TOP%') AS top_total, count(*) FILTER (WHERE b.lev LIKE 'A+%') AS a_plus_total, count(*) FILTER (WHERE b.lev = 'A') AS a_total,
       count(*) FILTER (WHERE b.lev = 'A1') AS a1_total, count(*) FILTER (WHERE b.lev = 'A2') AS a2_total, any_value(lev.js) AS level_counts_json,
       any_value(j.s) AS journals, any_value(y.s) AS years, any_value(r.s) AS author_roles, any_value(seg) AS affiliations, count(DISTINCT seq) AS n_links,
       CASE WHEN max(score) >= 0.7 AND (count(*) >= 2 OR count(*) FILTER (WHERE b.lev LIKE 'A+%') > 0) THEN 'strong_candidate' WHEN max(score) >= 0.45 THEN 'needs_review' ELSE 'rejected' END AS review_status
FROM base b JOIN lev USING (name) JOIN j USING (name) JOIN y USING (name) JOIN r USING (name) GROUP BY b.name
"""

VENUE_QUALITY_REPORT = f"""
WITH p AS (SELECT n_name, count(*) AS papers, count(*) FILTER (WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE')) AS openalex_papers, count(*) FILTER (WHERE c_mktsegment <> 'BUILDING') AS crossref_papers,
        count(*) FILTER (WHERE c_mktsegment = 'AUTOMOBILE') AS merged_papers, count(*) FILTER (WHERE c_acctbal < 500) AS missing_author, count(*) FILTER (WHERE c_custkey % 7 = 0) AS missing_affiliation
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
c AS (SELECT n_name, count(*) AS candidates, count(*) FILTER (WHERE s_suppkey % 100 >= 45) AS scored_candidates FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1),
e AS (SELECT name AS n_name, count(*) AS errors FROM (
    SELECT m.n_nationkey, arg_min(d.n_name, (CASE WHEN d.n_nationkey % 2 = 0 THEN 1 ELSE 3 END, d.n_name)) AS name
    FROM nation m JOIN nation d ON contains({_venue("'no rows for ' || m.n_name")}, {_venue('d.n_name')}) GROUP BY 1) GROUP BY 1)
SELECT n.n_name AS journal_name, CASE WHEN n.n_nationkey % 2 = 0 THEN 'A+' ELSE 'A1' END AS achievement_level, coalesce(papers, 0) AS papers, coalesce(openalex_papers, 0) AS openalex_papers, coalesce(crossref_papers, 0) AS crossref_papers, coalesce(merged_papers, 0) AS merged_papers,
       coalesce(candidates, 0) AS candidates, coalesce(scored_candidates, 0) AS scored_candidates, coalesce(missing_author, 0) AS missing_author, coalesce(missing_affiliation, 0) AS missing_affiliation, coalesce(errors, 0) AS errors
FROM nation n LEFT JOIN p USING (n_name) LEFT JOIN c USING (n_name) LEFT JOIN e USING (n_name)
WHERE coalesce(papers, 0) + coalesce(candidates, 0) + coalesce(errors, 0) > 0
"""

SUBSTRING_ATTRIBUTION = f"""
WITH d AS (SELECT doc_id, {_venue('text')} AS t FROM documents), b AS (SELECT item_id, {_venue('text')} AS t FROM benchmark)
SELECT doc_id, min(item_id) AS item_id FROM d JOIN b ON b.t <> '' AND contains(d.t, b.t) GROUP BY doc_id
"""

NORM_TEXT_HASH = f"SELECT sha1({_norm('text')}) AS text_sha1, count(*) AS n_docs, min(doc_id) AS first_doc FROM documents GROUP BY 1"

CONTENT_DUPES = """
SELECT doc_id, first_doc, sha1 FROM (
    SELECT doc_id, sha1(coalesce(text, '')) AS sha1, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_doc FROM documents)
WHERE doc_id <> first_doc
"""

_FEED = "(SELECT user_id, CASE WHEN event_id % 3 = 0 THEN '' ELSE props END AS props, event_type, value, event_id AS seq FROM events)"

UPSERT_LAST_NONEMPTY = f"""
WITH t AS (SELECT user_id, string_agg(event_type, ',' ORDER BY a) AS event_type FROM (SELECT user_id, event_type, min(seq) AS a FROM {_FEED} GROUP BY 1, 2) GROUP BY 1)
SELECT user_id, coalesce(arg_max(props, seq) FILTER (WHERE props <> ''), '') AS props, any_value(t.event_type) AS event_type, max(value) AS value, max(seq) AS seq
FROM {_FEED} f JOIN t USING (user_id) GROUP BY user_id
"""

UPSERT_LAST_WINS = f"""
WITH old AS (SELECT user_id, arg_max(props, seq) AS props, arg_max(event_type, seq) AS event_type, arg_max(value, seq) AS value, max(seq) AS seq, 0 AS new FROM {_FEED} WHERE seq % 2 = 0 GROUP BY 1),
both_ AS (SELECT * FROM old UNION ALL BY NAME SELECT *, 1 AS new FROM {_FEED} WHERE seq % 2 = 1)
SELECT user_id, arg_max(props, (new, seq)) AS props, arg_min(event_type, (new, seq)) AS event_type, arg_max(value, (new, seq)) AS value, max(seq) AS seq FROM both_ GROUP BY 1
"""

INSERT_IGNORE = f"""
WITH t AS (SELECT user_id, arg_min(event_type, seq) AS event_type, max(seq) AS seq FROM {_FEED} WHERE event_type = 'click' GROUP BY 1)
SELECT * FROM t UNION ALL
SELECT user_id, arg_min(event_type, seq), min(seq) FROM {_FEED} WHERE user_id NOT IN (SELECT user_id FROM t) GROUP BY 1
"""

ADDITIVE_COUNTERS = f"SELECT user_id, CAST(count(*) AS BIGINT) AS attempts, CAST(sum(TRY_CAST(json_extract_string(nullif(props, ''), '$.k') AS BIGINT)) AS BIGINT) AS seen FROM {_FEED} GROUP BY 1"

DUPLICATE_COLLAPSE = """
WITH r AS (
    SELECT c_custkey AS id, c_nationkey AS nation, c_mktsegment AS segment, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_name END AS email, CASE WHEN c_custkey % 5 <> 0 THEN '' ELSE c_name END AS phone,
           c_acctbal AS balance, c_custkey % 11 = 0 AS flagged FROM customer),
q AS (SELECT *, (CASE WHEN email <> '' THEN 1 ELSE 0 END + CASE WHEN phone <> '' THEN 1 ELSE 0 END, floor(balance), id) AS rank FROM r)
SELECT nation, segment, arg_max(id, rank) AS id, coalesce(nullif(arg_max(email, rank), ''), arg_max(email, rank) FILTER (WHERE email <> ''), '') AS email,
       coalesce(nullif(arg_max(phone, rank), ''), arg_max(phone, rank) FILTER (WHERE phone <> ''), '') AS phone, max(balance) AS balance,
       CASE WHEN bool_or(flagged) THEN 'needs_review' ELSE 'accepted' END AS status, count(*) - 1 AS n_merged
FROM q GROUP BY 1, 2
"""

PREFER_EXISTING = """
WITH p AS (SELECT s_nationkey AS k, arg_min(s_suppkey, (NOT (s_acctbal > 5000), s_suppkey)) AS person_id FROM supplier GROUP BY 1)
SELECT c_custkey, c_nationkey AS normalized_name, person_id FROM customer LEFT JOIN p ON c_nationkey = k
"""


def _has(text: str, keyword: str) -> str:
    return f"regexp_matches({text}, '(^|[^a-z0-9]){keyword}($|[^a-z0-9])')"


def _hits(text: str, words: list[str]) -> str:
    return "(" + " + ".join(f"CASE WHEN {_has(text, w)} THEN 1 ELSE 0 END" for w in words) + ")"


def _reason(text: str, words: list[str]) -> str:
    listed = ", ".join(f"CASE WHEN {_has(text, w)} THEN '{w}' END" for w in sorted(words))
    return f"array_to_string(list_filter([{listed}], lambda x: x IS NOT NULL), ', ')"


def _gain(weight: str, hits: str) -> str:
    return f"CASE WHEN {hits} > 0 THEN CAST({weight} AS DECIMAL(9,4)) * least(CAST(1 AS DECIMAL(9,4)), CAST(0.55 AS DECIMAL(9,4)) + CAST(0.15 AS DECIMAL(9,4)) * {hits}) ELSE 0 END"


_GROUPS = {"colours": ["red", "blue", "green"], "sizes": ["small", "large"], "objects": ["widget", "ring"]}
_FIELDS = {"n": "0.35", "t": "0.30", "b": "0.08"}
_ALL_WORDS = [w for words in _GROUPS.values() for w in words]

LEXICON_SCORE_FIELDS = f"""
WITH x AS (SELECT p_partkey, {_norm('p_name')} AS n, {_norm('p_type')} AS t, {_norm('p_brand')} AS b FROM part),
y AS (SELECT *, n || ' ' || t || ' ' || b AS e FROM x),
z AS (SELECT p_partkey, {' + '.join(_gain(w, _hits(f, words)) for words in _GROUPS.values() for f, w in _FIELDS.items())} AS parts, {_hits('e', ['ring'])} AS strong,
             {' + '.join(f'CASE WHEN {_hits("e", words)} > 0 THEN 1 ELSE 0 END' for words in _GROUPS.values())} AS n_groups, {_hits('e', ['old'])} AS hard, {_hits('e', ['cold'])} AS soft, {_reason('e', _ALL_WORDS)} AS reason FROM y),
s AS (SELECT p_partkey, reason, least(1, greatest(0, CASE WHEN n_groups > 0 THEN greatest(0.45, parts + least(0.2, 0.08 * strong) + CASE WHEN n_groups >= 2 THEN 0.1 ELSE 0 END) ELSE parts + least(0.2, 0.08 * strong) END
             - CASE WHEN hard > 0 THEN 0.25 ELSE 0 END - CASE WHEN soft > 0 THEN 0.08 ELSE 0 END)) AS score FROM z)
SELECT p_partkey, CAST(round(score, 2) AS DOUBLE) AS score, CASE WHEN round(score, 2) >= 0.6 THEN 'accepted' WHEN round(score, 2) >= 0.45 THEN 'needs_review' ELSE 'rejected' END AS status, reason FROM s
"""

_TEXT_SCORES = f"""
SELECT doc_id, source, round(least(1, greatest(0, {_gain('0.4', _hits('t', ['the', 'and']))} + {_gain('0.35', _hits('t', ['der', 'und']))}
       - CASE WHEN {_hits('t', ['idiot'])} > 0 THEN 0.35 ELSE 0 END - CASE WHEN {_hits('t', ['license'])} > 0 THEN 0.15 ELSE 0 END)), 2) AS score, {_reason('t', ['the', 'and', 'der', 'und'])} AS reason
FROM (SELECT doc_id, source, {_norm('text')} AS t FROM documents)
"""

LEXICON_SCORE_TEXT = f"""
SELECT doc_id, CAST(score AS DOUBLE) AS score, CASE WHEN score >= 0.6 THEN 'accepted' WHEN score >= 0.35 THEN 'needs_review' ELSE 'rejected' END AS status, reason FROM ({_TEXT_SCORES})
"""

GATE_WITH_REJECT_LOG = f"""
SELECT 'doc:' || doc_id AS url, CASE WHEN score >= 0.35 THEN 'kept' ELSE 'rejected' END AS outcome, CASE WHEN score >= 0.35 THEN '' ELSE 'rejected: ' || substr(coalesce(source, ''), 1, 80) END AS message
FROM (SELECT doc_id, source, score FROM ({_TEXT_SCORES}))
"""

RULE_SCORE_NAMES = """
WITH t AS (SELECT p_partkey, list_filter(regexp_split_to_array(lower(p_name), '[^a-z]+'), lambda x: x <> '') AS w, lower(p_type) AS c FROM part),
k AS (SELECT *, len(list_filter([w[1], w[len(w)]], lambda x: x IN ('small', 'red', 'ring'))) > 0 AS lex, list_filter(w, lambda x: x NOT IN ('small', 'red', 'ring')) AS o, list_contains(w, 'gear') AS stopped FROM t),
r AS (SELECT *, len(o) > 0 AND len(list_filter(o, lambda x: NOT regexp_full_match(x, '[a-z]{3,6}'))) = 0 AS shape, len(list_filter(w, lambda x: length(x) = 1)) > 0 AS ini, contains(c, 'large') AS ctx, len(w) BETWEEN 2 AND 4 AS lens FROM k),
s AS (SELECT *, CASE WHEN stopped THEN 0.05 ELSE least(0.95, CASE WHEN lex THEN 0.45 ELSE 0 END + CASE WHEN shape THEN 0.2 ELSE 0 END + CASE WHEN ini THEN 0.1 ELSE 0 END + CASE WHEN ctx THEN 0.15 ELSE 0 END + CASE WHEN lens THEN 0.05 ELSE 0 END) END AS score FROM r)
SELECT p_partkey, CAST(score AS DOUBLE) AS score, CAST(score >= 0.7 AS INTEGER) AS flag,
       CASE WHEN stopped THEN 'stop token' ELSE array_to_string(list_filter([CASE WHEN lex THEN 'lexicon token' END, CASE WHEN shape THEN 'token shape' END, CASE WHEN ini THEN 'initial' END, CASE WHEN ctx THEN 'context' END, CASE WHEN lens THEN 'length' END], lambda x: x IS NOT NULL), ', ') END AS reason
FROM s
"""

VARIANT_MATCH = f"""
WITH p AS (SELECT DISTINCT p_name FROM part), a AS (SELECT upper(p_name || '-Section B') AS alias FROM p),
pv AS (SELECT p_name, {_venue('p_name')} AS v FROM p),
av AS (SELECT alias, {_venue('x')} AS v FROM a, unnest([alias, split_part(alias, '-', 1), regexp_replace(alias, '^[^-]*-', '')]) AS u(x))
SELECT DISTINCT p_name, alias FROM pv JOIN av USING (v) WHERE length(v) >= 5
"""

WINDOW_FILTER = "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE year(o_orderdate) BETWEEN 1995 AND 1999"

SEMI_GROUP_SELECT = """
SELECT n_name AS journal_name, CASE WHEN n_nationkey % 3 = 0 THEN 'A+(TOP)' ELSE 'A2' END AS achievement_level, CAST(n_nationkey AS VARCHAR) AS issn_cn
FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'
"""

_LINES = "(SELECT l_orderkey AS paper_id, l_suppkey, min(l_linenumber) AS n, count(*) AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY min(l_linenumber), l_suppkey) AS place, count(*) OVER (PARTITION BY l_orderkey) AS size FROM lineitem GROUP BY 1, 2)"

ROLE_EXPLODE = f"""
SELECT paper_id, 'S' || l_suppkey AS name, CASE WHEN place = 1 THEN 'first_author' ELSE 'corresponding_author' END AS author_role,
       CASE WHEN k > 1 THEN 'dept' || n ELSE 'order' || paper_id END AS affiliations FROM {_LINES}
"""

ZIP_FILL = f"""
SELECT paper_id, string_agg('S' || l_suppkey || ':' || CASE WHEN k > 1 THEN 'dept' || n WHEN paper_id % 2 = 0 THEN 'at S' || l_suppkey WHEN size = 2 THEN CASE WHEN place = 1 THEN 'x' ELSE 'y' END ELSE 'x,y' END, ';' ORDER BY place) AS authors
FROM {_LINES} GROUP BY 1
"""

JSON_STATS = """
WITH e AS (SELECT event_type, CASE WHEN event_id % 10 IN (0, 1) THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events)
SELECT event_type, count(*) FILTER (WHERE k IS NULL) AS n_unusable, CAST(sum(k) AS BIGINT) AS total, max(CASE WHEN k IS NULL THEN '{}' ELSE '{"k":' || k || '}' END) AS largest FROM e GROUP BY 1
"""

_PEOPLE = """(SELECT c_custkey AS id, c_name AS name, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment END AS school, c_custkey % 3 = 0 AS no_home, c_custkey % 5 = 0 AS no_mail, CAST(c_custkey % 10 AS DECIMAL(9,4)) / 10 AS conf,
    CASE c_custkey % 6 WHEN 0 THEN 'accepted' WHEN 1 THEN 'rejected' WHEN 2 THEN 'new' ELSE 'needs_review' END AS review_status, c_custkey % 2 = 0 AS relevant, c_custkey % 2 = 1 AND CAST((c_custkey % 7) / 7.0 AS DECIMAL(9,4)) < 0.5 AS unsure FROM customer)"""
_ORDER_RULES = "(SELECT o_custkey AS person_id, o_orderkey AS seq, o_orderstatus, o_orderkey % 4 = 0 AS bare, o_orderkey % 2 = 1 AS flag, (o_orderkey % 10) < 7 AS low, o_orderstatus = 'P' AS review, floor(o_totalprice / 50000) >= 5 AS many FROM orders)"
_ISSUES = f"""(SELECT person_id, seq, issue_type, severity, message, CASE WHEN o_orderstatus = 'F' THEN 'resolved' ELSE 'open' END AS status FROM (
    SELECT person_id, seq, o_orderstatus, 'missing_affiliation' AS issue_type, 'medium' AS severity, 'no affiliation' AS message, 1 AS place FROM {_ORDER_RULES} WHERE bare
    UNION ALL SELECT person_id, seq, o_orderstatus, 'weak_name_score', 'low', 'name score is low', 2 FROM {_ORDER_RULES} WHERE flag AND low
    UNION ALL SELECT person_id, seq, o_orderstatus, 'publication_only_needs_review', 'medium', 'candidate needs review', 3 FROM {_ORDER_RULES} WHERE review
    UNION ALL SELECT person_id, seq, o_orderstatus, 'high_output_no_affiliation', 'high', 'five papers or more and no affiliation', 4 FROM {_ORDER_RULES} WHERE flag AND many AND bare))"""
_WEIGHT = "CASE issue_type WHEN 'high_output_no_affiliation' THEN 10 WHEN 'missing_affiliation' THEN 8 WHEN 'publication_only_needs_review' THEN 5 WHEN 'weak_name_score' THEN 4 ELSE 1 END"

ISSUE_RULES = f"SELECT issue_type, severity, status, count(*) AS n, min(seq) AS first_seq, max(person_id) AS last_person FROM {_ISSUES} GROUP BY 1, 2, 3"

_BUCKETS = f"""(
    SELECT person_id, coalesce(string_agg(v, ' | ' ORDER BY a, v) FILTER (WHERE status = 'open' AND kind = 'issue_type'), '') AS open_issue_types,
           coalesce(string_agg(v, ' | ' ORDER BY a, v) FILTER (WHERE status = 'open' AND kind = 'severity'), '') AS open_severities,
           coalesce(string_agg(v, ' | ' ORDER BY a, v) FILTER (WHERE status = 'resolved' AND kind = 'issue_type'), '') AS resolved_issue_types,
           CAST(coalesce(sum(w) FILTER (WHERE status = 'open' AND kind = 'issue_type'), 0) AS BIGINT) AS open_weight, CAST(coalesce(sum(n) FILTER (WHERE status = 'open' AND kind = 'issue_type'), 0) AS BIGINT) AS open_issues
    FROM (SELECT person_id, status, 'issue_type' AS kind, issue_type AS v, min(seq) AS a, count(*) AS n, sum({_WEIGHT}) AS w FROM {_ISSUES} GROUP BY ALL
          UNION ALL SELECT person_id, status, 'severity', severity, min(seq), count(*), 0 FROM {_ISSUES} GROUP BY ALL) GROUP BY 1)"""

ISSUE_BUCKETS = f"SELECT * FROM {_BUCKETS}"

REVIEW_QUEUE = f"""
WITH x AS (SELECT p.*, coalesce(open_issue_types, '') AS types, coalesce(open_severities, '') AS sev, coalesce(open_weight, 0) AS weight FROM {_PEOPLE} p LEFT JOIN {_BUCKETS} b ON p.id = b.person_id),
s AS (SELECT *, greatest(0, 10 * conf - CAST(0.5 AS DECIMAL(9,4)) * weight - CASE WHEN school = '' THEN 2 ELSE 0 END - CASE WHEN no_home THEN 1 ELSE 0 END - CASE WHEN no_mail THEN 1.5 ELSE 0 END - CASE WHEN relevant THEN 0 ELSE 1.5 END) AS score FROM x)
SELECT id, CAST(round(score, 3) AS DOUBLE) AS priority, CASE WHEN score >= 8 THEN 'high' WHEN score >= 5 THEN 'medium' WHEN score >= 2 THEN 'low' ELSE 'deferred' END AS tier,
       CAST(school = '' AS INTEGER) AS gap_missing_school, CAST(no_home AS INTEGER) AS gap_missing_homepage, CAST(no_mail AS INTEGER) AS gap_missing_email, CAST(conf < 0.6 AS INTEGER) AS gap_low_confidence,
       CAST(contains(types, 'name_filter_uncertain') AS INTEGER) AS gap_name_conflict, CAST(unsure AS INTEGER) AS gap_discipline_uncertain, CAST(contains(types, 'high_output_no_affiliation') AS INTEGER) AS gap_high_output_no_affiliation
FROM s
"""


def _gap(position: int, category: str, table: str, count: str, met: str, label: str = "name", seq: str = "id") -> str:
    return f"""SELECT {position} AS position, '{category}' AS category, (SELECT CAST({count} AS BIGINT) FROM {table} AS t) AS count,
        coalesce((SELECT string_agg(x, '; ' ORDER BY s, x) FROM (SELECT {label} AS x, {seq} AS s FROM {table} AS t WHERE {met} ORDER BY s, x LIMIT 3)), '') AS examples"""


GAP_REPORT = " UNION ALL ".join(
    [
        _gap(1, "missing_school", _PEOPLE, "count(*) FILTER (WHERE school = '')", "school = ''"),
        _gap(2, "missing_homepage_email", _PEOPLE, "count(*) FILTER (WHERE no_home) + count(*) FILTER (WHERE no_mail)", "no_home OR no_mail"),
        _gap(3, "low_confidence", _PEOPLE, "count(*) FILTER (WHERE conf < 0.6)", "conf < 0.6"),
        "SELECT 4, 'name_conflict', (SELECT count(*) FROM (SELECT lower(name), lower(school) FROM " + _PEOPLE + " GROUP BY 1, 2 HAVING count(*) > 1)), ''",
        _gap(5, "discipline_uncertain", _PEOPLE, "count(*) FILTER (WHERE unsure)", "unsure"),
        _gap(6, "source_errors", _ISSUES, "count(*) FILTER (WHERE severity IN ('high', 'medium'))", "severity IN ('high', 'medium')", "issue_type || ': ' || substr(message, 1, 40)", "seq"),
        "SELECT 7, 'abstract_missing', CAST(0 AS BIGINT), ''",
    ]
)

ROSTER_SPLIT = f"""
SELECT CASE review_status WHEN 'accepted' THEN 'confirmed' WHEN 'needs_review' THEN 'deferred' ELSE 'rejected' END AS roster, count(*) AS n, min(id) AS first_id, max(id) AS last_id
FROM {_PEOPLE} WHERE review_status <> 'new' GROUP BY 1
"""

DECISION_WRITEBACK = f"""
WITH d AS (SELECT o_custkey AS person_id, o_orderkey AS seq, CASE o_orderstatus WHEN 'O' THEN 'accepted' WHEN 'F' THEN 'rejected' ELSE '' END AS decision, CASE WHEN o_orderkey % 2 = 0 THEN 'note ' || o_orderkey ELSE '' END AS note, o_orderkey % 5 = 0 AS resolves FROM orders),
l AS (SELECT person_id, arg_max(decision, seq) FILTER (WHERE decision <> '') AS decision, arg_max(note, seq) FILTER (WHERE note <> '') AS note FROM d GROUP BY 1),
r AS (SELECT DISTINCT person_id FROM d WHERE resolves),
o AS (SELECT person_id, count(*) AS n FROM {_ISSUES} WHERE status = 'open' AND NOT (issue_type IN ('missing_affiliation', 'publication_only_needs_review') AND person_id IN (SELECT person_id FROM r)) GROUP BY 1)
SELECT id, coalesce(decision, review_status) AS review_status, coalesce(decision, '') AS review_decision, coalesce(note, '') AS review_decision_note, coalesce(n, 0) AS open_issues
FROM {_PEOPLE} p LEFT JOIN l ON p.id = l.person_id LEFT JOIN o ON p.id = o.person_id
"""

EVIDENCE_MERGE = """
WITH p AS (
    SELECT o_custkey AS person_id, CASE WHEN o_orderstatus = 'O' THEN 'school' ELSE 'title' END AS field, 'v' || (o_orderkey % 13) AS v,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'semantic_scholar' WHEN '2-HIGH' THEN 'dblp' WHEN '3-MEDIUM' THEN 'crossref' ELSE 'unknown' END AS source,
           CASE o_orderpriority WHEN '1-URGENT' THEN 3 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 1 ELSE 0 END AS rank, (o_orderkey % 9) / 10.0 AS confidence, CASE WHEN o_custkey % 2 = 0 THEN 'v1' ELSE '' END AS cur FROM orders),
k AS (SELECT * FROM p WHERE v <> cur AND person_id % 17 <> 0 AND (cur = '' OR rank >= 1)),
w AS (SELECT *, row_number() OVER (PARTITION BY person_id, field ORDER BY rank DESC, confidence DESC, v DESC, source DESC) AS n, count(DISTINCT v) OVER (PARTITION BY person_id, field) AS n_values FROM k)
SELECT person_id, field, v AS value, source, rank, CAST(confidence AS DOUBLE) AS confidence, confidence < 0.7 AS requires_review, n_values FROM w WHERE n = 1
"""

RUN_STATUS = """
WITH i AS (SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS BIGINT) AS run_id, CASE WHEN o_orderstatus = 'P' AND o_orderkey % 50 = 0 THEN 'failed' WHEN o_orderstatus = 'P' AND month(o_orderdate) = 3 THEN 'pending' ELSE 'completed' END AS s FROM orders)
SELECT run_id, count(*) FILTER (WHERE s = 'pending') AS pending, CAST(0 AS BIGINT) AS running, count(*) FILTER (WHERE s = 'completed') AS completed, count(*) FILTER (WHERE s = 'failed') AS failed,
       CASE WHEN bool_and(s = 'completed') THEN 'completed' ELSE 'partial' END AS run_status FROM i GROUP BY 1
"""

FFILL_PAIRS = """
SELECT event_id, user_id, last_value(CASE WHEN event_type = 'click' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM events
"""

BEST_LOOKUP = """
WITH v AS (SELECT n_name AS q, CASE WHEN s_suppkey % 4 = 3 THEN n_name ELSE s_name END AS display, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT n_name AS journal, coalesce(CAST(arg_min(s_suppkey, (display <> q, s_suppkey)) AS VARCHAR), '') AS source_id FROM nation LEFT JOIN v ON n_name = q GROUP BY 1
"""

_CANON = """(SELECT page_id, url, 'https://' || regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]*)', 1)), ':(80|443)$', '')
    || regexp_replace(CASE WHEN regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1) END, '/+$', '/')
    || CASE WHEN regexp_extract(url, '\\?([^#]*)', 1) = '' THEN '' ELSE '?' || array_to_string(list_sort(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&')), '&') END AS canonical FROM pages)"""

CANONICAL_URLS = f"SELECT page_id, canonical FROM {_CANON}"

URL_CLUSTERS = f"SELECT regexp_extract(canonical, '^https://([^/]*)', 1) AS host, count(*) AS n, count(DISTINCT canonical) AS n_urls, min(page_id) AS first_page FROM {_CANON} GROUP BY 1"

CONTACT_EXTRACT = """
WITH t AS (SELECT doc_id, text, regexp_replace(regexp_replace(coalesce(text, ''), '<[^>]+>', ' ', 'gs'), '\\s+', ' ', 'g') AS v FROM documents),
e AS (SELECT doc_id, lower(regexp_extract(v, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}')) AS email FROM t)
SELECT doc_id, sha1(email) AS email_sha1 FROM e WHERE email <> ''
"""

PAGE_CLASS = f"""
WITH t AS (
    SELECT page_id, html, len(regexp_extract_all(html, '(?i)href\\s*=\\s*["'']?[^"''\\s>]*(?:/faculty/|/people/|/profiles/)[^/"''\\s>]+')) AS n,
           lower(url || ' ' || substr(trim(regexp_replace(regexp_replace(regexp_replace(html, '<(?:script|style|noscript)\\b[^>]*>.*?</(?:script|style|noscript)\\s*>', ' ', 'gis'), '<[^>]+>', ' ', 'gs'), '\\s+', ' ', 'g')), 1, 5000)) AS seen FROM pages),
k AS (SELECT page_id, CASE WHEN contains(html, 'fd-content-json') THEN 1 WHEN n >= 8 THEN 2 WHEN regexp_matches(seen, '{PROFILE_HINT}') AND regexp_matches(seen, '@|biography|research|education') THEN 3
      WHEN regexp_matches(seen, '{FACULTY}') THEN 4 WHEN regexp_matches(seen, '{ORGANIZATION}') THEN 5 ELSE 6 END AS k FROM t)
SELECT page_id, ['faculty_list', 'faculty_list', 'faculty_profile', 'faculty_list', 'organization', 'unknown'][k] AS page_type, CAST([0.86, 0.82, 0.82, 0.65, 0.55, 0.25][k] AS DOUBLE) AS score FROM k
"""

_HREFS = """(SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '(?is)<a\\s[^>]*?href\\s*=\\s*["'']?([^"''\\s>]*)["'']?[^>]*>(.*?)</a>', 1)) AS href FROM pages)"""

FRONTIER_ROUNDS = f"""
WITH seed AS (SELECT page_id FROM pages WHERE regexp_extract(url, '^https?://([^/?#]*)', 1) = 'spam-farm.example.org'), h AS (SELECT * FROM {_HREFS}),
one AS (SELECT DISTINCT href FROM h WHERE page_id IN (SELECT page_id FROM seed)),
two AS (SELECT DISTINCT page_id FROM h WHERE href IN (SELECT href FROM one) AND page_id NOT IN (SELECT page_id FROM seed))
SELECT 'p' || page_id AS node, 0 AS round FROM seed UNION ALL SELECT 'l' || href, 1 FROM one UNION ALL SELECT 'p' || page_id, 2 FROM two
"""

PAGE_LINKS = f"""
WITH l AS (
    SELECT page_id, url AS base, regexp_extract(url, '^(https?://[^/?#]*)', 1) AS site,
           unnest(range(len(regexp_extract_all(html, '{{A}}', 1)))) AS pos, regexp_extract_all(html, '{{A}}', 1) AS hrefs, regexp_extract_all(html, '{{A}}', 2) AS texts FROM pages),
a AS (SELECT page_id, base, site, pos, hrefs[pos + 1] AS href, trim(regexp_replace(regexp_replace(texts[pos + 1], '<[^>]+>', ' ', 'gs'), '\\s+', ' ', 'g')) AS anchor FROM l),
u AS (SELECT page_id, pos, anchor, 'https://' || lower(regexp_extract(site, '^https?://(.*)$', 1)) || regexp_replace(regexp_extract(href, '^([^?#]*)', 1), '/+$', '/') AS url FROM a),
f AS (SELECT page_id, url, min(pos) AS pos, arg_min(anchor, pos) AS anchor FROM u WHERE NOT regexp_matches(url, '(?i)\\.(?:pdf|docx?|xlsx?|pptx?|zip|jpg|jpeg|png|gif|svg)$') GROUP BY 1, 2),
k AS (SELECT *, lower(url || ' ' || anchor) AS seen FROM f),
c AS (SELECT *, CASE WHEN regexp_matches(seen, '{NOISE}') THEN 'noise' WHEN regexp_matches(seen, '{FACULTY}') THEN CASE WHEN regexp_matches(seen, '{PERSON}') THEN 'faculty_candidate' ELSE 'faculty_list' END
      WHEN regexp_matches(seen, '{ORGANIZATION}') THEN 'organization' ELSE 'unknown' END AS kind, regexp_matches(seen, '{TARGET_FIELD}') AS hit FROM k),
s AS (SELECT *, CASE kind WHEN 'noise' THEN 0.1 WHEN 'faculty_candidate' THEN CASE WHEN hit THEN 0.86 ELSE 0.78 END WHEN 'faculty_list' THEN CASE WHEN hit THEN 0.76 ELSE 0.68 END WHEN 'organization' THEN CASE WHEN hit THEN 0.67 ELSE 0.55 END ELSE 0.25 END AS score FROM c),
r AS (SELECT page_id, pos, url, anchor, kind, CAST(score AS DOUBLE) AS score, CAST(row_number() OVER (PARTITION BY page_id ORDER BY score DESC, pos) AS INTEGER) AS rank FROM s WHERE kind <> 'noise')
SELECT * FROM r WHERE rank <= 5
""".replace("{A}", "(?is)<a\\s[^>]*?href\\s*=\\s*[\"'']?([^\"''\\s>]*)[\"'']?[^>]*>(.*?)</a>")
