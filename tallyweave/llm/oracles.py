"""DuckDB statements that give the same rows as the queries of the same name."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1_URL_FILTERS = f"""
WITH rules(rhost, rpath, rverdict) AS (VALUES
    ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'block'),
    ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
rest AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
urls AS (
    SELECT row_number() OVER () AS n, page_id,
           translate(regexp_extract(r, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host,
           regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest),
fits AS (
    SELECT n, page_id, host, path, rhost || rpath AS rule, rverdict,
           row_number() OVER (PARTITION BY n ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS k
    FROM urls LEFT JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM fits WHERE k = 1
"""

OP10_DECONTAMINATION = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, least(13, len(w)) AS k, array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS win
    FROM item_words, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS t(s)
    WHERE len(w) > 0),
sizes AS (SELECT DISTINCT k FROM windows),
starts AS (
    SELECT doc_id, k, s, array_to_string(w[s:s + k - 1], ' ') AS win
    FROM doc_words, sizes, unnest(range(1, len(w) - k + 2)) AS t(s)),
hits AS (SELECT doc_id, item_id, s, starts.k FROM starts JOIN windows USING (k, win)),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(range(s, s + k)) AS t(p) GROUP BY doc_id),
hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

OP9_MIXING = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(coalesce(text, '')) AS digest,
           row_number() OVER (PARTITION BY doc_id, source, md5(coalesce(text, ''))) AS copy
    FROM documents),
shuffled AS (
    SELECT *, substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || digest || ':' || copy || ':mix-1'), 1, 16) AS place FROM sized),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rnk FROM sources),
weighed AS (SELECT *, CASE (rnk - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM ranked),
held AS (
    SELECT *, CAST(2.0 AS DOUBLE) * source_size / weight AS hold_at, sum(source_size) OVER () AS all_size, sum(weight) OVER () AS all_weight FROM weighed),
running AS (
    SELECT *, sum(source_size) OVER (ORDER BY hold_at, rnk) AS size_upto, sum(weight) OVER (ORDER BY hold_at, rnk) AS weight_upto FROM held),
levels AS (
    SELECT *, (CAST(1.5 AS DOUBLE) * CAST(all_size AS DOUBLE) - CAST(2 * (size_upto - source_size) AS DOUBLE)) / CAST(all_weight - weight_upto + weight AS DOUBLE) AS lev FROM running),
targets AS (
    SELECT source, source_size, rnk, coalesce(least(CAST(2 * source_size AS DOUBLE), max(CASE WHEN lev <= hold_at THEN lev END) OVER () * weight), CAST(2 * source_size AS DOUBLE)) AS target FROM levels),
queued AS (
    SELECT row_number() OVER () AS n, s.*, t.source_size, t.rnk, t.target,
           CAST(sum(s.size) OVER (PARTITION BY t.rnk ORDER BY place, doc_id, size) AS BIGINT) AS upto
    FROM shuffled s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
entries AS (
    SELECT n, size, rnk, epoch, CAST(upto + epoch * source_size AS DOUBLE) / target AS finish
    FROM queued, (VALUES (0), (1)) AS e(epoch) WHERE size > 0),
mixed AS (SELECT *, sum(size) OVER (ORDER BY finish, rnk, epoch) AS total FROM entries),
times AS (SELECT n, count(*) AS k FROM mixed WHERE total <= (SELECT sum(target) FROM targets) GROUP BY n)
SELECT doc_id, size, source_size, target, CAST(coalesce(k, 0) * size AS BIGINT) AS taken
FROM queued LEFT JOIN times USING (n)
"""
