"""DuckDB twins of the contract queries, written from the contracts and not from the Spark code."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

OP3 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
win AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
        FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
rep AS (SELECT r, count(DISTINCT i + o) AS n
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win), (SELECT unnest([0, 1, 2]) AS o)
        WHERE c > 1 GROUP BY r),
ln AS (SELECT r, line, regexp_extract_all(line, '{WORD}') AS lw,
              translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
       FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)),
lx AS (SELECT r, line, len(lw) AS n,
              100 * len(list_filter(lw, lambda x: regexp_matches(x, '[#*$%&|<>]') OR x LIKE '%!!')) > 30 * len(lw)
              OR (len(list_filter(lw, lambda x: x IN ('|', '>', '/', '·'))) >= 3
                  AND 100 * len(list_filter(lw, lambda x: x IN ('|', '>', '/', '·'))) >= 10 * len(lw))
              OR (len(lw) <= 20 AND regexp_matches(low, 'all rights reserved|terms of service|privacy policy|cookie policy|accept cookies|released under the|licensed under the|subscribe to our newsletter|javascript is disabled')) AS bad
       FROM ln WHERE len(lw) > 0),
la AS (SELECT r, count(*) - count(DISTINCT line) AS dup, sum(CASE WHEN bad THEN n ELSE 0 END) AS lost FROM lx GROUP BY r),
f AS (SELECT d.doc_id, len(w) AS n_words,
             CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(la.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(coalesce(la.lost, 0) AS BIGINT) AS n_lost_words
      FROM d LEFT JOIN rep USING (r) LEFT JOIN la USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * n_lost_words <= 40 * n_words AS kept
FROM f
"""

OP4 = r"""
WITH u AS (SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '') AS h0,
                  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
v AS (SELECT page_id, translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path,
             row_number() OVER () AS r FROM u),
rules(verdict, rh, rp) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                                  ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
best AS (SELECT r, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS verdict
         FROM v JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM v LEFT JOIN best USING (r)
"""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP1 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '{ITEM_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOW}, '{ITEM_WORD}') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g
        FROM (SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, m, array_to_string(w[i:i + m - 1], ' ') AS g
       FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)),
hit AS (SELECT doc_id, i, m, item_id FROM dw JOIN win USING (m, g)),
h AS (SELECT doc_id, count(DISTINCT i + o) AS n_hit FROM hit, range(10) t(o) WHERE o < m GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id)
"""

OP7 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOW}, '{WORD}') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(a, b) AS (SELECT DISTINCT x, x FROM e UNION SELECT r.a, e.y FROM r JOIN e ON r.b = e.x),
c AS (SELECT a AS doc_id, min(b) AS comp FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(comp, doc_id) AS component_id, coalesce(comp, doc_id) = doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

OP11 = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, b.r AS br, b.vec_id AS id, a.label = b.label AS same,
             CAST(coalesce(list_sum(list_transform(list_zip(a.e, b.e), lambda z: coalesce(z[1] * z[2], 0))), 0) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r),
p AS (SELECT ar, anchor_id, br, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id, br) <= 5),
n AS (SELECT p.anchor_id, positive_id, s.id AS negative_id, positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.ar, p.br ORDER BY s.score DESC, s.id, s.br) AS rank
      FROM p JOIN s ON s.ar = p.ar AND NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""

ORACLE: dict = {"op1_decontaminate": OP1, "op3_quality_rules": OP3, "op4_url_filter": OP4, "op7_minhash_dedup": OP7,
                "op11_hard_negatives": OP11}
