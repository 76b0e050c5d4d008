"""DuckDB SQL of the operators that SQL can express, written from their
contracts and independent of the Spark plans."""

HOST_QUALITY_ROWS = r"""
d AS (SELECT row_number() OVER () AS rid, * FROM {docs}),
wl AS (SELECT rid, doc_id, source, coalesce(text, '') AS t,
              regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM d),
g AS (SELECT rid, p, w[p] || ' ' || w[p + 1] || ' ' || w[p + 2] AS gram
      FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS p FROM wl)),
twice AS (SELECT rid, p FROM g QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
rep AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM twice) GROUP BY rid),
li AS (SELECT rid, count(*) - count(DISTINCT l) AS n
       FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM wl)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT rid, doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(li.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM wl LEFT JOIN li USING (rid) LEFT JOIN rep USING (rid)),
f AS (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
             unnest([{{'k': 0, 'bad': n_words < 50}},
                     {{'k': 1, 'bad': 100 * n_repeat_words > 50 * n_words}},
                     {{'k': 2, 'bad': n_symbols > 0.1 * n_words}},
                     {{'k': 3, 'bad': n_words > 0 AND (word_chars / n_words < 2 OR word_chars / n_words > 15)}}]) AS rule
      FROM m),
h AS (SELECT source, rule.k AS k, count(*) AS n, sum(rule.bad::INT)::DOUBLE AS bad FROM f
      WHERE source IS NOT NULL GROUP BY ALL),
tot AS (SELECT k, sum(bad) / sum(n) AS mean, sum(bad * bad / n) / sum(n) AS sq, count(*) / sum(n) AS per FROM h GROUP BY k),
prior AS (SELECT k, mean, CASE WHEN sq - mean * mean - mean * (1 - mean) * per > 1e-9
                 THEN greatest(1, mean * (1 - mean) / (sq - mean * mean - mean * (1 - mean) * per) - 1)
                 ELSE 1e9 END AS strength FROM tot),
bad_host AS (SELECT DISTINCT source FROM h JOIN prior USING (k)
             WHERE mean > 0 AND (bad + mean * strength) / (n + strength) > 0.8),
judged AS (SELECT rid, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
                  NOT base_failed AND (m.source IS NULL OR m.source NOT IN (SELECT source FROM bad_host)) AS kept
           FROM (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed FROM m) m)
"""

HOST_QUALITY = "WITH " + HOST_QUALITY_ROWS.format(docs="documents") + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged
"""

CONTAMINATION = r"""
WITH fold AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS big, 'abcdefghijklmnopqrstuvwxyz' AS small),
iw AS (SELECT item_id, regexp_extract_all(translate(text, big, small), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
       FROM benchmark, fold),
win AS (SELECT DISTINCT item_id, least(13, len(w)) AS l, array_to_string(w[p:p + least(13, len(w)) - 1], ' ') AS t
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM iw WHERE len(w) > 0)),
dw AS (SELECT row_number() OVER () AS rid, doc_id,
              coalesce(regexp_extract_all(translate(text, big, small), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
       FROM documents, fold),
spot AS (SELECT rid, l, p, array_to_string(w[p:p + l - 1], ' ') AS t
         FROM (SELECT rid, w, l, unnest(range(1, len(w) - l + 2)) AS p
               FROM dw, (SELECT DISTINCT l FROM win))),
hit AS (SELECT rid, p, l, item_id FROM spot JOIN win USING (l, t)),
nh AS (SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest(range(p, p + l)) AS q FROM hit) GROUP BY rid),
it AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
       FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(nh.n, 0)::BIGINT AS n_hit, coalesce(it.n, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(nh.n, 0) > 0 AND 20 * coalesce(nh.n, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN nh USING (rid) LEFT JOIN it USING (rid)
"""

URL_VERDICTS = r"""
WITH RECURSIVE raw AS (SELECT row_number() OVER () AS rid, page_id, url, html FROM pages),
urls AS (SELECT DISTINCT url FROM raw WHERE url IS NOT NULL),
tags AS (SELECT url, unnest(regexp_extract_all(html, '(?i)<(?:link|meta)\s[^>]*>')) AS tag FROM raw
         WHERE url IS NOT NULL AND html IS NOT NULL),
links AS (SELECT url, CASE WHEN regexp_matches(tag, '(?i)^<link\s')
                           THEN regexp_extract(tag, '(?i)\shref\s*=\s*["'']?([^\s"''>]+)', 1)
                           ELSE regexp_extract(tag, '(?i)\burl\s*=\s*["'']?([^"''>]+)', 1) END AS link
          FROM tags WHERE regexp_matches(tag, '(?i)\srel\s*=\s*["'']?\s*canonical\b')
                       OR regexp_matches(tag, '(?i)\shttp-equiv\s*=\s*["'']?\s*refresh\b')),
pairs AS (SELECT url, CASE WHEN regexp_matches(link, '(?i)^https?://') THEN link
                           WHEN starts_with(link, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || link END AS target
          FROM links),
known AS (SELECT url FROM urls UNION SELECT target FROM pairs WHERE target IS NOT NULL),
parts AS (SELECT url, translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
                 regexp_extract(url, '(?s)^.*?://[^?#]*(\?[^#]*)', 1) AS query FROM known),
ruled AS (SELECT *, CASE WHEN host <> '' THEN host || path || query END AS key FROM parts),
rules(rule, host, path, verdict) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
                                            ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
page_rule AS (SELECT url, arg_max(rules.rule, length(rules.rule)) AS rule, arg_max(verdict, length(rules.rule)) AS verdict
              FROM ruled JOIN rules ON (ruled.host = rules.host OR ends_with(ruled.host, '.' || rules.host))
                                   AND starts_with(ruled.path, rules.path) GROUP BY url),
node_rule AS (SELECT key, arg_max(verdict, length(rules.rule)) AS verdict
              FROM ruled JOIN rules ON (ruled.host = rules.host OR ends_with(ruled.host, '.' || rules.host))
                                   AND starts_with(ruled.path, rules.path) WHERE key IS NOT NULL GROUP BY key),
edge AS (SELECT a.key AS u, b.key AS v FROM pairs JOIN ruled a USING (url) JOIN ruled b ON b.url = pairs.target
         WHERE a.key <> b.key),
both_ways AS (SELECT u, v FROM edge UNION SELECT v, u FROM edge),
reach(a, b) AS (SELECT u, u FROM both_ways UNION SELECT reach.a, v FROM reach JOIN both_ways ON reach.b = u),
class AS (SELECT a AS key, coalesce(bool_or(verdict = 'block'), false) AND NOT coalesce(bool_or(verdict = 'allow'), false) AS bad
          FROM reach LEFT JOIN node_rule ON node_rule.key = reach.b GROUP BY a)
SELECT page_id, coalesce(ruled.host, '') AS host, coalesce(ruled.path, '') AS path, page_rule.rule AS rule,
       coalesce(page_rule.verdict, CASE WHEN class.bad THEN 'block' ELSE 'allow' END) AS verdict
FROM raw LEFT JOIN ruled ON ruled.url = raw.url LEFT JOIN page_rule ON page_rule.url = raw.url
         LEFT JOIN class ON class.key = ruled.key
"""

WARC_RECORDS = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
h AS (SELECT page_id, payload, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex,
             max(page_id) OVER (PARTITION BY payload) AS original, count(*) OVER (PARTITION BY payload) AS n FROM p),
d AS (SELECT *, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + ((('0x' || substr(hex, 1 + 5 * (k // 4), 5))::INT >> (15 - 5 * (k % 4))::INT) & 31), 1)
             for k in range(0, 32)], '') AS payload_digest
      FROM h)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN n > 1 AND page_id IS DISTINCT FROM original AND original IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND page_id IS DISTINCT FROM original THEN original END AS refers_to
FROM d
"""

#: Every kept term of a language against every source of it, zeros included.
DIVERGENCE = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[a-z\x{80}-\x{10FFFF}]+') AS words
  FROM documents),
x AS (SELECT lang, source, doc, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM x GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
sizes AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM d),
cell AS (SELECT g.lang, g.source, k.term, k.n AS lang_n, count(x.doc) AS n
         FROM grp g JOIN kept k ON k.lang = g.lang
         LEFT JOIN x ON x.lang = g.lang AND x.source = g.source AND x.term = k.term
         GROUP BY ALL),
p AS (SELECT c.lang, c.source, c.term, c.n,
             1 + (1000000000::HUGEINT * (c.n + 2)) // (sum(c.n) OVER (PARTITION BY c.lang, c.source) + 2 * s.v)::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (c.lang_n + 2)) // (s.total + 2 * s.v)::HUGEINT AS q
      FROM cell c JOIN sizes s ON s.lang = c.lang),
pair AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, CAST(coalesce(pair.value, 0) AS BIGINT) AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
terms AS (SELECT lang, source, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value
          FROM p WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM (SELECT lang, source, 'pair' AS part, item, value FROM pairs
        UNION ALL SELECT lang, source, 'term', item, value FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
