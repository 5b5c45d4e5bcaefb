"""DuckDB SQL for the operators that SQL can express, over the same tables."""

from __future__ import annotations

OP1 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), w AS (
  SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM d
), five AS (
  SELECT doc_id, pos, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c, lead(word, 3) OVER o AS e,
         lead(word, 4) OVER o AS f
  FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
), twice AS (
  SELECT doc_id, pos FROM five WHERE f IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c, e, f) > 1
), cover AS (
  SELECT doc_id, count(DISTINCT pos + k) AS n FROM twice, range(5) AS r(k) GROUP BY doc_id
), lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d
), per_line AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id
), m AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(cover.n, 0)::BIGINT AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines,
         length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
         length(regexp_replace(text, '[^!]', '', 'g')) AS n_bangs
  FROM d LEFT JOIN per_line USING (doc_id) LEFT JOIN cover USING (doc_id)
), bits AS (
  SELECT *, (CASE WHEN n_words < 10 THEN 1 ELSE 0 END
           + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
           + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
           + CASE WHEN 10 * n_dup_lines > 3 * n_lines THEN 8 ELSE 0 END
           + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END
           + CASE WHEN 2 * n_capitals > n_letters AND n_letters > 0 THEN 32 ELSE 0 END
           + CASE WHEN 5 * n_bangs > n_words AND n_words > 0 THEN 64 ELSE 0 END)::BIGINT AS fail_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
       fail_bits = 0 AS kept, fail_bits, sole_rule,
       CASE WHEN sole_rule IS NOT NULL THEN count(*) OVER (PARTITION BY fail_bits) END AS freed_without_rule
FROM (SELECT *, CASE fail_bits WHEN 1 THEN 'few_words' WHEN 2 THEN 'repeated_words' WHEN 4 THEN 'symbols' WHEN 8 THEN 'repeated_lines' WHEN 16 THEN 'word_length' WHEN 32 THEN 'capitals' WHEN 64 THEN 'exclamation' END AS sole_rule FROM bits)
"""

WORD_PIECE = r"(?:[\x{3000}-\x{D7FF}]|[^\x20\x09-\x0D\x{3000}-\x{D7FF}]+)"
OP6 = rf"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS n
  FROM documents WHERE text IS NOT NULL
), k AS (
  SELECT doc_id, n, unnest(regexp_extract_all(line, '{WORD_PIECE}[\x20\x09\x0B-\x0D]*')) AS piece,
         generate_subscripts(regexp_extract_all(line, '{WORD_PIECE}[\x20\x09\x0B-\x0D]*'), 1) AS pos
  FROM l
), w AS (
  SELECT doc_id, n, pos, piece, row_number() OVER (PARTITION BY doc_id ORDER BY n, pos) - 1 AS g,
         translate(regexp_replace(piece, '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word
  FROM k
), least AS (
  SELECT doc_id, g, min(substr(md5(word), 1, 16) || lpad((999999999 - g)::VARCHAR, 9, '0')) OVER ten AS m,
         count(*) OVER ten AS here
  FROM w WINDOW ten AS (PARTITION BY doc_id ORDER BY g ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)
), points AS (
  SELECT DISTINCT doc_id, 999999999 - substr(m, 17)::BIGINT AS p FROM least WHERE here = 10
), near AS (
  SELECT x.doc_id, x.p AS a, y.p AS b FROM points x JOIN points y ON y.doc_id = x.doc_id AND y.p >= x.p + 20 AND y.p <= x.p + 29
), spans AS (
  SELECT doc_id, a, min(b) AS b FROM near GROUP BY doc_id, a
  UNION SELECT doc_id, max(a), b FROM near GROUP BY doc_id, b
  UNION SELECT doc_id, min(g), max(g) + 1 FROM w GROUP BY doc_id, n HAVING count(*) >= 8
), units AS (
  SELECT spans.doc_id, a, b, string_agg(word, ' ' ORDER BY g) AS unit
  FROM spans JOIN w ON w.doc_id = spans.doc_id AND g >= a AND g < b GROUP BY spans.doc_id, a, b
), ranked AS (
  SELECT *, row_number() OVER o AS place, first_value(doc_id) OVER o AS first_doc, first_value(b) OVER o AS first_b
  FROM units WINDOW o AS (PARTITION BY unit ORDER BY doc_id, a, b ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), gone AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(range(a, b)) AS g FROM ranked WHERE doc_id <> first_doc OR a >= first_b
  )
), kept_words AS (
  SELECT w.*, gone.g IS NOT NULL AS gone FROM w LEFT JOIN gone ON gone.doc_id = w.doc_id AND gone.g = w.g
), per_line AS (
  SELECT doc_id, n, count(*) FILTER (WHERE gone) AS n_gone, count(*) FILTER (WHERE NOT gone) AS n_left,
         string_agg(piece, '' ORDER BY pos) FILTER (WHERE NOT gone) AS left_over
  FROM kept_words GROUP BY doc_id, n
), lines AS (
  SELECT l.doc_id, l.n, coalesce(n_gone, 0) AS n_gone, n_left,
         CASE WHEN coalesce(n_gone, 0) = 0 THEN line
              ELSE regexp_extract(line, '^[\x20\x09\x0B-\x0D]*') || left_over END AS line
  FROM l LEFT JOIN per_line USING (doc_id, n)
), done AS (
  SELECT doc_id, sum(n_gone)::BIGINT AS n_removed, string_agg(line, chr(10) ORDER BY n) FILTER (WHERE n_left IS NULL OR n_left > 0) AS kept
  FROM lines GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN done USING (doc_id)
"""

OP10 = r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), w AS (
  SELECT doc_id, p, substr(h, 2 * p + 1, 100) AS s
  FROM (SELECT doc_id, h, unnest(range(0, greatest(length(h) // 2 - 49, 0))) AS p FROM d)
), least AS (
  SELECT s, min(doc_id) AS first FROM w GROUP BY s
), gone AS (
  SELECT DISTINCT doc_id, p + k AS b FROM w JOIN least USING (s), range(50) AS r(k) WHERE doc_id > first
), edges AS (
  SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE fresh) AS n_spans
  FROM (SELECT doc_id, b, coalesce(b - lag(b) OVER (PARTITION BY doc_id ORDER BY b) > 1, true) AS fresh FROM gone)
  GROUP BY doc_id
), bytes AS (
  SELECT doc_id, b, substr(h, 2 * b + 1, 2) AS x FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS b FROM d)
), kept AS (
  SELECT doc_id, string_agg(x, '' ORDER BY b) AS k FROM bytes ANTI JOIN gone USING (doc_id, b) GROUP BY doc_id
)
SELECT d.doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k, ''))) AS kept_sha256
FROM d LEFT JOIN edges USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


OP11 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS g
  FROM documents
), h AS (
  SELECT *, ('0x' || substr(g, 1, 8))::BIGINT % (n + 1) AS c1, ('0x' || substr(g, 9, 8))::BIGINT % (n + 1) AS c2,
         ('0x' || substr(g, 17, 8))::BIGINT % 100 AS h3, ('0x' || substr(g, 25, 8))::BIGINT % 100 AS h4
  FROM d
), f AS (
  SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 90 THEN 'plain'
              WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || substr(text, 1, a) || '<S>' || substr(text, b + 1) || '<M>' || substr(text, a + 1, b - a)
                        ELSE '<S>' || substr(text, b + 1) || '<P>' || substr(text, 1, a) || '<M>' || substr(text, a + 1, b - a) END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM f
"""

OP12 = r"""
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), k AS (
  SELECT c, turn, sha256(length(role) || ':' || role || text) AS x,
         len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS words
  FROM t
), o AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, substr(x, 1, 30)) AS r FROM k
), sized AS (
  SELECT c, count(*) AS own, c::VARCHAR AS s FROM o GROUP BY c
), s AS ( -- CRC-32 of the decimal id, bit by bit
  SELECT c, c - c % 20 AS base, own,
         xor(4294967295::BIGINT, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i, 1))::BIGINT)),
           lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1)))
         )) % 4 AS h
  FROM sized
), v AS (
  SELECT s.*, least(s.h, coalesce(b.own, 0)) AS lead FROM s LEFT JOIN s b ON b.c = s.base
), rebuilt AS (
  SELECT v.c, o.r AS d, o.x, o.words FROM v JOIN o ON o.c = v.base AND o.r <= v.h
  UNION ALL SELECT v.c, v.lead + o.r - v.h, o.x, o.words FROM v JOIN o ON o.c = v.c AND o.r > v.h
), p AS (
  SELECT c, d, words, sha256(string_agg(x, '' ORDER BY d) OVER (PARTITION BY c ORDER BY d ROWS UNBOUNDED PRECEDING)) AS name
  FROM rebuilt
), q AS (
  SELECT c, d, words, name, lag(name) OVER (PARTITION BY c ORDER BY d) AS above FROM p
), ends AS (
  SELECT v.c, coalesce(max(p.d), 0) AS d, coalesce(arg_max(p.name, p.d), '') AS name FROM v LEFT JOIN p ON p.c = v.c GROUP BY v.c
), digests AS (
  SELECT name, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS ends FROM ends GROUP BY name
), nodes AS (
  SELECT name, d, coalesce(above, '') AS above, min(c) AS m, count(*)::BIGINT AS n, max(words) AS words FROM q GROUP BY name, d, above
  UNION ALL SELECT '', 0, NULL, min(c), count(*), 0 FROM v HAVING count(*) > 0
), kids AS (
  SELECT above, count(*)::BIGINT AS n_children FROM nodes WHERE d > 0 GROUP BY above
), line AS (
  SELECT c, name FROM p UNION ALL SELECT c, '' FROM v
), under AS (
  SELECT line.name AS top, nodes.* FROM nodes JOIN line ON line.c = nodes.m JOIN nodes u ON u.name = line.name AND u.d <= nodes.d
), sums AS (
  SELECT top, count(*) FILTER (WHERE kids.above IS NULL)::BIGINT AS n_leaves, sum((n - 1) * words)::BIGINT AS saved_tokens
  FROM under LEFT JOIN kids ON kids.above = under.name GROUP BY top
)
SELECT nodes.m AS conv_id, nodes.d::BIGINT AS depth, up.m AS parent_conv_id, nodes.n AS n_convs, coalesce(kids.n_children, 0) AS n_children,
       sums.n_leaves, sums.saved_tokens, coalesce(digests.ends, sha256('')) AS ends_sha256
FROM nodes LEFT JOIN nodes up ON up.name = nodes.above LEFT JOIN kids ON kids.above = nodes.name
JOIN sums ON sums.top = nodes.name LEFT JOIN digests ON digests.name = nodes.name
"""

OP13 = r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, html,
         CASE WHEN url LIKE '%://%' THEN regexp_replace(regexp_extract(url, '(?s)^(.*?://.*)$', 1), '(?s)^.*?://', '') ELSE '' END AS rest
  FROM pages
), u AS (
  SELECT page_id, url, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM p
), rules(rule, decided) AS (
  VALUES ('org/', 'allow'), ('example.org/es/', 'block'), ('example.org/en/1', 'block'), ('com/fr/', 'allow'), ('com/de/', 'block')
), r AS (
  SELECT rule, decided, split_part(rule, '/', 1) AS h, substr(rule, length(split_part(rule, '/', 1)) + 1) AS s FROM rules
), fit AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(decided, length(rule)) AS decided
  FROM (SELECT DISTINCT host, path FROM u) JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s)
  GROUP BY host, path
), tags AS (
  SELECT url, unnest(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', ' ', 'g'),
                                        '(?i)<(?:link|meta)\b[^>]*>')) AS tag
  FROM u WHERE regexp_matches(html, '(?i)canonical|http-equiv') AND regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*://')
), refs AS (
  SELECT url, regexp_extract(tag, '(?i)\shref\s*=\s*["'']?([^"''\s>]+)', 1) AS ref FROM tags
  WHERE regexp_matches(tag, '(?i)^<link') AND regexp_matches(tag, '(?i)\srel\s*=\s*["'']?[^"''>]*\bcanonical\b')
  UNION ALL
  SELECT url, regexp_extract(tag, '(?i)\burl\s*=\s*["'']?([^"''\s>]+)', 1) FROM tags
  WHERE regexp_matches(tag, '(?i)^<meta') AND regexp_matches(tag, '(?i)\shttp-equiv\s*=\s*["'']?refresh')
), links AS (
  SELECT regexp_replace(url, '(?s)#.*', '') AS a, regexp_replace(CASE WHEN regexp_matches(ref, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN ref
           ELSE regexp_extract(url, '^[^:]*://[^/?#]*') || ref END, '(?s)#.*', '') AS b
  FROM refs WHERE starts_with(ref, '/') OR contains(ref, '://')
), edges AS (
  SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b
), reach(a, b) AS (
  SELECT a, a FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a
), spread AS (
  SELECT reach.a AS node, min(reach.b) AS alias_of, max(decided = 'allow') AS allowed
  FROM reach LEFT JOIN fit ON fit.host = translate(regexp_extract(reach.b, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                          AND fit.path = regexp_extract(reach.b, '://[^/?#]*([^?#]*)', 1)
  GROUP BY reach.a
)
SELECT page_id, u.host, u.path, fit.rule,
       coalesce(fit.decided, CASE WHEN allowed THEN 'allow' WHEN NOT allowed THEN 'block' END, 'allow') AS verdict, alias_of
FROM u LEFT JOIN fit ON fit.host = u.host AND fit.path = u.path LEFT JOIN spread ON spread.node = regexp_replace(u.url, '(?s)#.*', '')
"""

ORACLE = {
    "op1_quality_rules": OP1, "op6_substring_dedup": OP6, "op10_suffix_array_dedup": OP10,
    "op11_fill_middle": OP11, "op12_prefix_trie": OP12, "op13_url_filter": OP13,
}
