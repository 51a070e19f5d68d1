"""DuckDB SQL for the operators that SQL can express, with the same rows as the queries."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

_QUALITY = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i, ws FROM d WHERE len(ws) >= 3),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM w),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
      FROM g, (VALUES (0), (1), (2)) v(k) WHERE n > 1 GROUP BY doc_id),
c AS (
  SELECT d.doc_id, text, ws, ls, len(ws)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed
    OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 10 * n_symbols > n_words
    OR 10 * n_dup_lines > 3 * len(ls)
    OR 5 * len(list_filter(ws, lambda x: NOT regexp_matches(x, '\p{{L}}'))) > n_words
    OR 2 * length(regexp_replace(text, '\P{{Lu}}+', '', 'g')) > length(regexp_replace(text, '\P{{L}}+', '', 'g'))
    OR 10 * len(list_filter(ls, lambda x: regexp_matches(x, '(\.\.\.|…)\s*$'))) > 3 * len(ls)
    OR 10 * len(list_filter(ls, lambda x: regexp_matches(x, '^\s*[-*•‣]'))) > 9 * len(ls)
    OR 2 * length(regexp_replace(text, '[^!?]+', '', 'g')) > n_words) AS kept
FROM b
"""

_CONTROL = r"(\||/?s>|</?SYS>>|/?INST\])"
_CHAT = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, regexp_replace(text, '([<\[])(\\*){_CONTROL}', '\1\\\2\3', 'g') AS text_out,
             regexp_replace(role, '([<\[])(\\*){_CONTROL}', '\1\\\2\3', 'g') AS role_out FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(role_out) + length(text_out) + {len("<|turn|><|text|><|end|>")})::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""


# Rules and kinds of pages are written out here, so that a wrong expression of the operator shows.
_URL = r"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rules(h, f, rule, verdict) AS (
  VALUES ('com', '/', 'com/', 'allow'), ('example.com', '/en/', 'example.com/en/', 'block'),
         ('www.example.com', '/en/', 'www.example.com/en/', 'allow'),
         ('net', '/es/', 'net/es/', 'block'), ('net', '/fr/', 'net/fr/', 'block')),
u AS (SELECT DISTINCT host, path FROM p),
r AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, f) GROUP BY host, path)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE
    WHEN regexp_matches(host, '(^|\.)(spam-farm|cheap-pills|ads|tracker)\.') THEN 'block'
    WHEN regexp_matches(host, '(^|\.)casino-') OR contains(host || path, '-casino.') THEN 'block'
    WHEN contains(path, '/wp-login.php') OR contains(path, '/cgi-bin/') THEN 'block'
    WHEN regexp_matches(path, '(?s)/login/.*\.php$') THEN 'block'
    ELSE 'allow' END) AS verdict
FROM p LEFT JOIN r USING (host, path)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_CONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_TERM}') AS ws FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, k, array_to_string(ws[s : s + k - 1], ' ') AS w
  FROM (SELECT item_id, ws, least(13, len(ws)) AS k, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS s
        FROM b WHERE len(ws) > 0)),
dw AS (
  SELECT doc_id, s, k, array_to_string(ws[s : s + k - 1], ' ') AS w
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS s FROM d, (SELECT DISTINCT k FROM iw) WHERE len(ws) >= k)),
h AS (SELECT doc_id, s, dw.k, item_id FROM dw JOIN iw ON dw.k = iw.k AND dw.w = iw.w),
p AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS x FROM h) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM h) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN i USING (doc_id)
"""

_PHRASES = rf"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS id,
         regexp_extract_all(unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws
  FROM documents),
g AS (SELECT lang, k, array_to_string(ws[i : i + k - 1], ' ') AS phrase
      FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM p, (VALUES (1), (2), (3)) v(k))),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS n FROM g GROUP BY ALL),
t AS (SELECT lang, sum(n) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, n AS a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND n >= 10),
i AS (SELECT lang, phrase, max(a) AS longer
      FROM (SELECT lang, a, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS phrase FROM c WHERE k = 3) GROUP BY ALL),
s AS (SELECT c.* FROM c LEFT JOIN i USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
x AS (SELECT lang, phrase, a, j, array_to_string(ws[1 : j], ' ') AS first, array_to_string(ws[j + 1 : k], ' ') AS rest
      FROM (SELECT *, unnest(range(1, k)) AS j FROM s)),
y AS (SELECT x.lang, x.phrase, a, fl.n AS l, fr.n AS r, j, (1000000 * a * a) // (fl.n * fr.n) AS score
      FROM x JOIN f fl ON fl.lang = x.lang AND fl.phrase = x.first JOIN f fr ON fr.lang = x.lang AND fr.phrase = x.rest),
z AS (SELECT * FROM y QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z)
SELECT o.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, t.n::BIGINT AS n, score::BIGINT AS score
FROM o JOIN t ON o.lang = t.lang WHERE rank <= 2000
"""

SQL = {"op13_collocations": _PHRASES, "op4_decontamination": _CONTAMINATION, "op2_quality_rules": _QUALITY, "op6_chat_formatting": _CHAT, "op8_url_filter": _URL}
