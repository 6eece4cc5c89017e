"""DuckDB formulations of the operators that SQL can express, over whole tables.

``rid`` numbers the rows, so that rows of equal ids stay apart.
"""

from __future__ import annotations

from .quality_rules import MEASURES, MIN_GROUP

WHITE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, [x FOR x IN string_split_regex(t, '[{WHITE}]+') IF x <> ''] AS ws,
             [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^{WHITE}]')] AS ls FROM d),
words AS (SELECT rid, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM w),
places AS (SELECT rid, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM words WINDOW o AS (PARTITION BY rid ORDER BY i)),
runs AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS times FROM places WHERE c IS NOT NULL),
again AS (SELECT rid, count(DISTINCT i + k) AS n FROM runs, (VALUES (0), (1), (2)) AS o(k) WHERE times > 1 GROUP BY rid),
base AS (
  SELECT rid, doc_id, lang, source, len(ws) AS n_words, length(regexp_replace(t, '[{WHITE}]', '', 'g')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
         coalesce(again.n, 0) AS n_repeat_words, len(ls) AS n_lines, length(t) - length(regexp_replace(t, '[A-Z!]', '', 'g')) AS n_shouted
  FROM d JOIN w USING (rid) LEFT JOIN again USING (rid)),
m AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         coalesce(1000 * n_symbols // nullif(word_chars, 0), 0) AS symbols, coalesce(1000 * n_shouted // nullif(word_chars, 0), 0) AS shouted,
         coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0) AS repeated, coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0) AS dup_lines
  FROM base),
long AS (
  SELECT rid, lang, source, measure, v, CASE WHEN v < 64 THEN v ELSE (v >> (length(bin(v)) - 6)) << (length(bin(v)) - 6) END AS b
  FROM (UNPIVOT (SELECT rid, lang, source, symbols::BIGINT AS symbols, shouted::BIGINT AS shouted, repeated::BIGINT AS repeated,
                        dup_lines::BIGINT AS dup_lines FROM m WHERE NOT base_failed)
        ON {", ".join(MEASURES)} INTO NAME measure VALUE v)),
lists AS (
  SELECT measure, lang, source, GROUPING(lang) AS no_lang, GROUPING(source) AS no_source, count(*) AS n, list_sort(list(b)) AS bs
  FROM long GROUP BY GROUPING SETS ((measure, lang, source), (measure, lang), (measure))),
shape(measure, spread, least) AS (VALUES {", ".join(f"('{k}', {a}, {b})" for k, (a, b) in MEASURES.items())}),
fence AS (
  SELECT measure, lang, source, no_lang, no_source, n,
         bs[(9 * n + 9) // 10] + greatest(spread * (bs[(9 * n + 9) // 10] - bs[(n + 1) // 2]), least) AS f
  FROM lists JOIN shape USING (measure)),
beyond AS (
  SELECT DISTINCT l.rid FROM long l
  JOIN fence g ON g.measure = l.measure AND g.no_source = 0 AND g.lang IS NOT DISTINCT FROM l.lang AND g.source IS NOT DISTINCT FROM l.source
  JOIN fence a ON a.measure = l.measure AND a.no_source = 1 AND a.no_lang = 0 AND a.lang IS NOT DISTINCT FROM l.lang
  JOIN fence e ON e.measure = l.measure AND e.no_lang = 1
  WHERE l.v > CASE WHEN g.n >= {MIN_GROUP} THEN g.f WHEN a.n >= {MIN_GROUP} THEN a.f ELSE e.f END)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND rid NOT IN (SELECT rid FROM beyond) AS kept
FROM m"""

WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

CONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS ws FROM documents),
items AS (SELECT item_id, {WORDS} AS ws FROM benchmark),
sized AS (SELECT item_id, ws, least(len(ws), 10) AS size FROM items WHERE len(ws) > 0),
windows AS (SELECT DISTINCT item_id, size, array_to_string(ws[i:i + size - 1], ' ') AS words
            FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS i FROM sized)),
ahead AS (SELECT rid, i, list(a) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS ten
          FROM (SELECT rid, unnest(ws) AS a, generate_subscripts(ws, 1) AS i FROM d)),
places AS (SELECT rid, size, i, array_to_string(ten[1:size], ' ') AS words FROM ahead, (SELECT DISTINCT size FROM sized) WHERE len(ten) >= size),
met AS (SELECT rid, i, size, item_id FROM places JOIN windows USING (size, words)),
hit AS (SELECT rid, count(DISTINCT place) AS n FROM (SELECT rid, unnest(range(i, i + size)) AS place FROM met) GROUP BY rid),
found AS (SELECT rid, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
          FROM (SELECT DISTINCT rid, item_id FROM met) GROUP BY rid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(found.n, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (rid) LEFT JOIN found USING (rid)"""

ORACLE_SQL = {"op3_decontaminate": CONTAMINATION, "op4_quality_rules": QUALITY}
