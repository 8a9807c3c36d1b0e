"""DuckDB SQL for the operators whose whole result SQL can express."""

from __future__ import annotations

from tidemark.llm.lines import OP4_SQL

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_ITEM_WORDS = (
    rf"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), "
    r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)

OP5_SQL = f"""
WITH items AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
wins AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM items WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT len(win) AS n FROM wins),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS w FROM documents),
spots AS (
  SELECT r, n, i, list_slice(w, i, i + n - 1) AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)
),
hits AS (SELECT r, item_id, i, s.n FROM spots s JOIN wins USING (win)),
cover AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY r),
items_of AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hits) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN cover USING (r) LEFT JOIN items_of USING (r)
"""

OP6_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
wins AS (SELECT r, i, list_slice(w, i, i + 7) AS win FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM docs WHERE len(w) >= 8)),
again AS (SELECT r, unnest(list(i)) AS i FROM wins GROUP BY r, win HAVING count(*) > 1),
cover AS (SELECT r, count(DISTINCT pos) AS n_repeat FROM (SELECT r, unnest(range(i, i + 8)) AS pos FROM again) GROUP BY r),
m AS (
  SELECT r, doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat, 0) AS n_repeat_words
  FROM docs LEFT JOIN cover USING (r)
),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m),
hosts AS (SELECT source, count(*) AS pages, count(*) FILTER (base_failed) AS failures FROM b GROUP BY source),
prior AS (
  SELECT sum(failures) / sum(pages) AS mean, coalesce(var_pop(failures / pages), 0) AS spread FROM hosts
),
weighted AS (
  SELECT mean, CASE WHEN spread > 0 THEN least(1000.0, greatest(1.0, mean * (1 - mean) / spread - 1)) ELSE 1000.0 END AS weight FROM prior
),
verdicts AS (SELECT source, (failures + mean * weight) / (pages + weight) AS rate FROM hosts, weighted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(rate > 0.5, false) AS kept
FROM b LEFT JOIN verdicts v ON b.source IS NOT DISTINCT FROM v.source
"""

OP10_SQL = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs WHERE len(w) >= 20)
),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM wins) WHERE k > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos FROM later),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM docs),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS t
  FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

ORACLE = {
    "op4_line_dedup": OP4_SQL,
    "op5_decontaminate": OP5_SQL,
    "op6_quality_rules": OP6_SQL,
    "op10_substring_dedup": OP10_SQL,
}
