"""SQL texts that compute registered queries on one machine, for checking."""

from __future__ import annotations

WINDOWS = r"""WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS g FROM w, unnest(range(1, len(ws) - 11)) AS t(i)),
firsts AS (SELECT g, min(doc_id) AS d FROM win GROUP BY g),
gone AS (
  SELECT DISTINCT win.doc_id, i + k AS p FROM win JOIN firsts USING (g), unnest(range(0, 13)) AS u(k) WHERE win.doc_id > d),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
stay AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN stay USING (doc_id)"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

# Texts have no blank within a word, so words joined by blanks are equal where the words are.
PHRASES = f"""WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, {_ALNUM}) AS ws FROM benchmark),
q AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS g
  FROM b, unnest(range(1, greatest(len(ws) - 11, 2))) AS t(i) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM q),
win AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS g
  FROM d, sizes, unnest(range(1, len(ws) - n + 2)) AS t(i)),
hit AS (SELECT doc_id, item_id, win.n, i FROM win JOIN q ON q.n = win.n AND q.g = win.g),
places AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hit, unnest(range(0, n)) AS u(k) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)"""

LINES = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM d),
k AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
shared AS (
  SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
stay AS (SELECT k.* FROM k LEFT JOIN shared USING (key) WHERE first IS NULL OR k.doc_id = first),
kept AS (SELECT r, count(*) AS n, string_agg(line, chr(10) ORDER BY p) AS text FROM stay GROUP BY r)
SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - coalesce(n, 0) AS BIGINT) AS n_dropped,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


def oracle_sql() -> dict[str, str]:
    return {"op5_windows": WINDOWS, "op8_phrases": PHRASES, "op12_lines": LINES}
