"""DuckDB SQL for the operators' queries that SQL can express."""

from __future__ import annotations

STATEMENTS: dict[str, str] = {}

STATEMENTS["op6_quality_rules"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
worded AS (SELECT doc_id, line FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM worded GROUP BY doc_id),
wins AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM d WHERE len(ws) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM wins) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)),
f AS (
  SELECT *, ((n_words < 20)::BIGINT) + 2 * ((100 * n_repeat_words > 30 * n_words)::BIGINT)
    + 4 * ((10 * n_symbols > n_words)::BIGINT) + 8 * ((n_lines >= 4 AND 2 * n_dup_lines > n_lines)::BIGINT)
    + 16 * ((2 * n_upper > word_chars)::BIGINT) + 32 * ((word_chars > 40 * n_words)::BIGINT) AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures FROM f
"""

STATEMENTS["op7_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az
    FROM documents)),
b AS (
  SELECT item_id, regexp_extract_all(lower_az, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM (
    SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_az
    FROM benchmark)),
sized AS (SELECT item_id, ws, least(13, len(ws)) AS n FROM b WHERE len(ws) > 0),
bw AS (
  SELECT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM sized)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, lens WHERE len(ws) >= n)),
hit AS (SELECT DISTINCT doc_id, n, i, item_id FROM dw JOIN bw USING (n, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

STATEMENTS["op8_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
k AS (SELECT html, max(page_id) AS best, unhex(sha1(html))::BIT::VARCHAR AS bits FROM p GROUP BY html)
SELECT page_id, strlen(html) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + 16 * substr(bits, 5 * i + 1, 1)::INT + 8 * substr(bits, 5 * i + 2, 1)::INT
           + 4 * substr(bits, 5 * i + 3, 1)::INT + 2 * substr(bits, 5 * i + 4, 1)::INT
           + substr(bits, 5 * i + 5, 1)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> best THEN best END AS refers_to
FROM p JOIN k USING (html)
"""

STATEMENTS["op11_ranked_search"] = r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
doc AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM doc),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, total GROUP BY term, docs),
q AS (
  SELECT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // terms))))::BIGINT AS score
  FROM q JOIN tf USING (term) JOIN w USING (term) JOIN doc USING (doc_id), total GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def statements() -> dict[str, str]:
    return dict(STATEMENTS)
