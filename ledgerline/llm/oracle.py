"""DuckDB SQL for the operators that SQL can express on whole tables.

The others have none: the tokenizer (1), the trained models (2, 8), XXH64
fingerprints (6), hash-driven draws (7), non-overlapping searches without
retries (9) and tree scoring (10) are tested against brute force instead.
"""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

QUALITY = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
windows AS (
  SELECT row, i, count(*) OVER (PARTITION BY row, g) AS times
  FROM (SELECT row, i, list_slice(ws, i, i + 7) AS g
        FROM (SELECT row, ws, unnest(range(1, len(ws) - 6)) AS i FROM texts))),
repeated AS (
  SELECT row, count(DISTINCT place) AS n
  FROM (SELECT row, unnest(range(i, i + 8)) AS place FROM windows WHERE times > 1) GROUP BY row),
features AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_bangs,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines,
         len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) AS n_adjacent,
         coalesce(r.n, 0) AS n_repeat_words
  FROM texts LEFT JOIN repeated r USING (row)),
judged AS (
  SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM features)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > len(lines)
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 2 * n_bangs > n_words OR 5 * n_adjacent > n_words) AS kept
FROM judged"""

WARC = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100
                 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id
  FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM firsts"""

_WORDS = r"regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH item_words AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS ws FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, size, list_slice(ws, i, i + size - 1) AS g
  FROM (SELECT item, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
        FROM (SELECT *, least(10, len(ws)) AS size FROM item_words WHERE len(ws) > 0))),
doc_words AS (SELECT row_number() OVER () AS row, doc_id, {_WORDS} AS ws FROM documents),
doc_windows AS (
  SELECT row, i, size, list_slice(ws, i, i + size - 1) AS g
  FROM (SELECT row, ws, size, unnest(range(1, len(ws) - size + 2)) AS i
        FROM doc_words, (SELECT DISTINCT size FROM item_windows))),
found AS (SELECT row, i, size, item FROM doc_windows JOIN item_windows USING (size, g)),
hits AS (SELECT row, count(DISTINCT place) AS n
         FROM (SELECT row, unnest(range(i, i + size)) AS place FROM found) GROUP BY row),
items AS (SELECT row, list_sort(list(DISTINCT item)) AS ids FROM found GROUP BY row)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n, 0) AS n_hit,
       CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hits USING (row) LEFT JOIN items USING (row)"""

ORACLE_SQL: dict[str, str] = {
    "op3_quality_rules": QUALITY,
    "op4_warc": WARC,
    "op5_decontamination": DECONTAMINATION,
}
