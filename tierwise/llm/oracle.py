"""DuckDB SQL for the operators that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

SQL = {}

SQL["op1_quality_rules"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {WORDS} AS ws FROM documents
), win AS (
  SELECT rid, i, array_to_string(ws[i:i+7], ' ') AS g
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM d)
), twice AS (
  SELECT rid, i FROM win QUALIFY count(*) OVER (PARTITION BY rid, g) > 1
), rep AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY rid
), line AS (
  SELECT rid, l, regexp_replace(regexp_replace(l, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS s,
         len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) AS m
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
), judged AS (
  SELECT rid, l, m,
    (m < 8 AND NOT regexp_matches(s, '[.!?:;"'')\]…”»]$'))
    OR 100 * len(regexp_extract_all(s, '[#*$%&|<>]')) > 10 * strlen(s)
    OR 100 * ((length(s) - length(replace(s, '!!', ''))) // 2) >= 30 * m
    OR 4 * len(regexp_extract_all(s, '[|»›>]')) >= m
    OR (m <= 4 AND regexp_matches(low, 'home|menu|login|log in|sign in|sign up|register|search|next|previous|back|share|print|contact|about|sitemap'))
    OR regexp_matches(low, 'all rights reserved|licensed under|under the mit license|copyright|privacy policy|terms of use|terms of service|cookie|javascript|click here|read more|subscribe|powered by') AS fails
  FROM (SELECT *, translate(s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM line WHERE m > 0)
), lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup_lines,
         count(*) FILTER (fails) AS n_lines_removed, coalesce(sum(m) FILTER (NOT fails), 0) AS n_words_left
  FROM judged GROUP BY rid
), b AS (
  SELECT d.rid, doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, coalesce(n_lines_removed, 0) AS n_lines_removed,
         coalesce(n_words_left, 0) AS n_words_left
  FROM d LEFT JOIN rep USING (rid) LEFT JOIN lines USING (rid)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND 100 * (n_words - n_words_left) <= 50 * n_words AS kept,
       n_lines::BIGINT AS n_lines, n_lines_removed::BIGINT AS n_lines_removed,
       n_words_left::BIGINT AS n_words_left
FROM b
"""

SQL["op9_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), s AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
    length(text) + len(regexp_extract_all(text, '\\|\[/?INST|\[/?ROLE|<</?SYS>>|</?s>'))
      + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 17 WHEN 'assistant' THEN 6
        ELSE 16 + length(role) + len(regexp_extract_all(role, '\\|\[/?INST|\[/?ROLE|<</?SYS>>|</?s>|\]')) END AS chars
  FROM t
), r AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS upto FROM s
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  coalesce(sum(upto) FILTER (role = 'assistant'), 0)::BIGINT AS formatted_chars,
  count(*) FILTER (role = 'assistant') AS n_examples
FROM r GROUP BY conv_id
"""

SQL["op2_substring_dedup"] = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS ws FROM documents
), win AS (
  SELECT rid, doc_id, i, md5(array_to_string(ws[i:i+49], ' ')) AS g
  FROM (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d)
), hit AS (
  SELECT rid, i FROM win QUALIFY min(doc_id) OVER (PARTITION BY g) < doc_id
), gone AS (
  SELECT DISTINCT rid, p FROM (SELECT rid, unnest(range(i, i + 50)) AS p FROM hit)
), word AS (
  SELECT rid, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM d
), kept AS (
  SELECT rid, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n FROM word ANTI JOIN gone USING (rid, p) GROUP BY rid
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""


# crc32 by its table: 256 entries from the rule, then one step a byte. The phase of a source and
# the order of its rows are digests that both engines have.
SQL["op13_sharding"] = r"""
WITH RECURSIVE bits AS (
  SELECT b AS byte, b::BIGINT AS v, 0 AS k FROM range(256) t(b)
  UNION ALL
  SELECT byte, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8
), step AS MATERIALIZED (
  SELECT list(v ORDER BY byte) AS crc FROM bits WHERE k = 8
), d AS (
  SELECT doc_id, source, hex(encode(coalesce(text, ''))) AS hexed, (SELECT crc FROM step) AS crc FROM documents
), sized AS (
  SELECT doc_id, source, (length(hexed) // 2 + 8)::BIGINT AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hexed, '..'),
      lambda x: ('0x' || x)::BIGINT)),
      lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM d
), ranked AS (
  SELECT *, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER (PARTITION BY source ORDER BY
      md5('42:' || coalesce(doc_id::VARCHAR, '-') || ':' || text_crc32), doc_id NULLS FIRST, size, text_crc32) - 1 AS r
  FROM sized
), placed AS (
  SELECT *, count(*) OVER () AS total, row_number() OVER (ORDER BY
    (r::DOUBLE + (('0x' || substr(md5('42:' || coalesce(source, '-')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / n::DOUBLE,
    source NULLS FIRST, r) - 1 AS pos
  FROM ranked
)
SELECT doc_id, size, text_crc32, 'rows' AS law, ((24 * pos) // total)::INTEGER AS shard,
       (pos - (((24 * pos) // total) * total + 23) // 24)::BIGINT AS slot, NULL::INTEGER AS grown_shard
FROM placed
"""
