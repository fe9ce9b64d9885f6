"""DuckDB texts for the queries that SQL can express."""

_W = r"[^\x20\x09-\x0D]+"

_B32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

SQL = {
    "op3_chat_formatting": r"""
WITH r AS (
  SELECT conv_id, turn::BIGINT AS turn, regexp_replace(coalesce(role, 'unknown'), '[\r\n]', '_', 'g') AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS body, floor(turn / 256)::BIGINT AS part
  FROM conversations),
t AS (
  SELECT *, ((row_number() OVER (PARTITION BY conv_id, part ORDER BY turn NULLS FIRST, speaker, body) - 1) // 4096)::BIGINT AS sub,
         dense_rank() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, body) AS place,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, body) AS id
  FROM r),
who AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> 'system'),
pre AS (
  SELECT conv_id, min(place) AS pre_place,
         '<|im_start|>system' || chr(10) || arg_min(body, place) || '<|im_end|>' || chr(10) AS preamble
  FROM t WHERE speaker = 'system' GROUP BY conv_id),
j AS (
  SELECT t.*, perspective, speaker = perspective AS mine, preamble, pre_place,
         CASE WHEN speaker = perspective THEN '<|im_start|>assistant' WHEN speaker = 'system' THEN '<|im_start|>system'
              ELSE '<|im_start|>user name=' || speaker END || chr(10) AS head, body || '<|im_end|>' || chr(10) AS rest
  FROM t JOIN who ON t.conv_id IS NOT DISTINCT FROM who.conv_id LEFT JOIN pre ON t.conv_id IS NOT DISTINCT FROM pre.conv_id),
l AS (
  SELECT *, CASE WHEN min(place) OVER (PARTITION BY conv_id, perspective, part, sub) > pre_place THEN preamble ELSE '' END AS lead
  FROM j),
o AS (
  SELECT *, length(lead) + sum(length(head) + length(rest)) OVER (PARTITION BY conv_id, perspective, part, sub
    ORDER BY id ROWS UNBOUNDED PRECEDING)::BIGINT AS e FROM l)
SELECT conv_id, perspective, part, sub, count(*) AS n_turns, first(lead) || string_agg(head || rest, '' ORDER BY id) AS text,
       coalesce(string_agg((e - length(rest)) || ':' || e, ',' ORDER BY id) FILTER (WHERE mine), '') AS mask
FROM o GROUP BY conv_id, perspective, part, sub""",
    "op7_warc": f"""
WITH h AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS x
           FROM pages),
d AS (SELECT *, array_to_string(list_transform(range(32), lambda i: substr('{_B32}', 1 +
        (((('0x' || substr(x, (i // 4) * 5 + 1, 5))::INTEGER) >> (15 - 5 * (i % 4))) & 31)::INTEGER, 1)), '')
        AS payload_digest FROM h),
t AS (SELECT *, max(page_id) OVER (PARTITION BY x) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to, true AS intact
FROM t""",
    "op10_quality_rules": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{_W}') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_W}')) AS ls
  FROM documents),
win AS (
  SELECT r, i, w[i:i+4] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest(range(0, 5)) AS j) GROUP BY r),
m AS (
  SELECT doc_id, t, ls, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
  FROM d LEFT JOIN cov USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 2 * n_words AND 25 * n_words
         AND 100 * n_symbols <= 5 * word_chars AND regexp_matches(t, '\p{{L}}')
         AND (n_dup_lines < 2 OR 100 * (length(array_to_string(ls, '')) - length(array_to_string(list_distinct(ls), '')))
             <= 30 * length(array_to_string(ls, ''))) AS kept
FROM b""",
    "op11_filter_interaction_audit": rf"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_W}') AS w
  FROM documents),
m AS (
  SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
g AS (
  SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM m LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (
  SELECT x1.f || x2.f || x3.f || x4.f || x5.f AS filter_order FROM x x1, x x2, x x3, x x4, x x5
  WHERE len(list_distinct([x1.f, x2.f, x3.f, x4.f, x5.f])) = 5),
r AS (
  SELECT g.*, filter_order, list_min([
    CASE WHEN a THEN strpos(filter_order, 'A') END, CASE WHEN b THEN strpos(filter_order, 'B') END,
    CASE WHEN c THEN strpos(filter_order, 'C') END, CASE WHEN d THEN strpos(filter_order, 'D') END,
    CASE WHEN e THEN strpos(filter_order, 'E') END]) AS gone
  FROM g, o),
s AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS f,
         sum(n) FILTER (WHERE gone IS NULL OR gone > step) AS kept, sum(n) FILTER (WHERE gone = step) AS removed,
         sum(n) FILTER (WHERE gone < step AND CASE substr(filter_order, step, 1)
           WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END) AS redundant,
         sum(n) FILTER (WHERE a::INT + b::INT + c::INT + d::INT + e::INT = 1 AND CASE substr(filter_order, step, 1)
           WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END) AS unique_fails,
         sum(good) FILTER (WHERE gone = step) AS good_lost, sum(toxic) FILTER (WHERE gone = step) AS toxic_lost
  FROM r, (SELECT unnest(range(1, 6)) AS step) GROUP BY part, filter_order, step)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
FROM s""",
}
