"""SQL for DuckDB, straight from the definitions, of the queries that SQL can express."""

from __future__ import annotations

#: Sets of distinct 3-word shingles, all pairs that share one, and the components of those at 85 % or more.
NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM w
), f AS (
  SELECT doc_id, unnest(s) AS g FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM f a JOIN f b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), walk AS (
  SELECT DISTINCT a AS doc_id, a AS reached FROM e UNION SELECT walk.doc_id, e.b FROM walk JOIN e ON walk.reached = e.a
), c AS (
  SELECT doc_id, min(reached) AS component_id FROM walk GROUP BY 1
)
SELECT s.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(component_id, s.doc_id) AS component_id, coalesce(component_id, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON c.doc_id = s.doc_id
"""

#: Every 50-byte string with the first document it starts in; the bytes that strings of earlier documents cover; what is between.
REPEATED_BYTES = """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), s AS (
  SELECT doc_id, p, substring(h, 2 * p + 1, 100) AS g FROM (SELECT doc_id, h, unnest(range(n - 49)) AS p FROM d WHERE n >= 50)
), first AS (
  SELECT g, min(doc_id) AS f FROM s GROUP BY 1 HAVING min(doc_id) < max(doc_id)
), hit AS (
  SELECT s.doc_id, p FROM s JOIN first USING (g) WHERE f < s.doc_id
), island AS (
  SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS k
  FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM hit)
), span AS (
  SELECT doc_id, min(p) AS a, max(p) + 50 AS z FROM island GROUP BY doc_id, k
), gap AS (
  SELECT doc_id, coalesce(lag(z) OVER w, 0) AS a, a AS z FROM span WINDOW w AS (PARTITION BY doc_id ORDER BY a)
  UNION ALL SELECT d.doc_id, coalesce(max(z), 0), any_value(n) FROM d LEFT JOIN span ON span.doc_id = d.doc_id GROUP BY d.doc_id
), kept AS (
  SELECT doc_id, string_agg(substring(h, 2 * a + 1, 2 * (z - a)), '' ORDER BY a) AS h FROM gap JOIN d USING (doc_id) GROUP BY 1
)
SELECT d.doc_id, n AS n_bytes, CAST(n - length(kept.h) / 2 AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept ON kept.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, count(*) AS spans FROM span GROUP BY 1) c ON c.doc_id = d.doc_id
"""

CHAT_TOKENS = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), e AS (
  SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS escaped,
    replace(replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), '\', '\\'), chr(10), '\n') AS head
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(head) + 1 + length(escaped) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

#: The base patterns and their conditions, straight from the contract.
PERSONAL_DATA_COUNTS = r"""
WITH m AS (
  SELECT doc_id, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS email, regexp_extract_all(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') AS ip,
    list_transform(regexp_extract_all(t, '[0-9]([\x20-]?[0-9])+'), lambda x: regexp_replace(x, '[^0-9]', '', 'g')) AS card,
    list_transform(regexp_extract_all(t, '\+[0-9][\x20().0-9-]+[0-9]'), lambda x: regexp_replace(x, '[^0-9]', '', 'g')) AS phone
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
)
SELECT doc_id, CAST(len(email) AS BIGINT) AS n_email,
  CAST(len(list_filter(ip, lambda x: list_max(list_transform(string_split(x, '.'), lambda y: CAST(y AS DOUBLE))) <= 255)) AS BIGINT) AS n_ip,
  CAST(len(list_filter(card, lambda x: length(x) BETWEEN 13 AND 19 AND list_sum(list_transform(range(length(x)), lambda i:
    CASE WHEN i % 2 = 0 THEN CAST(x[length(x) - i] AS INTEGER) ELSE 2 * CAST(x[length(x) - i] AS INTEGER) - CASE WHEN CAST(x[length(x) - i] AS INTEGER) > 4 THEN 9 ELSE 0 END END)) % 10 = 0)) AS BIGINT) AS n_card,
  CAST(len(list_filter(phone, lambda x: length(x) BETWEEN 9 AND 15)) AS BIGINT) AS n_phone
FROM m
"""

JPEG_PAYLOADS = """
SELECT doc_id, n AS n_bytes, p AS payload_bytes, sha256(t || repeat(' ', p - n)) AS payload_sha256 FROM (
  SELECT doc_id, t, octet_length(encode(t)) AS n, CAST(greatest(ceil(octet_length(encode(t)) / 192), 1) * 192 AS BIGINT) AS p FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
"""

RING_SLOTS = """
SELECT CAST(s AS INTEGER) AS shard, unnest(range(rows // 40 + CASE WHEN s < rows % 40 THEN 1 ELSE 0 END)) AS slot, 'rows' AS law FROM range(40) AS t(s), (SELECT count(*) AS rows FROM documents)
"""
