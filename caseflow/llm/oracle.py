"""DuckDB SQL for the operators whose whole result SQL can express."""

from __future__ import annotations

OP7 = r"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS payload FROM pages
), d AS (
  SELECT page_id, url, octet_length(encode(payload)) AS payload_bytes, sha256(payload) AS payload_digest FROM p
), f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, d.payload_digest,
       CASE WHEN page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to, url AS target_uri
FROM d LEFT JOIN f ON d.payload_digest = f.payload_digest AND payload_bytes >= 100
"""

OP8 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS ws
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS sh
  FROM w
), n AS (
  SELECT doc_id, len(sh) AS n FROM s
), e AS (
  SELECT doc_id, unnest(sh) AS x FROM s
), c AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 85 * (na.n + nb.n - k)
), r(a, b) AS (
  SELECT doc_id, doc_id FROM n UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, min(r.b) AS component_id, min(r.b) = n.doc_id AS kept
FROM n JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n.n
"""

ORACLES = {"op7_warc": OP7, "op8_minhash_dedup": OP8}
