"""DuckDB SQL of the complaint themes: K-means by the rules of :mod:`caseflow.operators.kmeans`.

Seeding and Lloyd's steps are recursive queries over whole numbers.  A centre is its
nonzero components plus one row of term -1, so that a centre without terms stays.
"""

from __future__ import annotations

import math

from caseflow.fixed import THEME_LABEL_SEP, THEME_OTHER
from caseflow.operators.kmeans import SCALE

CLUSTERS, STARTS, SEED, MAX_ITER, TOL = 8, 10, 42, 300, 1e-4


def _uniform(step: str) -> str:
    return f"((('0x' || substr(md5(ticket_id || ':' || ({SEED} + s) || ':' || ({step})), 1, 13))::BIGINT + 0.5) / {2**52})"


def theme_clusters() -> str:
    """CTEs from ``usable``, ``tfidf`` and ``doc_tickets`` to ``c(ticket_id, theme_id, ...)`` and ``pts``."""
    return f"""
numbers AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx FROM vocab),
pts AS MATERIALIZED (SELECT ticket_id, idx, CAST(round(weight * {SCALE}) AS BIGINT) AS w FROM tfidf JOIN numbers USING (term)),
nrm AS MATERIALIZED (SELECT ticket_id, CAST(coalesce(sum(w * w), 0) AS BIGINT) AS nn FROM usable LEFT JOIN pts USING (ticket_id) GROUP BY ticket_id),
seeds AS (
  SELECT 0 AS step, s, ticket_id, nn, CAST(NULL AS BIGINT) AS far, first_value(ticket_id) OVER (PARTITION BY s ORDER BY {_uniform('0')}, ticket_id) AS pick
  FROM nrm, range({STARTS}) t(s)
  UNION ALL
  SELECT step + 1, s, ticket_id, nn, far2, first_value(ticket_id) OVER (PARTITION BY s ORDER BY CASE WHEN far2 > 0 THEN -ln({_uniform('step + 1')}) / far2 ELSE 'infinity'::DOUBLE END, ticket_id)
  FROM (
    SELECT r.step, r.s, r.ticket_id, r.nn, least(coalesce(r.far, {2**62}), r.nn + p.nn - 2 * coalesce(d.dot, 0)) AS far2
    FROM seeds r JOIN nrm p ON p.ticket_id = r.pick
    LEFT JOIN (SELECT x.ticket_id, y.ticket_id AS pick, CAST(sum(x.w * y.w) AS BIGINT) AS dot FROM pts x JOIN pts y ON x.idx = y.idx
      WHERE y.ticket_id IN (SELECT pick FROM seeds) GROUP BY ALL) d ON d.ticket_id = r.ticket_id AND d.pick = r.pick
    WHERE r.step < {CLUSTERS - 1})
),
picks AS MATERIALIZED (SELECT DISTINCT s, step AS c, pick FROM seeds),
centres AS (
  SELECT 0 AS it, s, c, idx, w AS v FROM picks JOIN pts ON pts.ticket_id = pick
  UNION ALL SELECT 0, s, c, -1, 0 FROM picks
),
moves AS (
  SELECT it, s, c, idx, v FROM centres
  UNION ALL
  (WITH cn AS (SELECT s, c, sum(v * v) AS cc FROM moves GROUP BY s, c),
  dots AS (SELECT s, c, ticket_id, sum(v * w) AS dot FROM moves JOIN pts USING (idx) GROUP BY ALL),
  near AS (SELECT s, ticket_id, arg_min(c, (cc - 2 * coalesce(dot, 0)) * {CLUSTERS} + c) AS c
    FROM cn CROSS JOIN nrm LEFT JOIN dots USING (s, c, ticket_id) GROUP BY s, ticket_id),
  sizes AS (SELECT s, c, count(*) AS n FROM near GROUP BY s, c),
  sums AS (SELECT s, c, idx, sum(w) AS t FROM near JOIN pts USING (ticket_id) GROUP BY ALL),
  fresh AS (SELECT s, c, idx, CAST((2 * t + n) // (2 * n) AS BIGINT) AS v FROM sums JOIN sizes USING (s, c)
    UNION ALL SELECT s, c, idx, v FROM moves WHERE idx >= 0 AND (s, c) NOT IN (SELECT (s, c) FROM sizes)),
  shift AS (SELECT s, c, sum((coalesce(a.v, 0) - coalesce(b.v, 0)) * (coalesce(a.v, 0) - coalesce(b.v, 0))) AS d
    FROM (SELECT * FROM fresh) a FULL JOIN (SELECT s, c, idx, v FROM moves WHERE idx >= 0) b USING (s, c, idx) GROUP BY s, c),
  live AS (SELECT s FROM shift GROUP BY s HAVING max(d) > {math.floor((TOL * SCALE) ** 2)})
  SELECT (SELECT max(it) FROM moves) + 1, s, c, idx, v FROM (
    SELECT s, c, idx, v FROM fresh WHERE v <> 0 UNION ALL SELECT DISTINCT s, c, -1, 0 FROM cn)
  WHERE s IN (SELECT s FROM live) AND (SELECT max(it) FROM moves) < {MAX_ITER})
),
final AS MATERIALIZED (SELECT s, c, idx, v FROM moves JOIN (SELECT s, max(it) AS it FROM moves GROUP BY s) USING (s, it)),
fn AS (SELECT s, c, sum(v * v) AS cc FROM final GROUP BY s, c),
fd AS (SELECT s, c, ticket_id, sum(v * w) AS dot FROM final JOIN pts USING (idx) GROUP BY ALL),
own AS MATERIALIZED (SELECT s, ticket_id, nn, arg_min(c, (cc - 2 * coalesce(dot, 0)) * {CLUSTERS} + c) AS theme_id, min(cc - 2 * coalesce(dot, 0)) AS d
  FROM fn CROSS JOIN nrm LEFT JOIN fd USING (s, c, ticket_id) GROUP BY ALL),
c AS MATERIALIZED (SELECT o.theme_id, d.ticket_id, d.category, d.csat_score, d.sla_breach, d.transfers FROM own o JOIN doc_tickets d USING (ticket_id)
  WHERE s = (SELECT arg_min(s, cost * {STARTS} + s) FROM (SELECT s, sum(nn + d) AS cost FROM own GROUP BY s)))"""


def complaint_themes_sql(docs: str, weights: str) -> str:
    """The theme table; ``docs`` and ``weights`` are the CTEs of the texts and of their TF-IDF."""
    return f"""WITH RECURSIVE {docs},{weights},{theme_clusters()},
st AS (SELECT theme_id, count(*) AS ticket_count, avg(csat_score) AS avg_csat,
  avg(CASE WHEN coalesce(sla_breach, FALSE) THEN 1.0 ELSE 0.0 END) AS sla_breach_rate,
  avg(CASE WHEN coalesce(transfers, 0) > 0 THEN 1.0 ELSE 0.0 END) AS transfer_rate FROM c GROUP BY theme_id),
m AS (SELECT theme_id, idx, sum(w) AS t FROM c JOIN pts USING (ticket_id) GROUP BY theme_id, idx),
r AS (SELECT st.theme_id, term, row_number() OVER (PARTITION BY st.theme_id ORDER BY coalesce(t, 0) DESC, term DESC) AS r
  FROM st CROSS JOIN numbers LEFT JOIN m ON m.theme_id = st.theme_id AND m.idx = numbers.idx),
tt AS (SELECT theme_id, string_agg(term, ', ' ORDER BY r) AS top_terms, string_agg(term, ', ' ORDER BY r) FILTER (WHERE r <= 3) AS top3 FROM r WHERE r <= 8 GROUP BY theme_id),
si AS (SELECT theme_id, string_agg(ticket_id, ', ' ORDER BY ticket_id) AS sample_ticket_ids
  FROM (SELECT theme_id, ticket_id, row_number() OVER (PARTITION BY theme_id ORDER BY ticket_id) AS r FROM c) WHERE r <= 8 GROUP BY theme_id),
ca AS (SELECT theme_id, category FROM (SELECT theme_id, category, row_number() OVER (PARTITION BY theme_id ORDER BY count(*) DESC, min(ticket_id), category) AS r
  FROM c WHERE category IS NOT NULL GROUP BY theme_id, category) WHERE r = 1)
SELECT CAST(theme_id AS BIGINT) AS theme_id, coalesce(category, '{THEME_OTHER}') AS category, coalesce(category, '{THEME_OTHER}') || '{THEME_LABEL_SEP}' || top3 AS theme_label,
  CAST(ticket_count AS BIGINT) AS ticket_count, top_terms, round(avg_csat, 6) AS avg_csat, round(sla_breach_rate, 6) AS sla_breach_rate,
  round(transfer_rate, 6) AS transfer_rate, sample_ticket_ids
FROM st JOIN tt USING (theme_id) JOIN si USING (theme_id) LEFT JOIN ca USING (theme_id)"""
