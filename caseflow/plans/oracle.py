"""ANSI SQL (DuckDB dialect) for every checked query.

Each statement re-derives its result from the raw driver tables: the FX3 /
FX4 views, then normalisation, de-duplication and enrichment written as SQL
CTEs, then the query itself.  Doubles are rounded to 6 places and counts are
BIGINT, like the Spark side.
"""

from __future__ import annotations

from caseflow.plans.evidence_oracle import evidence_values_sql
from caseflow.plans.theme_oracle import complaint_themes_sql
from caseflow.fixed import DEFAULT_POLICY, ENGLISH_STOP_WORDS, ENRICHMENT_COLUMNS, EVIDENCE_LIMITS, EVIDENCE_TICKET_COLUMNS, THEME_LABEL_SEP, TICKET_COLUMNS, TIER1_TEAMS


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _f(v) -> str:
    return f"CAST({float(v)!r} AS DOUBLE)"


def _dmin(ts: str, n: str) -> str:
    return f"({ts} + to_minutes(CAST({n} AS INTEGER)))"


def _micros(a: str, b: str) -> str:
    return f"(epoch_us({b}) - epoch_us({a}))"


FX3 = f"""
base AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
         {_dmin('o_orderdate', '(o_orderkey * 37) % 1440')} AS created_at,
         CAST((o_orderkey * 7) % 540 + (EXTRACT(YEAR FROM o_orderdate) - 1995) * 12 - 20 AS INT) AS fr_off,
         CAST((o_orderkey * 13) % 5000 - 60 AS INT) AS rs_off
  FROM orders),
keyed AS (
  SELECT base.*,
    CONCAT('T', CAST(k AS VARCHAR(20))) AS ticket_id,
    CASE o_orderstatus WHEN 'F' THEN 'Resolved' WHEN 'P' THEN 'closed' ELSE 'open' END AS status,
    CASE k % 5 WHEN 0 THEN 'chat' WHEN 1 THEN 'Email' WHEN 2 THEN 'voice' WHEN 3 THEN 'social' ELSE 'whatsapp' END AS channel,
    CONCAT('C', CAST(o_custkey AS VARCHAR(20))) AS customer_id,
    CONCAT('O', CAST(k AS VARCHAR(20))) AS order_id,
    CAST(k % 4 AS DOUBLE) AS transfers
  FROM base),
tickets_raw AS (
  SELECT ticket_id, created_at,
    CASE WHEN k % 17 <> 0 THEN {_dmin('created_at', 'fr_off')} END AS first_response_at,
    CASE WHEN k % 23 <> 0 THEN {_dmin('created_at', 'rs_off')} END AS resolved_at,
    status, channel, customer_id, order_id,
    CASE WHEN k % 29 <> 0 THEN o_orderpriority END AS category,
    CASE k % 20 WHEN 0 THEN 'Chat Frontline' WHEN 6 THEN 'Email Frontline' WHEN 12 THEN 'Voice Frontline' ELSE 'Warranty' END AS assigned_team,
    CASE WHEN k % 31 <> 0 THEN CONCAT('A', CAST(k % 100 AS VARCHAR(20))) END AS agent_id,
    transfers,
    CASE WHEN k % 6 <> 0 THEN CAST(k % 6 AS DOUBLE) END AS csat_score,
    'helpdesk' AS source_system, k * 2 AS seq
  FROM keyed WHERE k % 11 <> 3
  UNION ALL
  SELECT ticket_id, created_at, CASE WHEN FALSE THEN created_at END,
    CASE WHEN k % 23 <> 0 THEN {_dmin('created_at', 'rs_off - 2000')} END,
    status, channel, customer_id, order_id,
    CAST(NULL AS VARCHAR(20)), 'Chat Frontline', CAST(NULL AS VARCHAR(20)),
    transfers, CAST(NULL AS DOUBLE), 'legacy_fd', k * 2 + 1
  FROM keyed WHERE k % 11 = 3 OR k % 10 = 0),
agents AS (
  SELECT CONCAT('A', CAST(s_suppkey AS VARCHAR(20))) AS agent_id, s_name AS name,
    CASE s_suppkey % 4 WHEN 0 THEN 'Chat Frontline' WHEN 1 THEN 'Email Frontline' WHEN 2 THEN 'Voice Frontline' ELSE 'Warranty' END AS team,
    CASE s_suppkey % 3 WHEN 0 THEN 'Tier 1' WHEN 1 THEN '1' ELSE 'Tier 2' END AS tier,
    s_suppkey AS seq
  FROM supplier)"""

_BASE_COLS = [name for name, _ in TICKET_COLUMNS]
_COMPLETENESS = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in _BASE_COLS)


def _case_map(key: str, mapping: dict, default: str) -> str:
    whens = " ".join(f"WHEN {_q(str(k).lower())} THEN {_f(v)}" for k, v in mapping.items())
    return f"CASE {key} {whens} ELSE {default} END"


P = DEFAULT_POLICY
STEPS = f""",
raw AS (
  SELECT trim(ticket_id) AS ticket_id, created_at, first_response_at, resolved_at, trim(status) AS status, trim(channel) AS channel, customer_id, order_id,
    CAST(NULL AS VARCHAR) AS product_sku, category, CAST(NULL AS VARCHAR) AS priority, assigned_team, agent_id,
    transfers, NULLIF(csat_score, 0) AS csat_score, CAST(NULL AS DOUBLE) AS refund_amount_inr,
    CAST(NULL AS VARCHAR) AS refund_reason_code, CAST(NULL AS VARCHAR) AS replacement_issued,
    '' AS customer_message, '' AS agent_notes, source_system, seq
  FROM tickets_raw),
ranked AS (
  SELECT raw.*, row_number() OVER (PARTITION BY ticket_id ORDER BY
      CASE WHEN lower(coalesce(source_system, '')) = 'helpdesk' THEN 1 ELSE 0 END DESC,
      ({_COMPLETENESS}) DESC, seq) AS rn
  FROM raw),
canonical AS (SELECT {', '.join(_BASE_COLS)} FROM ranked WHERE rn = 1),
enriched0 AS (
  SELECT canonical.*, lower(trim(coalesce(channel, ''))) AS channel_key,
    {_micros('created_at', 'first_response_at')} / 1e6 / 60 AS first_response_minutes,
    {_micros('created_at', 'resolved_at')} / 1e6 / 3600 AS res_h,
    {_micros('first_response_at', 'resolved_at')} / 1e6 / 3600 AS handle_h
  FROM canonical),
enriched AS (
  SELECT {', '.join(_BASE_COLS)}, channel_key, first_response_minutes,
    CASE WHEN res_h >= 0 THEN res_h END AS resolution_time_hours,
    CASE WHEN handle_h >= 0 THEN handle_h END AS handle_time_hours,
    {_case_map('channel_key', P['first_response_sla_minutes'], 'NULL')} AS sla_target_minutes,
    coalesce(first_response_minutes > {_case_map('channel_key', P['first_response_sla_minutes'], 'NULL')}, FALSE) AS sla_breach,
    {_case_map('channel_key', P['contact_cost_inr'], _f(P['blended_cost_inr']))} AS contact_cost_inr,
    CASE WHEN coalesce(first_response_minutes > {_case_map('channel_key', P['first_response_sla_minutes'], 'NULL')}, FALSE)
         THEN {_f(P['sla_miss_credit_inr'])} ELSE CAST(0 AS DOUBLE) END AS sla_penalty_exposure_inr,
    coalesce(transfers, 0) * {_f(P['internal_transfer_cost_inr'])} AS transfer_cost_inr,
    coalesce(resolved_at < created_at, FALSE) AS resolved_before_created,
    coalesce(first_response_at < created_at, FALSE) AS first_response_before_created,
    coalesce(resolved_at < first_response_at, FALSE) AS resolved_before_first_response,
    coalesce(resolved_at < created_at, FALSE) OR coalesce(first_response_at < created_at, FALSE)
      OR coalesce(resolved_at < first_response_at, FALSE) AS temporal_anomaly,
    CAST(date_trunc('week', created_at) AS TIMESTAMP) AS week_start,
    CAST(date_trunc('week', resolved_at) AS TIMESTAMP) AS resolution_week_start,
    coalesce(lower(status) IN ('resolved', 'closed'), FALSE) AS completed_ticket
  FROM enriched0),
weekly0 AS (
  SELECT week_start, CAST(count(DISTINCT ticket_id) AS BIGINT) AS total_contacts,
    CAST(count(DISTINCT customer_id) AS BIGINT) AS unique_customers,
    CAST(count(*) FILTER (WHERE sla_breach) AS BIGINT) AS sla_breaches,
    avg(csat_score) AS avg_csat, sum(contact_cost_inr) AS contact_cost_inr,
    sum(sla_penalty_exposure_inr) AS sla_penalty_exposure_inr, sum(transfer_cost_inr) AS transfer_cost_inr
  FROM enriched WHERE week_start IS NOT NULL GROUP BY week_start),
weekly AS (
  SELECT *, CAST(sla_breaches AS DOUBLE) / NULLIF(total_contacts, 0) AS sla_breach_rate,
    CAST(total_contacts AS DOUBLE) / NULLIF(lag(total_contacts) OVER (ORDER BY week_start), 0) - 1 AS week_over_week_contacts
  FROM weekly0),
repeat AS (
  SELECT ticket_id, customer_id, created_at, category, order_id, prior_contact_at,
    {_micros('prior_contact_at', 'created_at')} / 1e6 / 86400 AS days_since_prior_contact,
    coalesce({_micros('prior_contact_at', 'created_at')} / 1e6 / 86400 BETWEEN 0 AND 7, FALSE) AS repeat_contact_7d
  FROM (SELECT ticket_id, customer_id, created_at, category, order_id,
          lag(created_at) OVER (PARTITION BY customer_id ORDER BY created_at, ticket_id NULLS LAST) AS prior_contact_at
        FROM enriched WHERE customer_id IS NOT NULL AND created_at IS NOT NULL)),
opp_totals AS (
  SELECT CAST(greatest(count(DISTINCT ticket_id), 1) AS DOUBLE) AS total,
    CAST(count(*) FILTER (WHERE sla_breach) AS BIGINT) AS breaches,
    coalesce(sum(sla_penalty_exposure_inr), 0) AS sla_cost,
    coalesce(sum(coalesce(transfers, 0)), 0) AS transfers,
    (SELECT CAST(count(*) FILTER (WHERE repeat_contact_7d) AS BIGINT) FROM repeat) AS repeats
  FROM enriched),
opportunities AS (
  SELECT 'SLA breaches' AS opportunity, breaches / total AS current_rate, CAST(breaches AS BIGINT) AS affected_volume,
    sla_cost AS modeled_exposure_inr, 'First response exceeded the channel SLA.' AS definition FROM opp_totals
  UNION ALL
  SELECT 'Internal transfers', transfers / total, CAST(trunc(transfers) AS BIGINT),
    transfers * {_f(P['internal_transfer_cost_inr'])}, 'Transfer events multiplied by policy transfer cost.' FROM opp_totals
  UNION ALL
  SELECT 'Repeat-contact proxy (7 days)', repeats / total, CAST(repeats AS BIGINT), repeats * {_f(P['blended_cost_inr'])},
    'A customer had a prior contact within 7 days; proxy, not confirmed causality.' FROM opp_totals),
roster AS (
  SELECT agent_id, name, team, tier FROM (
    SELECT *, row_number() OVER (PARTITION BY agent_id ORDER BY seq) AS rn FROM agents) WHERE rn = 1),
lb_rows AS (
  SELECT t.*, r.name AS name, coalesce(r.team, t.assigned_team) AS effective_team,
    CASE lower(trim(coalesce(r.tier, ''))) WHEN '1' THEN 'tier 1' WHEN '2' THEN 'tier 2'
         ELSE lower(trim(coalesce(r.tier, ''))) END AS tier_key
  FROM enriched t LEFT JOIN roster r ON t.agent_id IS NOT DISTINCT FROM r.agent_id),
leaderboard AS (
  SELECT resolution_week_start, agent_id, name, effective_team,
    CAST(count(DISTINCT ticket_id) AS BIGINT) AS tickets_closed,
    CAST(count(*) FILTER (WHERE sla_breach) AS BIGINT) AS sla_breaches,
    avg(csat_score) AS avg_csat, median(handle_time_hours) AS median_handle_time_hours,
    CAST(count(*) FILTER (WHERE sla_breach) AS DOUBLE) / NULLIF(count(DISTINCT ticket_id), 0) AS sla_breach_rate
  FROM lb_rows
  WHERE completed_ticket AND resolution_week_start IS NOT NULL
    AND tier_key IN ({', '.join(_q(t.lower()) for t in P['eligible_leaderboard_tiers'])})
    AND lower(trim(coalesce(effective_team, ''))) IN ({', '.join(_q(t) for t in TIER1_TEAMS)})
  GROUP BY resolution_week_start, agent_id, name, effective_team),
split0 AS (
  SELECT week_start, total_contacts, sla_breaches, count(*) OVER () AS n_weeks,
    row_number() OVER (ORDER BY week_start DESC) AS recency
  FROM weekly),
split AS (
  SELECT week_start, total_contacts, sla_breaches, CAST(n_weeks AS BIGINT) AS n_weeks,
    CASE WHEN recency <= CASE WHEN n_weeks >= 12 THEN 8 ELSE 1 END THEN 'recent' ELSE 'historical' END AS period
  FROM split0),
split2 AS (
  SELECT *, period = 'historical' AND total_contacts >= 1 AS eligible,
    CASE WHEN period = 'historical' AND total_contacts >= 1 THEN CAST(sla_breaches AS DOUBLE) / total_contacts END AS weekly_rate
  FROM split)"""

PIPELINE = FX3 + STEPS

EDGE = f"""
edge AS (
  SELECT o_orderkey AS k, o_custkey, o_orderpriority, {_dmin("TIMESTAMP '2024-01-01'", '(o_orderkey * 61) % 25920')} AS c FROM orders),
tickets_raw AS (
  SELECT CASE WHEN k % 97 = 5 THEN NULL WHEN k % 13 = 1 THEN '  T' || k || ' ' ELSE 'T' || k END AS ticket_id,
    CASE WHEN k % 41 <> 7 THEN c END AS created_at, {_dmin('c', 'k % 300 - 3')} AS first_response_at,
    {_dmin('c', '(k * 13) % 5000 - 60')} AS resolved_at, CASE WHEN k % 3 = 0 THEN ' Resolved' ELSE 'open' END AS status,
    CASE k % 3 WHEN 0 THEN 'chat' WHEN 1 THEN ' Email ' ELSE 'voice' END AS channel,
    CASE WHEN k % 37 <> 6 THEN 'C' || (o_custkey % 50) END AS customer_id, 'O' || k AS order_id,
    CASE WHEN copy = 1 AND k % 2 = 0 THEN NULL ELSE o_orderpriority END AS category, 'Email Frontline' AS assigned_team,
    CASE WHEN k % 31 <> 0 THEN 'A' || (k % 20) END AS agent_id, CAST(k % 4 AS DOUBLE) AS transfers, CAST(k % 6 AS DOUBLE) AS csat_score,
    CASE WHEN k % 43 <> 2 THEN 'helpdesk' END AS source_system, k * 2 + copy AS seq
  FROM edge, (VALUES (0), (1)) AS v(copy) WHERE copy = 0 OR k % 19 = 2),
agents AS (
  SELECT CASE WHEN s_suppkey % 11 <> 3 THEN 'A' || (s_suppkey % 20) END AS agent_id, s_name AS name,
    CASE WHEN s_suppkey % 2 = 0 THEN 'Chat Frontline' END AS team,
    CASE WHEN (s_suppkey + copy) % 3 = 0 THEN 'Tier 2' ELSE ' TIER 1 ' END AS tier, s_suppkey * 2 + copy AS seq
  FROM supplier, (VALUES (0), (1)) AS v(copy))"""
EDGE_PIPELINE = EDGE + STEPS

SPELLED = f"""
spelled AS (
  SELECT 'T' || o_orderkey AS ticket_id, o_orderkey % 12 AS way, {_dmin('o_orderdate', '(o_orderkey * 37) % 1440')} AS instant FROM orders)"""

DATE_ORDERS = f"""
dated AS (
  SELECT 'T' || o_orderkey AS ticket_id, o_orderkey AS k, {_dmin('o_orderdate', '(o_orderkey * 37) % 1440')} AS meant,
    {_dmin("date_trunc('month', o_orderdate)", '(o_orderkey % 12) * 1440 + (o_orderkey * 37) % 1440')} AS low FROM orders)"""

THEME_WEIGHTS = """
n_docs AS (SELECT count(*) AS n FROM usable),
idf AS (SELECT term, ln(CAST(1 + n AS DOUBLE) / (1 + document_frequency)) + 1 AS idf FROM vocab, n_docs),
tf AS (SELECT ticket_id, term, count(*) AS tf FROM terms GROUP BY ticket_id, term),
w AS (SELECT ticket_id, tf.term, tf * idf AS w FROM tf JOIN idf ON tf.term = idf.term),
norm AS (SELECT ticket_id, sqrt(sum(w * w)) AS norm FROM w GROUP BY ticket_id),
tfidf AS (SELECT w.ticket_id, term, w / norm AS weight FROM w JOIN norm ON w.ticket_id = norm.ticket_id)"""


def _channel_like(col: str) -> str:
    return f"""
  SELECT {col}, CAST(count(DISTINCT ticket_id) AS BIGINT) AS tickets,
    CAST(count(*) FILTER (WHERE sla_breach) AS BIGINT) AS sla_breaches, avg(csat_score) AS avg_csat,
    sum(coalesce(transfers, 0)) AS transfer_events, sum(contact_cost_inr) AS contact_cost_inr,
    sum(sla_penalty_exposure_inr) AS sla_penalty_exposure_inr,
    CAST(count(*) FILTER (WHERE sla_breach) AS DOUBLE) / NULLIF(count(DISTINCT ticket_id), 0) AS sla_breach_rate,
    sum(coalesce(transfers, 0)) * {_f(P['internal_transfer_cost_inr'])} AS transfer_cost_inr
  FROM enriched GROUP BY {col}"""


def _rounded(body: str, doubles: list[str], ctes: str = PIPELINE) -> str:
    repl = ", ".join(f"round({c}, 6) AS {c}" for c in doubles)
    star = f"* REPLACE ({repl})" if doubles else "*"
    return f"WITH {ctes},\nresult AS ({body})\nSELECT {star} FROM result"


GOAL_BODY = f"""
  WITH cnt AS (SELECT CAST(count(*) AS BIGINT) AS n_weeks FROM split2),
  rec AS (SELECT CAST(coalesce(sum(total_contacts), 0) AS BIGINT) AS rc, CAST(coalesce(sum(sla_breaches), 0) AS BIGINT) AS rb,
          CAST(count(*) AS BIGINT) AS nw FROM split2 WHERE period = 'recent'),
  cut AS (SELECT CAST(count(*) AS BIGINT) AS nh, quantile_cont(weekly_rate, 0.25) AS cutoff FROM split2 WHERE eligible),
  best AS (SELECT median(weekly_rate) AS target, CAST(count(*) AS BIGINT) AS benchmark_weeks
           FROM split2, cut WHERE eligible AND weekly_rate <= cutoff),
  obs AS (SELECT max(CASE WHEN opportunity = 'Internal transfers' THEN current_rate END) AS t_rate,
                 max(CASE WHEN opportunity = 'Internal transfers' THEN modeled_exposure_inr END) AS t_exp,
                 max(CASE WHEN opportunity = 'Repeat-contact proxy (7 days)' THEN current_rate END) AS r_rate,
                 max(CASE WHEN opportunity = 'Repeat-contact proxy (7 days)' THEN modeled_exposure_inr END) AS r_exp
          FROM opportunities),
  g AS (SELECT *, CAST(rb AS DOUBLE) / NULLIF(rc, 0) AS cur,
          CAST(rc AS DOUBLE) / NULLIF(nw, 0) AS per_week FROM cnt, rec, cut, best, obs),
  h AS (SELECT *, cur - target AS gap,
          greatest(CAST(0 AS DOUBLE), CAST(rb AS DOUBLE) / NULLIF(nw, 0) - per_week * target) AS avoidable,
          n_weeks >= 4 AND nh >= 4 AS enough_history FROM g),
  f AS (SELECT *, enough_history AND coalesce(gap >= 0.005, FALSE) AS available FROM h)
  SELECT available,
    CASE WHEN n_weeks = 0 THEN 'Not enough weekly data to establish a business goal.'
         WHEN n_weeks < 4 THEN 'Not enough historical weeks to establish a defensible benchmark.'
         WHEN NOT enough_history THEN 'Not enough historical weeks remain after establishing the current baseline.'
         WHEN NOT available THEN 'No opportunity has a sufficiently large historical improvement gap to support an evidence-backed target.'
    END AS reason,
    CASE WHEN n_weeks > 0 THEN n_weeks END AS eligible_weeks,
    CASE WHEN available THEN 'SLA breach rate' END AS metric,
    CASE WHEN available THEN cur END AS current_rate,
    CASE WHEN available THEN target END AS target_rate,
    CASE WHEN available THEN gap END AS improvement_gap,
    CASE WHEN available THEN rc END AS current_volume,
    CASE WHEN available THEN avoidable END AS avoidable_volume_per_week,
    CASE WHEN available THEN avoidable * 13 END AS quarterly_volume_reduction,
    CASE WHEN available THEN {_f(P['sla_miss_credit_inr'])} END AS unit_cost_inr,
    CASE WHEN available THEN avoidable * 13 * {_f(P['sla_miss_credit_inr'])} END AS quarterly_value_inr,
    CASE WHEN available THEN avoidable * 13 * {_f(P['sla_miss_credit_inr'])} END AS modeled_quarterly_exposure_reduction_inr,
    CASE WHEN available THEN per_week END AS average_weekly_volume,
    CASE WHEN available THEN 'Median SLA breach rate among historical lower-quartile weeks.' END AS benchmark_method,
    CASE WHEN available THEN CASE WHEN nw = 8 THEN 'Most recent 8 weeks' ELSE 'Most recent week' END END AS baseline_period,
    CASE WHEN available THEN 'All earlier available weeks' END AS historical_period,
    CASE WHEN enough_history AND NOT available THEN cur END AS current_sla_rate,
    CASE WHEN enough_history AND NOT available THEN target END AS historical_sla_benchmark,
    CASE WHEN enough_history AND NOT available THEN t_rate END AS transfers_current_rate,
    CASE WHEN enough_history AND NOT available THEN t_exp END AS transfers_modeled_exposure_inr,
    CASE WHEN enough_history AND NOT available THEN r_rate END AS repeat_current_rate,
    CASE WHEN enough_history AND NOT available THEN r_exp END AS repeat_modeled_exposure_inr,
    CASE WHEN enough_history THEN cutoff END AS benchmark_cutoff_rate,
    CASE WHEN enough_history THEN benchmark_weeks END AS benchmark_weeks
  FROM f"""

_GOAL_DOUBLES = [
    "current_rate", "target_rate", "improvement_gap", "avoidable_volume_per_week", "quarterly_volume_reduction",
    "unit_cost_inr", "quarterly_value_inr", "modeled_quarterly_exposure_reduction_inr", "average_weekly_volume",
    "current_sla_rate", "historical_sla_benchmark", "transfers_current_rate", "transfers_modeled_exposure_inr",
    "repeat_current_rate", "repeat_modeled_exposure_inr", "benchmark_cutoff_rate",
]

_ENRICHED_DOUBLES = [
    "transfers", "csat_score", "refund_amount_inr", "first_response_minutes", "resolution_time_hours",
    "handle_time_hours", "sla_target_minutes", "contact_cost_inr", "sla_penalty_exposure_inr", "transfer_cost_inr",
]
_GROUP_DOUBLES = ["avg_csat", "transfer_events", "contact_cost_inr", "sla_penalty_exposure_inr", "sla_breach_rate", "transfer_cost_inr"]
_WEEKLY_DOUBLES = ["avg_csat", "contact_cost_inr", "sla_penalty_exposure_inr", "transfer_cost_inr", "sla_breach_rate", "week_over_week_contacts"]
_LB_DOUBLES = ["avg_csat", "median_handle_time_hours", "sla_breach_rate"]

# Quality report (long form).
_QUALITY_BODY = """
  WITH cs AS (
    SELECT coalesce(source_system, '<NA>') AS source, count(*) AS n,
      count(*) FILTER (WHERE resolved_at IS NULL) AS n_missing_resolved,
      count(*) FILTER (WHERE agent_id IS NULL) AS n_missing_agent,
      count(*) FILTER (WHERE created_at IS NULL) AS n_invalid_created,
      count(*) FILTER (WHERE resolved_before_created) AS c_rbc,
      count(*) FILTER (WHERE first_response_before_created) AS c_frbc,
      count(*) FILTER (WHERE resolved_before_first_response) AS c_rbfr,
      count(*) FILTER (WHERE temporal_anomaly) AS c_anom
    FROM enriched GROUP BY 1),
  rs AS (
    SELECT coalesce(source_system, '<NA>') AS source,
      count(*) FILTER (WHERE resolved_at < created_at) AS r_rbc,
      count(*) FILTER (WHERE first_response_at < created_at) AS r_frbc,
      count(*) FILTER (WHERE resolved_at < first_response_at) AS r_rbfr
    FROM raw GROUP BY 1),
  grp AS (SELECT ticket_id, count(*) AS n,
      bool_or(lower(source_system) = 'helpdesk') AS has_pref, bool_or(lower(source_system) = 'legacy_fd') AS has_legacy
    FROM raw GROUP BY ticket_id),
  dup AS (SELECT sum(n) AS raw_rows, count(*) AS canonical_rows, count(ticket_id) AS unique_ticket_ids,
      coalesce(sum(n) FILTER (WHERE ticket_id IS NOT NULL AND n > 1), 0) AS duplicate_ticket_rows,
      count(*) FILTER (WHERE ticket_id IS NOT NULL AND n > 1) AS duplicate_ticket_id_groups,
      count(*) FILTER (WHERE ticket_id IS NOT NULL AND n > 1 AND coalesce(has_pref AND has_legacy, FALSE)) AS duplicate_pairs_helpdesk_legacy
    FROM grp),
  ct AS (SELECT sum(n) AS n, sum(n_missing_resolved) AS missing_resolved_at, sum(n_missing_agent) AS missing_agent_id,
      sum(n_invalid_created) AS invalid_created_at, sum(c_rbc) AS c_rbc, sum(c_frbc) AS c_frbc, sum(c_rbfr) AS c_rbfr,
      sum(c_anom) AS c_anom FROM cs),
  rt AS (SELECT sum(r_rbc) AS r_rbc, sum(r_frbc) AS r_frbc, sum(r_rbfr) AS r_rbfr FROM rs),
  t AS (SELECT * FROM dup, ct, rt)
  SELECT metric, CAST(NULL AS VARCHAR) AS key, CAST(value AS DOUBLE) AS value FROM t UNPIVOT (value FOR metric IN (
    raw_rows, canonical_rows, unique_ticket_ids, duplicate_ticket_rows, duplicate_ticket_id_groups,
    duplicate_pairs_helpdesk_legacy, missing_resolved_at, missing_agent_id, invalid_created_at))
  UNION ALL SELECT 'resolved_before_created', NULL, r_rbc FROM t
  UNION ALL SELECT 'first_response_before_created', NULL, r_frbc FROM t
  UNION ALL SELECT 'resolved_before_first_response', NULL, r_rbfr FROM t
  UNION ALL SELECT 'canonical_resolved_before_created', NULL, c_rbc FROM t
  UNION ALL SELECT 'canonical_first_response_before_created', NULL, c_frbc FROM t
  UNION ALL SELECT 'canonical_resolved_before_first_response', NULL, c_rbfr FROM t
  UNION ALL SELECT 'canonical_temporal_anomalies', NULL, c_anom FROM t
  UNION ALL SELECT 'canonical_temporal_anomaly_rate', NULL, round_even(CAST(c_anom AS DOUBLE) * 100 / n, 2) FROM t
  UNION ALL SELECT 'source_system_counts', source, n FROM cs
  UNION ALL SELECT 'resolved_before_created_by_source', source, r_rbc FROM rs WHERE r_rbc > 0
  UNION ALL SELECT 'canonical_temporal_anomalies_by_source', source, c_anom FROM cs WHERE c_anom > 0"""

# FX4 + text clean.
_WS = r"[\x09-\x0D\x1C-\x1F\x{85}\pZ]+"
DOCS = f"""
doc_tickets AS (
  SELECT CONCAT('D', CAST(d.doc_id AS VARCHAR)) AS ticket_id,
    trim(regexp_replace(coalesce(d.text, ''), '{_WS}', ' ', 'g')) AS customer_message,
    '' AS agent_notes, d.lang AS category, CAST(d.doc_id % 4 AS DOUBLE) AS transfers,
    CAST(1 AS DOUBLE) + 4 * CAST(l.quality AS DOUBLE) AS csat_score, d.doc_id % 3 = 0 AS sla_breach
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
theme_text AS (
  SELECT ticket_id, trim(regexp_replace(customer_message || ' ' || agent_notes, '^{_WS}|{_WS}$', '', 'g')) AS theme_text
  FROM doc_tickets),
usable AS (SELECT * FROM theme_text WHERE length(theme_text) >= 15),
stop_words AS (SELECT unnest([{', '.join(_q(w) for w in ENGLISH_STOP_WORDS)}]) AS w),
toks AS (
  SELECT ticket_id, unnest(t) AS tok, generate_subscripts(t, 1) AS pos
  FROM (SELECT ticket_id, regexp_extract_all(lower(theme_text), '[\\pL\\pN_]{{2,}}') AS t FROM usable)),
kept AS (SELECT * FROM toks WHERE tok NOT IN (SELECT w FROM stop_words)),
terms AS (
  SELECT ticket_id, tok AS term FROM kept
  UNION ALL
  SELECT ticket_id, term FROM (
    SELECT ticket_id, tok || ' ' || lead(tok) OVER (PARTITION BY ticket_id ORDER BY pos) AS term FROM kept)
  WHERE term IS NOT NULL),
vocab AS (
  SELECT term, CAST(count(DISTINCT ticket_id) AS BIGINT) AS document_frequency,
    CAST(count(*) AS BIGINT) AS corpus_frequency
  FROM terms GROUP BY term HAVING count(DISTINCT ticket_id) >= 2
  ORDER BY corpus_frequency DESC, term LIMIT 5000)"""

_SAMPLE = """SELECT ticket_id, CAST(created_at AS VARCHAR) AS created_at, channel, category, priority, assigned_team,
             agent_id, transfers, csat_score, refund_amount_inr, refund_reason_code, replacement_issued,
             customer_message, agent_notes, source_system
           FROM enriched ORDER BY ticket_id NULLS LAST LIMIT 12"""


def _whole_minutes(ts: str) -> str:
    return f"date_trunc('minute', {ts})"


def oracle_sql() -> dict[str, str]:
    enriched_cols = _BASE_COLS + ENRICHMENT_COLUMNS
    q: dict[str, str] = {}
    q["ticket_enrichment"] = _rounded(f"SELECT {', '.join(enriched_cols)} FROM enriched", _ENRICHED_DOUBLES)
    q["canonical_tickets"] = _rounded("SELECT * FROM canonical", ["transfers", "csat_score", "refund_amount_inr"])
    q["duplicate_counters"] = _rounded(
        """SELECT CAST(sum(n) AS BIGINT) AS raw_rows, CAST(count(*) AS BIGINT) AS canonical_rows,
             CAST(count(ticket_id) AS BIGINT) AS unique_ticket_ids,
             CAST(coalesce(sum(n) FILTER (WHERE ticket_id IS NOT NULL AND n > 1), 0) AS BIGINT) AS duplicate_ticket_rows,
             CAST(count(*) FILTER (WHERE ticket_id IS NOT NULL AND n > 1) AS BIGINT) AS duplicate_ticket_id_groups,
             CAST(count(*) FILTER (WHERE ticket_id IS NOT NULL AND n > 1 AND coalesce(has_pref AND has_legacy, FALSE)) AS BIGINT)
               AS duplicate_pairs_helpdesk_legacy
           FROM (SELECT ticket_id, count(*) AS n, bool_or(lower(source_system) = 'helpdesk') AS has_pref,
                   bool_or(lower(source_system) = 'legacy_fd') AS has_legacy FROM raw GROUP BY ticket_id)""",
        [],
    )
    q["quality_report_long"] = _rounded(_QUALITY_BODY, ["value"])
    q["source_value_counts"] = _rounded(
        """SELECT coalesce(c.source, r.source) AS source, CAST(coalesce(c.n, 0) AS BIGINT) AS canonical_rows,
             CAST(coalesce(r.r_rbc, 0) AS BIGINT) AS raw_resolved_before_created,
             CAST(coalesce(c.c_anom, 0) AS BIGINT) AS canonical_temporal_anomalies
           FROM (SELECT coalesce(source_system, '<NA>') AS source, count(*) AS n,
                   count(*) FILTER (WHERE temporal_anomaly) AS c_anom FROM enriched GROUP BY 1) c
           FULL OUTER JOIN (SELECT coalesce(source_system, '<NA>') AS source,
                   count(*) FILTER (WHERE resolved_at < created_at) AS r_rbc FROM raw GROUP BY 1) r
           ON c.source = r.source""",
        [],
    )
    q["weekly_metrics"] = _rounded("SELECT * FROM weekly", _WEEKLY_DOUBLES)
    q["channel_metrics"] = _rounded(_channel_like("channel"), _GROUP_DOUBLES)
    q["category_metrics"] = _rounded(_channel_like("category"), _GROUP_DOUBLES)
    q["repeat_contacts"] = _rounded("SELECT * FROM repeat", ["days_since_prior_contact"])
    q["opportunities"] = _rounded("SELECT * FROM opportunities", ["current_rate", "modeled_exposure_inr"])
    q["tier1_leaderboard"] = _rounded("SELECT * FROM leaderboard", _LB_DOUBLES)
    q["goal_baseline_split"] = _rounded(
        "SELECT week_start, total_contacts, sla_breaches, n_weeks, period, eligible, weekly_rate FROM split2",
        ["weekly_rate"],
    )
    q["business_goal"] = _rounded(GOAL_BODY, _GOAL_DOUBLES)
    q["top_breach_channel"] = _rounded(
        f"SELECT * FROM ({_channel_like('channel')}) ORDER BY sla_breach_rate DESC NULLS LAST, channel ASC NULLS FIRST LIMIT 1",
        _GROUP_DOUBLES,
    )
    q["top_opportunity"] = _rounded(
        "SELECT * FROM opportunities ORDER BY modeled_exposure_inr DESC, opportunity LIMIT 1",
        ["current_rate", "modeled_exposure_inr"],
    )
    q["latest_week_kpis"] = _rounded(
        """SELECT w.week_start, w.total_contacts, w.sla_breach_rate,
             (SELECT CAST(count(*) AS BIGINT) FROM enriched) AS canonical_rows,
             (SELECT sum(modeled_exposure_inr) FROM opportunities) AS total_modeled_exposure_inr
           FROM weekly w WHERE w.week_start = (SELECT max(week_start) FROM weekly)""",
        ["sla_breach_rate", "total_modeled_exposure_inr"],
    )
    q["top_quality_issue"] = _rounded(
        """SELECT coalesce(source_system, '<NA>') AS source, CAST(count(*) AS BIGINT) AS canonical_rows,
             CAST(count(*) FILTER (WHERE temporal_anomaly) AS BIGINT) AS temporal_anomalies,
             CAST(count(*) FILTER (WHERE temporal_anomaly) AS DOUBLE) / count(*) AS anomaly_rate
           FROM enriched GROUP BY 1 ORDER BY anomaly_rate DESC, source LIMIT 1""",
        ["anomaly_rate"],
    )
    q["latest_leaderboard_80"] = _rounded(
        """SELECT * FROM leaderboard ORDER BY resolution_week_start DESC, tickets_closed DESC,
             agent_id ASC NULLS FIRST, name ASC NULLS FIRST, effective_team ASC NULLS FIRST LIMIT 80""",
        _LB_DOUBLES,
    )
    q["ticket_sample"] = _rounded(
        _SAMPLE,
        ["transfers", "csat_score", "refund_amount_inr"],
    )
    q["weekly_trend"] = _rounded(
        "SELECT week_start, total_contacts, sla_breach_rate * 100 AS sla_breach_rate_pct FROM weekly",
        ["sla_breach_rate_pct"],
    )
    docs_ctes = DOCS
    q["text_clean"] = f"""WITH {docs_ctes}
SELECT t.ticket_id, t.theme_text, CAST(length(t.theme_text) AS BIGINT) AS text_length,
  length(t.theme_text) >= 15 AS usable
FROM theme_text t"""
    q["theme_vocabulary"] = f"""WITH {docs_ctes},
n_docs AS (SELECT count(*) AS n FROM usable)
SELECT term, document_frequency, corpus_frequency,
  round(ln(CAST(1 + n AS DOUBLE) / (1 + document_frequency)) + 1, 6) AS idf
FROM vocab, n_docs"""
    q["theme_tfidf"] = f"WITH {docs_ctes},{THEME_WEIGHTS}\nSELECT ticket_id, term, round(weight, 6) AS weight FROM tfidf"
    q["theme_summary"] = f"""WITH {docs_ctes},{THEME_WEIGHTS},
c AS (SELECT t.ticket_id, d.category, d.csat_score, d.sla_breach, d.transfers, dense_rank() OVER (ORDER BY d.category) - 1 AS theme_id
  FROM usable t JOIN doc_tickets d ON t.ticket_id = d.ticket_id),
st AS (SELECT theme_id, min(category) AS category, count(*) AS ticket_count, avg(csat_score) AS avg_csat,
  avg(CASE WHEN coalesce(sla_breach, FALSE) THEN 1.0 ELSE 0.0 END) AS sla_breach_rate,
  avg(CASE WHEN coalesce(transfers, 0) > 0 THEN 1.0 ELSE 0.0 END) AS transfer_rate FROM c GROUP BY theme_id),
m AS (SELECT theme_id, term, sum(weight) AS s FROM tfidf JOIN c ON tfidf.ticket_id = c.ticket_id GROUP BY theme_id, term),
r AS (SELECT m.theme_id, term, row_number() OVER (PARTITION BY m.theme_id ORDER BY round(s / ticket_count, 15) DESC, term DESC) AS r FROM m JOIN st ON m.theme_id = st.theme_id),
tt AS (SELECT theme_id, string_agg(term, ', ' ORDER BY r) AS top_terms, string_agg(term, ', ' ORDER BY r) FILTER (WHERE r <= 3) AS top3 FROM r WHERE r <= 8 GROUP BY theme_id),
si AS (SELECT theme_id, string_agg(ticket_id, ', ' ORDER BY ticket_id) AS sample_ticket_ids
  FROM (SELECT theme_id, ticket_id, row_number() OVER (PARTITION BY theme_id ORDER BY ticket_id) AS r FROM c) WHERE r <= 8 GROUP BY theme_id)
SELECT CAST(st.theme_id AS BIGINT) AS theme_id, category, CAST(ticket_count AS BIGINT) AS ticket_count, round(avg_csat, 6) AS avg_csat,
  round(sla_breach_rate, 6) AS sla_breach_rate, round(transfer_rate, 6) AS transfer_rate, sample_ticket_ids,
  category || {_q(THEME_LABEL_SEP)} || top3 AS theme_label, top_terms
FROM st JOIN tt ON st.theme_id = tt.theme_id JOIN si ON st.theme_id = si.theme_id"""
    q["complaint_themes"] = complaint_themes_sql(docs_ctes, THEME_WEIGHTS)
    q["theme_watchlist"] = f"""SELECT * FROM ({q['complaint_themes']})
ORDER BY avg_csat ASC NULLS LAST, ticket_count DESC, theme_id LIMIT 20"""
    q["ticket_normalisation"] = f"WITH {SPELLED}\nSELECT ticket_id, CASE WHEN way < 10 THEN {_whole_minutes('instant')} END AS created_at FROM spelled"
    q["timestamp_parsing"] = f"""WITH {SPELLED}
SELECT 'created_at' AS "column", CAST(count(*) FILTER (WHERE way <> 11) AS BIGINT) AS "values", CAST(count(*) FILTER (WHERE way = 10) AS BIGINT) AS unparsed FROM spelled"""
    # the day-first column elects its order; of the few month-first values those stay that read as day first, too
    swapped = "make_timestamp(year(meant), day(meant), month(meant), hour(meant), minute(meant), 0)"
    q["date_order_parsing"] = f"""WITH {DATE_ORDERS}
SELECT ticket_id, CASE WHEN k % 50 <> 1 THEN {_whole_minutes('meant')} WHEN day(meant) <= 12 THEN {swapped} END AS created_at,
  {_whole_minutes('low')} AS first_response_at, {_whole_minutes('meant')} AS resolved_at FROM dated"""
    q["date_orders"] = f"""WITH {DATE_ORDERS}
SELECT 'created_at' AS "column", count(*) AS slashed, count(*) FILTER (WHERE k % 50 <> 1 AND day(meant) > 12) AS day_first,
  count(*) FILTER (WHERE k % 50 = 1 AND day(meant) > 12) AS month_first, 'day first' AS date_order FROM dated
UNION ALL SELECT 'first_response_at', count(*), 0, 0, 'ambiguous' FROM dated
UNION ALL SELECT 'resolved_at', count(*), 0, count(*) FILTER (WHERE day(meant) > 12), 'month first' FROM dated"""
    for name, body, doubles in (
        ("edge_canonical", "SELECT * FROM canonical", ["transfers", "csat_score", "refund_amount_inr"]),
        ("edge_repeat", "SELECT * FROM repeat", ["days_since_prior_contact"]),
        ("edge_leaderboard", "SELECT * FROM leaderboard", _LB_DOUBLES),
        ("edge_quality", _QUALITY_BODY, ["value"]),
        ("edge_goal", GOAL_BODY, _GOAL_DOUBLES),
        ("edge_sample", _SAMPLE, ["transfers", "csat_score", "refund_amount_inr"]),
    ):
        q[name] = _rounded(body, doubles, EDGE_PIPELINE)
    parts = " UNION ALL ".join(
        f"SELECT '{part}' AS part, CAST(count(*) AS BIGINT) AS total, CAST({f'least(count(*), {EVIDENCE_LIMITS[part]})'} AS BIGINT) AS records FROM ({body})"
        for part, body in (
            ("weekly_metrics", "SELECT * FROM weekly"), ("opportunities", "SELECT * FROM opportunities"), ("channel_metrics", _channel_like("channel")),
            ("category_metrics", _channel_like("category")), ("tier1_leaderboard_latest_weeks", "SELECT * FROM leaderboard"), ("ticket_sample", "SELECT * FROM enriched"),
        )
    )
    q["evidence_parts"] = _rounded(parts, [])
    q["evidence_values"] = evidence_values_sql(PIPELINE, {
        "weekly_metrics": ("SELECT * FROM weekly", "week_start"),
        "opportunities": ("SELECT * FROM opportunities", "modeled_exposure_inr DESC, opportunity"),
        "channel_metrics": (_channel_like("channel"), "tickets DESC, channel ASC NULLS FIRST"),
        "category_metrics": (_channel_like("category"), "tickets DESC, category ASC NULLS FIRST"),
        "tier1_leaderboard_latest_weeks": ("SELECT * FROM leaderboard", "resolution_week_start DESC, tickets_closed DESC, agent_id ASC NULLS FIRST, name ASC NULLS FIRST, effective_team ASC NULLS FIRST"),
        "ticket_sample": (f"SELECT {', '.join(EVIDENCE_TICKET_COLUMNS)} FROM enriched", "ticket_id ASC NULLS LAST"),
    }, _QUALITY_BODY, GOAL_BODY)
    for name, body, keys, order in (
        ("weekly", "SELECT * FROM weekly", "week_start", "week_start"),
        ("channel", _channel_like("channel"), "channel, tickets", "tickets DESC, channel ASC NULLS FIRST"),
        ("category", _channel_like("category"), "category, tickets", "tickets DESC, category ASC NULLS FIRST"),
        ("repeat", "SELECT * FROM repeat", "customer_id, created_at, ticket_id", "customer_id, created_at, ticket_id ASC NULLS LAST"),
        ("opportunities", "SELECT * FROM opportunities", "opportunity", "modeled_exposure_inr DESC, opportunity"),
        ("leaderboard", "SELECT * FROM leaderboard", "resolution_week_start, tickets_closed, agent_id", "resolution_week_start, tickets_closed DESC, agent_id ASC NULLS FIRST"),
    ):
        q[f"order_{name}"] = _rounded(f"SELECT {keys}, row_number() OVER (ORDER BY {order}) - 1 AS position FROM ({body})", [])
    ways = (("week", "week_start", "CAST(NULL AS VARCHAR)"), ("channel", "CAST(NULL AS TIMESTAMP)", "channel"), ("category", "CAST(NULL AS TIMESTAMP)", "category"),
            ("source", "CAST(NULL AS TIMESTAMP)", "coalesce(source_system, '<NA>')"))
    q["group_metrics"] = _rounded(" UNION ALL ".join(
        f"""SELECT '{kind}' AS kind, {week} AS week, {key} AS key, count(ticket_id) AS tickets, {'count(DISTINCT customer_id)' if kind == 'week' else '0'} AS unique_customers,
  count(*) FILTER (WHERE sla_breach) AS sla_breaches, avg(csat_score) AS avg_csat, sum(coalesce(transfers, 0)) AS transfer_events, sum(contact_cost_inr) AS contact_cost_inr,
  sum(sla_penalty_exposure_inr) AS sla_penalty_exposure_inr, sum(transfer_cost_inr) AS transfer_cost_inr, count(*) AS n, count(*) FILTER (WHERE resolved_at IS NULL) AS n_missing_resolved,
  count(*) FILTER (WHERE agent_id IS NULL) AS n_missing_agent, count(*) FILTER (WHERE created_at IS NULL) AS n_invalid_created, count(*) FILTER (WHERE resolved_before_created) AS c_rbc,
  count(*) FILTER (WHERE first_response_before_created) AS c_frbc, count(*) FILTER (WHERE resolved_before_first_response) AS c_rbfr, count(*) FILTER (WHERE temporal_anomaly) AS c_anom
FROM enriched {"WHERE week_start IS NOT NULL" if kind == "week" else ""} GROUP BY ALL""" for kind, week, key in ways
    ), ["avg_csat", "transfer_events", "contact_cost_inr", "sla_penalty_exposure_inr", "transfer_cost_inr"])
    q["order_themes"] = f"SELECT theme_id, ticket_count, row_number() OVER (ORDER BY ticket_count DESC, theme_id) - 1 AS position FROM ({q['complaint_themes']})"
    return q
