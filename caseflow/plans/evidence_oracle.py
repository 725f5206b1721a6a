"""DuckDB SQL of the evidence document's values: its parts as JSON objects, a row per key."""

from __future__ import annotations

from caseflow.fixed import EVIDENCE_LIMITS, GOAL_REASON_NO_GAP, INTERPRETATION_RULES
from caseflow.operators.goal import _AVAILABLE_KEYS


#: The timestamp column of a part.
TIMES = {"weekly_metrics": "week_start", "tier1_leaderboard_latest_weeks": "resolution_week_start", "ticket_sample": "created_at"}


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(path: str, rows: str) -> str:
    """Rows ``path, kind, text, number`` of the keys of the objects ``doc`` in ``rows``."""
    return f"""SELECT {path} || j.key AS path,
  CASE j.type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind,
  CASE WHEN j.type IN ('VARCHAR', 'BOOLEAN') THEN j.value ->> '$' END AS text,
  CASE WHEN j.type NOT IN ('VARCHAR', 'BOOLEAN', 'NULL') THEN round(CAST(j.value ->> '$' AS DOUBLE), 6) END AS number
FROM ({rows}) r, json_each(r.doc) j"""


def evidence_values_sql(ctes: str, lists: dict[str, tuple[str, str]], quality: str, goal: str) -> str:
    """``lists``: part -> (body, order)."""
    parts = []
    for name, (body, order) in lists.items():
        limit = f"LIMIT {EVIDENCE_LIMITS[name]}" if EVIDENCE_LIMITS[name] is not None else ""
        numbered = f"SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS _i FROM ({body}) ORDER BY _i {limit}"
        spelled = "* EXCLUDE (_i)"
        if name in TIMES:  # as JSON writes them in Spark
            spelled += f" REPLACE (strftime({TIMES[name]}, '%Y-%m-%dT%H:%M:%S.%g') AS {TIMES[name]})"
        rows = f"SELECT _i, to_json(s) AS doc FROM (SELECT _i, s FROM ({numbered}) n, LATERAL (SELECT {spelled} FROM (SELECT n.*)) s)"
        parts.append(_values(f"'{name}[' || r._i || '].'", rows))
        parts.append(f"SELECT 'part_totals.{name}', 'number', NULL, CAST(count(*) AS DOUBLE) FROM ({body})")
    parts.append(f"SELECT 'data_quality.' || metric || coalesce('.' || key, ''), 'number', NULL, round(value, 6) FROM ({quality})")
    for key, rule in INTERPRETATION_RULES.items():
        parts.append(f"SELECT {_text('data_quality.interpretation_rules.' + key)}, 'string', {_text(rule)}, NULL")
    keys = ", ".join(_text(k) for k in _AVAILABLE_KEYS)
    goal_rows = _values("'business_goal.'", f"SELECT available, reason, to_json(g) AS doc FROM ({goal}) g")
    parts.append(f"""{goal_rows} WHERE CASE WHEN r.available THEN j.key IN ({keys})
  WHEN r.reason = {_text(GOAL_REASON_NO_GAP)} THEN j.key IN ('available', 'eligible_weeks', 'reason', 'current_sla_rate', 'historical_sla_benchmark')
  ELSE j.key IN ('available', 'reason') OR (j.key = 'eligible_weeks' AND j.type <> 'NULL') END""")
    return f"WITH {ctes},\nresult AS ({' UNION ALL '.join(parts)})\nSELECT path, kind, text, number FROM result"
