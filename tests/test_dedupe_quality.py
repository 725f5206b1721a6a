"""A1-A8 edge cases: NULL ids, completeness tie-break, report contents."""

from caseflow.operators.dedupe import reconcile_duplicates
from caseflow.operators.enrich import apply_policy_metrics
from caseflow.operators.normalize import normalize_tickets
from caseflow.operators.quality import quality_as_dict, quality_report

from .conftest import POLICY, ticket, frame, ts


def test_null_ids_collapse_but_are_not_duplicates(spark):
    raw = normalize_tickets(frame(spark, [
        ticket(ticket_id=None, source_system="legacy_fd"),
        ticket(ticket_id=None, source_system="helpdesk"),
        ticket(ticket_id="A", source_system="helpdesk"),
    ]))
    canonical, counters = reconcile_duplicates(raw)
    rows = canonical.collect()
    assert len(rows) == 2
    assert [r["source_system"] for r in rows if r["ticket_id"] is None] == ["helpdesk"]
    c = counters.first().asDict()
    assert c == {"raw_rows": 3, "canonical_rows": 2, "unique_ticket_ids": 1, "duplicate_ticket_rows": 0,
                 "duplicate_ticket_id_groups": 0, "duplicate_pairs_helpdesk_legacy": 0}


def test_more_complete_row_wins_within_same_source(spark):
    raw = normalize_tickets(frame(spark, [
        ticket(ticket_id="X", csat_score=None, order_id=None),
        ticket(ticket_id="X", csat_score=5.0),
        ticket(ticket_id="X", source_system="legacy_fd"),
    ]))
    canonical, counters = reconcile_duplicates(raw)
    r = canonical.first()
    assert r["csat_score"] == 5.0 and r["source_system"] == "helpdesk"
    c = counters.first()
    assert c["duplicate_ticket_rows"] == 3 and c["duplicate_pairs_helpdesk_legacy"] == 1


def test_quality_report_values(spark):
    raw = normalize_tickets(frame(spark, [
        ticket(ticket_id="A", resolved_at=ts("2024-12-31 20:00")),
        ticket(ticket_id="A", source_system="legacy_fd", resolved_at=ts("2024-12-31 20:00")),
        ticket(ticket_id="B", source_system=None, agent_id=None, resolved_at=None),
        ticket(ticket_id="C", created_at=None, resolved_at=ts("2030-06-04 09:00")),
    ]))
    canonical, counters = reconcile_duplicates(raw)
    tickets = apply_policy_metrics(canonical, POLICY)
    q = quality_as_dict(quality_report(raw, tickets, counters).collect())
    assert q["raw_rows"] == 4 and q["canonical_rows"] == 3
    assert q["missing_resolved_at"] == 1 and q["missing_agent_id"] == 1 and q["invalid_created_at"] == 1
    assert q["source_system_counts"] == {"helpdesk": 2, "<NA>": 1}
    assert q["resolved_before_created"] == 2
    assert q["resolved_before_created_by_source"] == {"helpdesk": 1, "legacy_fd": 1}
    assert q["canonical_temporal_anomalies"] == 1
    assert q["canonical_temporal_anomaly_rate"] == 33.33
    assert q["canonical_temporal_anomalies_by_source"] == {"helpdesk": 1}
