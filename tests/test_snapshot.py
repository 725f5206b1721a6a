"""Evidence pack (S9): one document, bounded parts, nulls kept."""

import json

from caseflow.plans.pipeline import from_driver_tables
from caseflow.plans.snapshot import evidence_pack

from .conftest import SF_SMALL


def pack(spark, **limits):
    r = from_driver_tables(spark, SF_SMALL)
    row = evidence_pack(r.quality, r.business_goal, r.weekly_metrics, r.opportunities, r.channel_metrics,
                        r.category_metrics, None, r.leaderboard, r.tickets, limits).first()
    return json.loads(row["evidence"])


def test_evidence_is_one_bounded_document(spark):
    doc = pack(spark, ticket_sample=5, leaderboard=None)
    q = doc["data_quality"]
    assert q["raw_rows"] == 1637 and q["canonical_rows"] == 1500
    assert q["canonical_temporal_anomalies_by_source"] == {"helpdesk": 38, "legacy_fd": 58}
    assert set(q["interpretation_rules"]) == {"invalid_created_at", "missing_resolved_at", "canonical_temporal_anomalies"}
    assert doc["business_goal"]["available"] is True and doc["business_goal"]["eligible_weeks"] == 343
    weekly = doc["weekly_metrics"]
    assert len(weekly) == 100 and doc["part_totals"]["weekly_metrics"] == 343
    assert weekly[0]["week_start"] < weekly[-1]["week_start"] and weekly[0]["week_over_week_contacts"] is None
    assert any(r["category"] is None for r in doc["category_metrics"])  # the group without a category stays
    assert len(doc["opportunities"]) == 3
    lb = doc["tier1_leaderboard_latest_weeks"]
    assert len(lb) == 41 and lb[0]["resolution_week_start"] >= lb[-1]["resolution_week_start"]
    sample = [t["ticket_id"] for t in doc["ticket_sample"]]
    assert sample == sorted(sample) and len(sample) == 5 and doc["part_totals"]["ticket_sample"] == 1500
