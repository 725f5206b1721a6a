"""Group metrics, leaderboard, repeat contacts, goal paths."""

import datetime as dt
import random

from caseflow.operators.goal import business_goal, goal_as_dict
from caseflow.operators.leaderboard import tier1_leaderboard
from caseflow.operators.metrics import channel_metrics, weekly_metrics
from caseflow.operators.repeat import repeat_contacts

from .conftest import POLICY, ticket, enriched, ts


def test_channel_metrics_keep_case_and_null_group(spark):
    df = enriched(spark, [ticket(ticket_id="1", channel="Email"), ticket(ticket_id="2", channel="email"),
                          ticket(ticket_id="3", channel=None, transfers=None)])
    got = {r["channel"]: r for r in channel_metrics(df, POLICY).collect()}
    assert set(got) == {"Email", "email", None}
    assert got[None]["transfer_events"] == 0 and got["Email"]["transfer_cost_inr"] == 610


def test_leaderboard_null_agent_matches_null_roster_row_and_first_roster_row_wins(spark):
    df = enriched(spark, [ticket(ticket_id="T1", agent_id=None), ticket(ticket_id="T2", agent_id="A1"),
                          ticket(ticket_id="T3", agent_id="A9")])
    agents = spark.createDataFrame(
        [(None, "Shared", "Chat Frontline", "1"), ("A1", "First", "Email Frontline", "Tier 1"),
         ("A1", "Second", "Warranty", "Tier 2")],
        "id string, agent_name string, assigned_team string, agent_tier string",
    )
    rows = {r["agent_id"]: r for r in tier1_leaderboard(df, agents, POLICY).collect()}
    assert set(rows) == {None, "A1"}
    assert rows[None]["name"] == "Shared" and rows[None]["effective_team"] == "Chat Frontline"
    assert rows["A1"]["name"] == "First" and rows["A1"]["tickets_closed"] == 1


def test_leaderboard_median_is_exact(spark):
    base = ts("2025-01-06 09:00")
    rows = [ticket(ticket_id=f"T{i}", agent_id="A1", created_at=base, first_response_at=base,
                        resolved_at=base + dt.timedelta(hours=h)) for i, h in enumerate([1, 2, 10, 20])]
    agents = spark.createDataFrame([("A1", "One", "Email Frontline", "Tier 1")], "agent_id string, name string, team string, tier string")
    r = tier1_leaderboard(enriched(spark, rows), agents, POLICY).first()
    assert r["median_handle_time_hours"] == 6.0 and r["tickets_closed"] == 4


def _brute_force_repeat(rows):
    by_c = {}
    for r in rows:
        if r["customer_id"] is None or r["created_at"] is None:
            continue
        by_c.setdefault(r["customer_id"], []).append(r)
    out = {}
    for lst in by_c.values():
        lst.sort(key=lambda r: (r["created_at"], r["ticket_id"]))
        prev = None
        for r in lst:
            out[r["ticket_id"]] = prev
            prev = r["created_at"]
    return out


def test_repeat_contacts_match_brute_force_across_buckets_and_ties(spark):
    rnd = random.Random(7)
    start = ts("2025-01-01 00:00")
    rows = []
    for i in range(400):
        c = "HOT" if i % 3 == 0 else f"C{rnd.randint(0, 20)}"
        minutes = rnd.choice([0, 59, 60, 61, 3600, rnd.randint(0, 60 * 24 * 60)])
        rows.append(ticket(ticket_id=f"T{i:04d}", customer_id=c if i % 50 else None,
                                created_at=start + dt.timedelta(minutes=minutes)))
    expected = _brute_force_repeat(rows)
    got = {r["ticket_id"]: r for r in repeat_contacts(enriched(spark, rows), bucket_seconds=3600).collect()}
    assert set(got) == set(expected)
    for tid, prior in expected.items():
        assert got[tid]["prior_contact_at"] == prior, tid
        if prior is not None:
            days = (got[tid]["created_at"] - prior).total_seconds() / 86400
            assert got[tid]["repeat_contact_7d"] == (0 <= days <= 7)


def _weekly_from_rates(spark, rates, per_week=40):
    rows = []
    for week, rate in enumerate(rates):
        created = ts("2025-01-06") + dt.timedelta(days=7 * week)
        for i in range(per_week):
            late = i >= int(per_week * (1 - rate))
            rows.append(ticket(ticket_id=f"T{week}_{i}", channel="chat", created_at=created,
                                    first_response_at=created + dt.timedelta(minutes=30 if late else 5)))
    return weekly_metrics(enriched(spark, rows))


def test_goal_paths(spark):
    few = goal_as_dict(business_goal(_weekly_from_rates(spark, [0.1, 0.2, 0.3]), None, POLICY))
    assert few == {"available": False, "eligible_weeks": 3,
                   "reason": "Not enough historical weeks to establish a defensible benchmark."}
    four = goal_as_dict(business_goal(_weekly_from_rates(spark, [0.1, 0.2, 0.3, 0.4]), None, POLICY))
    assert four["available"] is False and "remain after" in four["reason"]
    flat = goal_as_dict(business_goal(_weekly_from_rates(spark, [0.2] * 6), None, POLICY))
    assert flat["available"] is False and flat["current_sla_rate"] == 0.2 and flat["historical_sla_benchmark"] == 0.2
    assert flat["observed_opportunities"] == {"transfers": None, "repeat_contacts": None}
    rates = [0.1, 0.1, 0.2, 0.2, 0.3, 0.3, 0.2, 0.2, 0.4, 0.4, 0.4, 0.4]
    long = goal_as_dict(business_goal(_weekly_from_rates(spark, rates), None, POLICY))
    assert long["available"] is True and long["eligible_weeks"] == 12 and long["baseline_period"] == "Most recent 8 weeks"
    # recent 8 weeks: rates .3 .3 .2 .2 .4 .4 .4 .4 -> 0.325; history .1 .1 .2 .2 -> q25 0.1, target 0.1
    assert abs(long["current_rate"] - 0.325) < 1e-12 and abs(long["target_rate"] - 0.1) < 1e-12
    expected_value = (0.325 * 40 - 40 * 0.1) * 13 * 350
    assert abs(long["quarterly_value_inr"] - expected_value) < 1e-6
    assert long["quarterly_value_inr"] == long["modeled_quarterly_exposure_reduction_inr"]
