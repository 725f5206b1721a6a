"""What each operator promises, as tables of cases."""

import datetime as dt

import pytest

from caseflow.fixed import DEFAULT_POLICY
from caseflow.operators.dedupe import reconcile_duplicates
from caseflow.operators.goal import business_goal, goal_as_dict
from caseflow.operators.leaderboard import tier1_leaderboard
from caseflow.operators.metrics import weekly_metrics
from caseflow.operators.normalize import normalize_tickets
from caseflow.operators.opportunity import opportunities
from caseflow.operators.repeat import repeat_contacts

from .conftest import POLICY, at, enriched, frame, ticket

SLA, COST = DEFAULT_POLICY["first_response_sla_minutes"], DEFAULT_POLICY["contact_cost_inr"]


@pytest.mark.parametrize("channel", sorted(SLA))
@pytest.mark.parametrize("late", [0, 1])
def test_sla_and_costs_follow_the_channel(spark, channel, late):
    got = enriched(spark, [ticket(channel=channel, waits=(SLA[channel] + late, None))]).first()
    assert (got["first_response_minutes"], got["sla_breach"]) == (SLA[channel] + late, bool(late))
    assert got["contact_cost_inr"] == COST[channel]
    assert got["sla_penalty_exposure_inr"] == late * DEFAULT_POLICY["sla_miss_credit_inr"]
    assert got["transfer_cost_inr"] == 2 * DEFAULT_POLICY["internal_transfer_cost_inr"]


@pytest.mark.parametrize(
    ("waits", "resolution", "handling", "flags"),
    [
        ((45, 16 * 60 + 30), 16.5, 15.75, (False, False, False)),  # over midnight
        ((10, -90), None, None, (True, False, True)),
        ((-5, 60), 1.0, 65 / 60, (False, True, False)),
        ((90, 30), 0.5, None, (False, False, True)),
        ((None, 120), 2.0, None, (False, False, False)),
    ],
)
def test_durations_and_time_order(spark, waits, resolution, handling, flags):
    row = ticket(waits=waits)
    got = enriched(spark, [row]).first()
    assert got["resolution_time_hours"] == (resolution if resolution is None else pytest.approx(resolution))
    assert got["handle_time_hours"] == (handling if handling is None else pytest.approx(handling))
    assert (got["resolved_before_created"], got["first_response_before_created"], got["resolved_before_first_response"]) == flags
    assert got["temporal_anomaly"] is any(flags)
    assert got["resolved_at"] == row["resolved_at"]  # flagged, not repaired


def test_weeks_start_on_monday(spark):
    days = {"a": 0, "b": 6, "c": 7, "d": 20}
    got = weekly_metrics(enriched(spark, [ticket(k, day=d, waits=(30 if k == "b" else 1, None)) for k, d in days.items()])).collect()
    assert [(r["week_start"], r["total_contacts"], r["sla_breaches"]) for r in got] == [
        (at(0).replace(hour=0), 2, 1), (at(7).replace(hour=0), 1, 0), (at(14).replace(hour=0), 1, 0)
    ]


@pytest.mark.parametrize(
    ("copies", "winner"),
    [
        ([("legacy_fd", None), ("helpdesk", None)], "helpdesk"),
        ([("legacy_fd", 5.0), ("HelpDesk", None)], "HelpDesk"),
        ([("legacy_fd", None)], "legacy_fd"),
    ],
)
def test_one_row_per_ticket(spark, copies, winner):
    rows = [ticket("dup", source_system=s, refund_amount_inr=x) for s, x in copies]
    canonical, counters = reconcile_duplicates(normalize_tickets(frame(spark, [*rows, ticket("other")])))
    kept = {r["ticket_id"]: r["source_system"] for r in canonical.collect()}
    assert kept == {"dup": winner, "other": "helpdesk"}
    assert counters.first()["duplicate_ticket_id_groups"] == (len(copies) > 1)


def test_leaderboard_holds_eligible_tiers_only(spark):
    roster = [("ag-1", "Uma", "1"), ("ag-2", "Vik", " TIER 1"), ("ag-3", "Wen", "Tier 2"), ("ag-4", "Xia", None)]
    agents = spark.createDataFrame([(i, n, "Chat Frontline", t) for i, n, t in roster], "agent_id string, name string, team string, tier string")
    tickets = enriched(spark, [ticket(f"t{i}", agent_id=f"ag-{i}") for i in range(1, 6)])
    assert {r["name"] for r in tier1_leaderboard(tickets, agents, POLICY).collect()} == {"Uma", "Vik"}


@pytest.mark.parametrize(("gap", "again"), [(dt.timedelta(0), True), (dt.timedelta(days=7), True), (dt.timedelta(days=7, seconds=1), False)])
def test_repeat_window_is_closed(spark, gap, again):
    rows = enriched(spark, [ticket("first"), ticket("next", created_at=at(0) + gap), ticket("else", customer_id="buyer-8", created_at=at(0) + gap)])
    assert {r["ticket_id"]: r["repeat_contact_7d"] for r in repeat_contacts(rows).collect()} == {"first": False, "next": again, "else": False}


def test_a_missing_id_is_the_later_contact_of_an_instant(spark):
    got = {r["ticket_id"]: r["repeat_contact_7d"] for r in repeat_contacts(enriched(spark, [ticket(None), ticket("z-1")])).collect()}
    assert got == {"z-1": False, None: True}


def test_three_opportunities(spark):
    rows = enriched(spark, [ticket("a", waits=(16, None)), ticket("b", day=1)])
    got = {r["opportunity"]: (r["affected_volume"], r["modeled_exposure_inr"]) for r in opportunities(rows, repeat_contacts(rows), POLICY).collect()}
    assert got == {
        "SLA breaches": (2, 2 * DEFAULT_POLICY["sla_miss_credit_inr"]),
        "Internal transfers": (4, 4 * DEFAULT_POLICY["internal_transfer_cost_inr"]),
        "Repeat-contact proxy (7 days)": (1, DEFAULT_POLICY["blended_cost_inr"]),
    }


def test_goal_on_five_weeks(spark):
    late = [2, 3, 4, 9, 10]  # of 20 tickets a week
    weekly = spark.createDataFrame([(at(7 * w).replace(hour=0), 20, n, n / 20) for w, n in enumerate(late)], "week_start timestamp_ntz, total_contacts long, sla_breaches long, sla_breach_rate double")
    goal = goal_as_dict(business_goal(weekly, None, POLICY))
    # the last week against the lower quartile of the four before: 0.10 and 0.15 at most 0.1375
    assert goal["eligible_weeks"] == 5 and goal["current_rate"] == 0.5 and goal["target_rate"] == pytest.approx(0.1)
    assert goal["quarterly_value_inr"] == pytest.approx((10 - 2) * 13 * DEFAULT_POLICY["sla_miss_credit_inr"])
