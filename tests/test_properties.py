"""Property checks with hypothesis (few examples: each one runs Spark jobs)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caseflow.operators.dedupe import reconcile_duplicates
from caseflow.operators.enrich import apply_policy_metrics
from caseflow.operators.metrics import channel_metrics
from caseflow.operators.normalize import normalize_tickets
from caseflow.sources.tables import INGEST_COL

from .conftest import POLICY, ticket, frame

START = dt.datetime(2025, 1, 1)

ticket_rows = st.lists(
    st.fixed_dictionaries(
        {
            "ticket_id": st.one_of(st.none(), st.sampled_from(["A", "B", "C", "D"])),
            "source_system": st.one_of(st.none(), st.sampled_from(["helpdesk", "legacy_fd", "HelpDesk"])),
            "csat_score": st.one_of(st.none(), st.sampled_from([0.0, 3.0, 5.0])),
            "channel": st.sampled_from(["chat", "Email", "email", "fax"]),
            "minutes": st.integers(min_value=0, max_value=20000),
        }
    ),
    min_size=1,
    max_size=25,
)

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, rows, partitions):
    data = [
        ticket(
            ticket_id=r["ticket_id"], source_system=r["source_system"], csat_score=r["csat_score"],
            channel=r["channel"], created_at=START + dt.timedelta(minutes=r["minutes"]),
        )
        for r in rows
    ]
    df = frame(spark, data).withColumn(INGEST_COL, F.monotonically_increasing_id())
    return normalize_tickets(df.repartition(partitions))


@SETTINGS
@given(rows=ticket_rows)
def test_one_row_per_id_and_partitioning_does_not_matter(spark, rows):
    a, ca = reconcile_duplicates(_frame(spark, rows, 1))
    b, cb = reconcile_duplicates(_frame(spark, rows, 3))
    ids = [r["ticket_id"] for r in a.collect()]
    assert len(ids) == len(set(ids)) == len({r["ticket_id"] for r in rows})
    key = lambda r: (r["ticket_id"] or "", r["source_system"] or "", r["csat_score"] or -1)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))
    assert ca.first() == cb.first()
    pref = {r["ticket_id"] for r in rows if (r["source_system"] or "").lower() == "helpdesk"}
    for r in a.collect():
        if r["ticket_id"] in pref:
            assert r["source_system"].lower() == "helpdesk"


@SETTINGS
@given(rows=ticket_rows)
def test_channel_tickets_sum_to_distinct_ids(spark, rows):
    canonical, _ = reconcile_duplicates(_frame(spark, rows, 2))
    tickets = apply_policy_metrics(canonical, POLICY)
    general = channel_metrics(tickets, POLICY).agg(F.sum("tickets")).first()[0]
    fast = channel_metrics(tickets, POLICY, ids_unique=True).agg(F.sum("tickets")).first()[0]
    assert general == fast == len({r["ticket_id"] for r in rows if r["ticket_id"] is not None})
