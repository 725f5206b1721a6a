"""Session and a small ticket builder."""

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from caseflow.fixed import DEFAULT_POLICY, TICKET_COLUMNS  # noqa: E402
from caseflow.operators.enrich import apply_policy_metrics  # noqa: E402
from caseflow.operators.normalize import normalize_tickets  # noqa: E402

POLICY = DEFAULT_POLICY
SF_SMALL = "/root/testdata/sf0.001"
TICKET_DDL = ", ".join(f"{name} {kind}" for name, kind in TICKET_COLUMNS)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("caseflow-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    yield session


def ts(text):
    return dt.datetime.fromisoformat(text)


def at(day, minutes=0):
    """An instant: minutes after 08:00 of a day counted from Monday, 3 June 2030."""
    return dt.datetime(2030, 6, 3, 8) + dt.timedelta(days=day, minutes=minutes)


def ticket(ticket_id="K-100", day=0, waits=(20, 200), **fields):
    """A closed chat ticket; ``waits``: minutes to the first response and to the resolution.

    ``fields`` replaces any column; what is not named here is null.
    """
    created = fields.pop("created_at", at(day))
    row = {"ticket_id": ticket_id, "created_at": created, "status": "closed", "channel": "chat", "source_system": "helpdesk"}
    row |= {"customer_id": "buyer-7", "agent_id": "ag-3", "assigned_team": "Chat Frontline", "transfers": 2.0, "csat_score": 3.0}
    for name, wait in zip(("first_response_at", "resolved_at"), waits, strict=True):
        row[name] = created + dt.timedelta(minutes=wait) if created is not None and wait is not None else None
    return row | fields


def frame(spark, rows):
    return spark.createDataFrame([tuple(r.get(name) for name, _ in TICKET_COLUMNS) for r in rows], TICKET_DDL)


def enriched(spark, rows, policy=POLICY):
    return apply_policy_metrics(normalize_tickets(frame(spark, rows)), policy)
