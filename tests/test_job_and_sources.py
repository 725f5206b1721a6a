"""CSV source (S1-S3), sinks (S5, S6) and the batch job (S7) end to end."""

import json
import os
import tempfile

import pytest

from caseflow.fixed import DEFAULT_POLICY
from caseflow.plans import cache, job
from caseflow.plans.job import run
from caseflow.sources import files, publish
from caseflow.sources.tables import read_table, read_tickets

TICKETS_CSV = '''ticket_id,created_at,first_response_at,resolved_at,status,channel,customer_id,agent_id,transfers,csat_score,customer_message,source_system,assigned_team
T1,2025-01-06 10:00,2025-01-06 10:05,2025-01-06 12:00,resolved,chat,C1,A1,1,5,"Battery drains fast,
needs ""urgent"" help",helpdesk,Chat Frontline
T1,2025-01-06 10:00,,2025-01-06 09:00,resolved,chat,C1,,1,NA,"Battery drains fast",legacy_fd,Chat Frontline
T2,2025-01-07 10:00,2025-01-07 11:00,,open,Email,C1,A2,0,0,"Where is my order parcel",helpdesk,Email Frontline
T3,not a date,2025-01-07 11:00,2025-01-07 12:00,closed,voice,C2,A1,"1,000",3,"Refund not received yet",helpdesk,Voice Frontline
'''
AGENTS_CSV = """id,agent_name,team,tier
A1,Asha,Chat Frontline,1
A2,Ben,Email Frontline,Tier 2
"""


@pytest.fixture()
def data_dir():
    d = tempfile.mkdtemp(prefix="run-")
    with open(os.path.join(d, "tickets.csv"), "w", encoding="utf-8") as f:
        f.write(TICKETS_CSV)
    with open(os.path.join(d, "agents.csv"), "w", encoding="utf-8") as f:
        f.write(AGENTS_CSV)
    return d


def test_csv_source_reads_multiline_quotes_and_na_tokens(spark, data_dir):
    assert read_table(spark, data_dir, "customers") is None and read_table(spark, data_dir, "agents") is not None
    rows = read_tickets(spark, data_dir).collect()
    assert len(rows) == 4
    msgs = {r["customer_message"] for r in rows}
    assert 'Battery drains fast,\nneeds "urgent" help' in msgs
    assert any(r["csat_score"] is None for r in rows)  # NA token


def test_missing_or_empty_tickets_raise(spark):
    for header in (None, "ticket_id,created_at\n"):
        folder = tempfile.mkdtemp(prefix="run-")
        if header:
            with open(os.path.join(folder, "tickets.csv"), "w", encoding="utf-8") as f:
                f.write(header)
        with pytest.raises(FileNotFoundError):
            read_tickets(spark, folder)


def test_a_folder_of_csv_files_is_one_table(spark, data_dir):
    folder = tempfile.mkdtemp(prefix="run-")
    os.mkdir(os.path.join(folder, "tickets.csv"))
    for i in range(3):
        with open(os.path.join(folder, "tickets.csv", f"{i}.csv"), "w", encoding="utf-8") as f:
            f.write(f"ticket_id,channel\nT{i},chat\n")
    assert {r["ticket_id"] for r in read_tickets(spark, folder).collect()} == {"T0", "T1", "T2"}


def test_job_writes_tables_and_reports(spark, data_dir):
    out = tempfile.mkdtemp(prefix="run-")
    policy = os.path.join(out, "policy.json")
    with open(policy, "w", encoding="utf-8") as f:
        json.dump(DEFAULT_POLICY, f)
    summary = run(spark, data_dir, f"file:{policy}", f"file:{out}", "csv")
    for name in ["weekly_metrics", "complaint_themes", "tier1_leaderboard", "business_opportunities",
                 "channel_metrics", "category_metrics", "repeat_contacts_proxy"]:
        assert os.path.isdir(os.path.join(out, name)), name
    q = json.load(open(os.path.join(out, "data_quality.json"), encoding="utf-8"))
    assert q["raw_rows"] == 4 and q["canonical_rows"] == 3 and q["duplicate_pairs_helpdesk_legacy"] == 1
    assert q["invalid_created_at"] == 1 and q["resolved_before_created"] == 1
    assert q["timestamp_parsing"]["created_at"] == {"values": 4, "unparsed": 1}
    assert sorted(os.listdir(os.path.join(out, "repeat_contacts_proxy")))[-1] == "week_start=2025-01-06"
    assert summary["business_goal"]["available"] is False
    weekly = spark.read.option("header", True).csv(os.path.join(out, "weekly_metrics")).collect()
    assert len(weekly) == 1 and weekly[0]["total_contacts"] == "2"
    lb = spark.read.option("header", True).csv(os.path.join(out, "tier1_leaderboard")).collect()
    assert [r["agent_id"] for r in lb] == ["A1"]


def test_outputs_appear_together_or_not_at_all(spark, data_dir, monkeypatch):
    out = "file:" + tempfile.mkdtemp(prefix="run-")
    names = ["weekly_metrics", "channel_metrics", "repeat_contacts_proxy"]
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, out, names)
    run(spark, data_dir, None, out, versioned=True)
    before = publish.current_version(spark, out)
    tables = publish.read_published(spark, out, names)
    with open(os.path.join(data_dir, "tickets.csv"), "a", encoding="utf-8") as f:
        f.write("T9,2025-01-08 10:00,2025-01-08 10:05,2025-01-08 12:00,resolved,chat,C1,A1,1,5,Screen cracked again today,helpdesk,Chat Frontline\n")
    wrote = []

    def dies(df, path, *rest):
        wrote.append(path)
        if len(wrote) == 4:
            raise RuntimeError("killed between two sinks")
        return write_table(df, path, *rest)

    write_table = job.write_table
    monkeypatch.setattr(job, "write_table", dies)
    with pytest.raises(RuntimeError):
        run(spark, data_dir, None, out, versioned=True)
    assert len(wrote) == 4 and publish.current_version(spark, out) == before
    assert tables["weekly_metrics"].first()["total_contacts"] == 2
    monkeypatch.setattr(job, "write_table", write_table)
    run(spark, data_dir, None, out, versioned=True)
    after = publish.read_published(spark, out, names)
    assert publish.current_version(spark, out) != before and after["weekly_metrics"].first()["total_contacts"] == 3
    assert json.loads(files.read_text(spark, f"{publish.current_version(spark, out)}/data_quality.json"))["canonical_rows"] == 4
    assert tables["weekly_metrics"].first()["total_contacts"] == 2  # a reader keeps the version that it opened


def test_old_versions_go(spark):
    root = "file:" + tempfile.mkdtemp(prefix="run-")
    made = []
    for _ in range(4):
        p = publish.Publication(spark, root)
        spark.range(3).write.parquet(f"{p.path}/t")
        p.commit(keep=1)
        made.append(p.version)
    assert files.folders(spark, f"{root}/versions") == made[-2:]
    assert publish.current_version(spark, root).endswith(made[-1])


def test_results_are_kept_across_sessions(spark, data_dir, monkeypatch):
    kept = cache.ResultCache(spark, "file:" + tempfile.mkdtemp(prefix="run-"), keep=1)
    source = f"file:{data_dir}"
    first = cache.cached_outputs(spark, source, cache=kept)
    want = {n: sorted(map(str, df.collect())) for n, df in first.items()}
    assert len(want["tickets"]) == 3

    def must_not_run(*args, **kwargs):
        raise AssertionError("the input is read again")

    with monkeypatch.context() as m:
        m.setattr(cache, "run_pipeline", must_not_run)
        again = cache.cached_outputs(spark, source, cache=cache.ResultCache(spark, kept.root, keep=1))
        assert {n: sorted(map(str, df.collect())) for n, df in again.items()} == want
        with pytest.raises(AssertionError):
            cache.cached_outputs(spark, source, {"contact_cost_inr": {"chat": 1}}, cache=kept)
    with open(os.path.join(data_dir, "tickets.csv"), "a", encoding="utf-8") as f:
        f.write("T9,2025-01-08 10:00,,,open,chat,C1,A1,1,5,Screen cracked again today,helpdesk,Chat Frontline\n")
    changed = cache.cached_outputs(spark, source, cache=kept)
    assert changed["tickets"].count() == 4
    sets = [f for f in files.folders(spark, kept.root) if files.exists(spark, f"{kept.root}/{f}/manifest.json")]
    assert len(sets) == 1  # the set of the old files was evicted


def test_day_first_columns_are_read_as_such(spark):
    from caseflow.operators.normalize import date_orders, normalize_tickets

    rows = [("T1", "01/02/2025 10:00", "01/02/2025", "3/4/2025"), ("T2", "13/02/2025 10:00", "02/25/2025", "5/6/2025"), ("T3", "2025-02-01 10:00", None, " ")]
    df = spark.createDataFrame(rows, "ticket_id string, created_at string, first_response_at string, resolved_at string")
    got = {r["ticket_id"]: (str(r["created_at"]), str(r["first_response_at"]), str(r["resolved_at"])) for r in normalize_tickets(df).collect()}
    assert got["T1"] == ("2025-02-01 10:00:00", "2025-01-02 00:00:00", "2025-03-04 00:00:00")
    assert got["T2"] == ("2025-02-13 10:00:00", "2025-02-25 00:00:00", "2025-05-06 00:00:00")
    assert got["T3"] == ("2025-02-01 10:00:00", "None", "None")
    orders = {r["column"]: (r["slashed"], r["day_first"], r["month_first"], r["date_order"]) for r in date_orders(df).collect()}
    assert orders == {"created_at": (2, 1, 0, "day first"), "first_response_at": (2, 0, 1, "month first"), "resolved_at": (2, 0, 0, "ambiguous")}
    assert date_orders(df.select("ticket_id")).count() == 0
    forced = normalize_tickets(df, ["M/d/yyyy[ H:mm]"]).where("ticket_id = 'T1'").first()
    assert str(forced["created_at"]) == "2025-01-02 10:00:00"
