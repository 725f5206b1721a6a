"""P1-P6 on all-string (CSV-shaped) input."""

from pyspark.sql import functions as F

from caseflow.operators.enrich import apply_policy_metrics
from caseflow.operators.normalize import normalize_tickets

from .conftest import POLICY


def _strings(spark, rows, cols):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))


def test_schema_completion_keeps_extras_and_adds_missing(spark):
    df = normalize_tickets(_strings(spark, [("T1", "x")], ["ticket_id", "extra_col"]))
    assert df.columns[:21][0] == "ticket_id" and "extra_col" in df.columns and len(df.columns) == 22
    r = df.first()
    assert r["created_at"] is None and r["customer_message"] == "" and r["agent_notes"] == ""


def test_numeric_coercion_matches_pandas_rules(spark):
    vals = ["1,000", "₹5", "", "1e3", " 2 ", "1d", "abc", "0", "inf"]
    df = normalize_tickets(_strings(spark, [(f"T{i}", v, v) for i, v in enumerate(vals)], ["ticket_id", "transfers", "csat_score"]))
    got = {r["ticket_id"]: (r["transfers"], r["csat_score"]) for r in df.collect()}
    assert got["T0"] == (None, None)  # thousands separator
    assert got["T1"] == (None, None)  # currency symbol
    assert got["T2"] == (None, None)  # empty
    assert got["T3"] == (1000.0, 1000.0)
    assert got["T4"] == (2.0, 2.0)
    assert got["T5"] == (None, None)  # Java suffix is not a number here
    assert got["T6"] == (None, None)
    assert got["T7"] == (0.0, None)  # csat 0 means "not given"
    assert got["T8"][0] == float("inf")


def test_timestamp_coercion(spark):
    vals = ["2025-01-02 10:00", "2025-01-02 10:00:05", "2025-01-02T10:00:00", "10:00", "not a date", "2025-01-02"]
    df = normalize_tickets(_strings(spark, [(f"T{i}", v) for i, v in enumerate(vals)], ["ticket_id", "created_at"]))
    got = {r["ticket_id"]: r["created_at"] for r in df.collect()}
    assert str(got["T0"]) == "2025-01-02 10:00:00"
    assert str(got["T1"]) == "2025-01-02 10:00:05"
    assert str(got["T2"]) == "2025-01-02 10:00:00"
    assert got["T3"] is None and got["T4"] is None
    assert str(got["T5"]) == "2025-01-02 00:00:00"
    assert dict(df.dtypes)["created_at"] == "timestamp_ntz"


def test_strip_and_text_clean_use_unicode_whitespace(spark):
    nbsp, fs = " ", "\u001c"
    df = normalize_tickets(
        _strings(
            spark,
            [(f"{nbsp} T1 {fs}", f"  a{nbsp}{nbsp}b \n\t c{fs} ", ""), ("T2", None, "  ")],
            ["ticket_id", "customer_message", "channel"],
        )
    )
    got = {r["ticket_id"]: r for r in df.collect()}
    assert set(got) == {"T1", "T2"}
    assert got["T1"]["customer_message"] == "a b c"
    assert got["T1"]["channel"] == ""  # '' stays '' (not NULL)
    assert got["T2"]["customer_message"] == ""
    assert got["T2"]["channel"] == ""


def test_channel_key_case_and_unknown_channel(spark):
    df = _strings(spark, [("T1", "Email", "2025-01-01 10:00", "2025-01-01 19:00"), ("T2", "fax", "2025-01-01 10:00", "2025-01-01 10:30")],
                  ["ticket_id", "channel", "created_at", "first_response_at"])
    e = {r["ticket_id"]: r for r in apply_policy_metrics(normalize_tickets(df), POLICY).collect()}
    assert e["T1"]["channel_key"] == "email" and e["T1"]["sla_breach"] is True and e["T1"]["contact_cost_inr"] == 260
    assert e["T2"]["sla_target_minutes"] is None and e["T2"]["sla_breach"] is False and e["T2"]["contact_cost_inr"] == 290


def test_policy_without_optional_keys(spark):
    df = normalize_tickets(_strings(spark, [("T1", "chat", "2025-01-01 10:00", "2025-01-01 11:00", "2")],
                                    ["ticket_id", "channel", "created_at", "first_response_at", "transfers"]))
    r = apply_policy_metrics(df, {}).first()
    assert r["sla_breach"] is False and r["contact_cost_inr"] == 0 and r["transfer_cost_inr"] == 0
    assert r["first_response_minutes"] == 60


def test_negative_first_response_is_kept(spark):
    df = normalize_tickets(_strings(spark, [("T1", "2025-01-01 10:00", "2025-01-01 09:00", "2025-01-01 08:00")],
                                    ["ticket_id", "created_at", "first_response_at", "resolved_at"]))
    r = apply_policy_metrics(df, POLICY).select("first_response_minutes", "handle_time_hours", "temporal_anomaly",
                                               F.col("week_start").cast("string").alias("w")).first()
    assert r["first_response_minutes"] == -60 and r["handle_time_hours"] is None and r["temporal_anomaly"] is True
    assert r["w"] == "2024-12-30 00:00:00"
