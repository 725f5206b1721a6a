"""The query catalogue: one named Spark query per operator group.

Every query reads the driver tables under ``sf_dir`` and rebuilds what it
needs lazily; doubles are rounded to 6 places so results compare exactly with
the SQL oracle (:mod:`caseflow.plans.oracle`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.fixed import ENRICHMENT_COLUMNS, EVIDENCE_TICKET_COLUMNS, TICKET_COLUMNS
from caseflow.functions.columns import clean_text
from caseflow.operators import themes as th
from caseflow.operators.goal import baseline_split, business_goal
from caseflow.operators.metrics import GROUP_INPUTS, all_groups
from caseflow.operators.normalize import date_orders, normalize_tickets, unparsed_timestamps
from caseflow.operators.position import with_position
from caseflow.operators.quality import canonical_by_source, raw_by_source
from caseflow.operators.repeat import in_reading_order
from caseflow.plans import snapshot
from caseflow.plans.pipeline import PipelineResult, from_driver_tables, from_edge_tables
from caseflow.session import stage
from caseflow.sources import fixtures

ENRICHED_COLUMNS = [name for name, _ in TICKET_COLUMNS] + ENRICHMENT_COLUMNS


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name), places).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


#: Columns of the canonical tickets that queries with several branches stage.
REPEAT = ["ticket_id", "customer_id", "created_at", "category", "order_id"]
OPPORTUNITY = [*REPEAT, "sla_breach", "sla_penalty_exposure_inr", "transfers"]
WEEKLY = ["week_start", "csat_score", "contact_cost_inr", "transfer_cost_inr"]
BOARD = ["resolution_week_start", "agent_id", "assigned_team", "completed_ticket", "handle_time_hours"]


def _on(getter: Callable[[PipelineResult], DataFrame], columns: list[str] | None = None, source=from_driver_tables) -> Callable[[SparkSession, str], DataFrame]:
    """``columns``: the query reads the canonical tickets from several branches, so
    these columns of them are staged once instead of being derived per branch."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        reuse = (lambda t: stage(t.select(*dict.fromkeys(columns)))) if columns else None
        return round_doubles(getter(source(spark, sf_dir, reuse=reuse)))

    return run


def _edge(getter: Callable[[PipelineResult], DataFrame], columns: list[str] | None = None) -> Callable[[SparkSession, str], DataFrame]:
    return _on(getter, columns, from_edge_tables)


def _ticket_normalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_tickets(fixtures.spelled_tickets(spark, sf_dir)).select("ticket_id", "created_at")


def _timestamp_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unparsed_timestamps(fixtures.spelled_tickets(spark, sf_dir))


def _date_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return date_orders(fixtures.ordered_date_tickets(spark, sf_dir))


def _date_order_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_tickets(fixtures.ordered_date_tickets(spark, sf_dir)).select("ticket_id", "created_at", "first_response_at", "resolved_at")


def document_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX4 tickets with the P6 text clean applied."""
    d = fixtures.document_tickets(spark, sf_dir)
    return d.withColumns({"customer_message": clean_text("customer_message"), "agent_notes": clean_text("agent_notes")})


def _source_value_counts(r: PipelineResult) -> DataFrame:
    c = canonical_by_source(r.tickets).select("source", F.col("n").alias("canonical_rows"), F.col("c_anom").alias("canonical_temporal_anomalies"))
    rw = raw_by_source(r.raw).select("source", F.col("r_rbc").alias("raw_resolved_before_created"))
    j = c.join(rw, "source", "full")
    return j.select(
        "source",
        F.coalesce("canonical_rows", F.lit(0)).cast("long").alias("canonical_rows"),
        F.coalesce("raw_resolved_before_created", F.lit(0)).cast("long").alias("raw_resolved_before_created"),
        F.coalesce("canonical_temporal_anomalies", F.lit(0)).cast("long").alias("canonical_temporal_anomalies"),
    )


def _text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = th.theme_text(document_tickets(spark, sf_dir))
    return t.select("ticket_id", "theme_text", F.length("theme_text").cast("long").alias("text_length"), "usable")


def _theme_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(th.theme_vocabulary(document_tickets(spark, sf_dir)))


def _complaint_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(th.complaint_themes(document_tickets(spark, sf_dir)))


def _theme_watchlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(snapshot.theme_watchlist(th.complaint_themes(document_tickets(spark, sf_dir))))


def _theme_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(th.theme_tfidf(document_tickets(spark, sf_dir)))


def _theme_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(th.theme_summary(document_tickets(spark, sf_dir), "category").select(
        "theme_id", "category", "ticket_count", "avg_csat", "sla_breach_rate", "transfer_rate", "sample_ticket_ids", "theme_label", "top_terms"
    ))


def _evidence(spark: SparkSession, sf_dir: str, themes: DataFrame | None) -> DataFrame:
    columns = [*OPPORTUNITY, *WEEKLY, *BOARD, *GROUP_INPUTS, *EVIDENCE_TICKET_COLUMNS]
    r = from_driver_tables(spark, sf_dir, reuse=lambda t: stage(t.select(*dict.fromkeys(columns))))
    r.groups = stage(all_groups(r.tickets))
    # the small tables that several parts read
    weekly, opportunity = stage(r.weekly_metrics), stage(r.opportunities)
    return snapshot.evidence_pack(
        r.quality, business_goal(weekly, opportunity, r.policy), weekly, opportunity, r.channel_metrics, r.category_metrics, themes, stage(r.leaderboard), r.tickets,
    )


def _evidence_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _evidence(spark, sf_dir, th.complaint_themes(document_tickets(spark, sf_dir)))


def _evidence_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot.evidence_parts(_evidence(spark, sf_dir, None))


def _evidence_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(snapshot.evidence_values(_evidence(spark, sf_dir, None)))


def _order_themes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_position(th.complaint_themes(document_tickets(spark, sf_dir)).select("theme_id", "ticket_count"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    board = [*BOARD, "ticket_id", "sla_breach", "csat_score"]
    return {
        "ticket_enrichment": _on(lambda r: r.tickets.select(*ENRICHED_COLUMNS)),
        "canonical_tickets": _on(lambda r: r.tickets.select(*ENRICHED_COLUMNS[:21])),
        "duplicate_counters": _on(lambda r: r.counters),
        "quality_report_long": _on(lambda r: r.quality),
        "source_value_counts": _on(_source_value_counts),
        "weekly_metrics": _on(lambda r: r.weekly_metrics),
        "channel_metrics": _on(lambda r: r.channel_metrics),
        "category_metrics": _on(lambda r: r.category_metrics),
        "repeat_contacts": _on(lambda r: r.repeat_contacts, REPEAT),
        "opportunities": _on(lambda r: r.opportunities, OPPORTUNITY),
        "tier1_leaderboard": _on(lambda r: r.leaderboard, board),
        "goal_baseline_split": _on(
            lambda r: baseline_split(r.weekly_metrics).select(
                "week_start", "total_contacts", "sla_breaches", "n_weeks", "period", "eligible", "weekly_rate"
            )
        ),
        "business_goal": _on(lambda r: r.business_goal, [*OPPORTUNITY, *WEEKLY]),
        "top_breach_channel": _on(lambda r: snapshot.top_breach_channel(r.channel_metrics)),
        "top_opportunity": _on(lambda r: snapshot.top_opportunity(r.opportunities), OPPORTUNITY),
        "latest_week_kpis": _on(lambda r: snapshot.latest_week_kpis(r.weekly_metrics, r.tickets, r.opportunities), [*OPPORTUNITY, *WEEKLY]),
        "top_quality_issue": _on(lambda r: snapshot.top_quality_issue(r.tickets)),
        "latest_leaderboard_80": _on(lambda r: snapshot.latest_leaderboard(r.leaderboard, 80), board),
        "ticket_sample": _on(lambda r: snapshot.ticket_sample(r.tickets, 12)),
        "weekly_trend": _on(lambda r: snapshot.weekly_trend(r.weekly_metrics)),
        "text_clean": _text_clean,
        "ticket_normalisation": _ticket_normalisation,
        "timestamp_parsing": _timestamp_parsing,
        "date_orders": _date_orders,
        "date_order_parsing": _date_order_parsing,
        "edge_canonical": _edge(lambda r: r.tickets.select(*ENRICHED_COLUMNS[:21])),
        "edge_repeat": _edge(lambda r: r.repeat_contacts, REPEAT),
        "edge_leaderboard": _edge(lambda r: r.leaderboard, board),
        "edge_quality": _edge(lambda r: r.quality),
        "edge_goal": _edge(lambda r: r.business_goal, [*OPPORTUNITY, *WEEKLY]),
        "edge_sample": _edge(lambda r: snapshot.ticket_sample(r.tickets, 12)),
        "group_metrics": _on(lambda r: all_groups(r.tickets)),
        "order_weekly": _on(lambda r: with_position(r.weekly_metrics.select("week_start"))),
        "order_channel": _on(lambda r: with_position(r.channel_metrics.select("channel", "tickets"))),
        "order_category": _on(lambda r: with_position(r.category_metrics.select("category", "tickets"))),
        "order_repeat": _on(lambda r: with_position(in_reading_order(r.repeat_contacts).select("customer_id", "created_at", "ticket_id")), REPEAT),
        "order_opportunities": _on(lambda r: with_position(r.opportunities.select("opportunity")), OPPORTUNITY),
        "order_leaderboard": _on(lambda r: with_position(r.leaderboard.select("resolution_week_start", "tickets_closed", "agent_id")), board),
        "order_themes": _order_themes,
        "theme_vocabulary": _theme_vocabulary,
        "theme_tfidf": _theme_tfidf,
        "theme_summary": _theme_summary,
        "complaint_themes": _complaint_themes,
        "theme_watchlist": _theme_watchlist,
        "evidence_parts": _evidence_parts,
        "evidence_values": _evidence_values,
        "evidence_pack": _evidence_pack,
    }
