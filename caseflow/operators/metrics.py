"""Weekly and per-group metrics (A9, A10, W5), each alone or all from one reading.

``ids_unique=True`` is for canonical input (one row per ticket id, at most
one NULL id): the distinct ticket count is then a plain non-null count, which
avoids a distinct-aggregate expansion and its extra shuffle.  The default
keeps the general distinct count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.functions.columns import safe_ratio
from caseflow.operators.quality import CANONICAL_COUNT_NAMES, CANONICAL_FLAG_COLUMNS, canonical_counts, source_name
from caseflow.sources.policy import Policy, as_policy


def _ticket_count(ids_unique: bool) -> Column:
    return F.count("ticket_id") if ids_unique else F.count_distinct("ticket_id")


def weekly_metrics(df: DataFrame, ids_unique: bool = False) -> DataFrame:
    """One row per created week, oldest first.

    The week-over-week change (W5) is a window over the weekly table itself,
    whose size is bounded by the calendar (52 rows a year), not by the data.
    """
    return _by_week(
        df.filter(F.col("week_start").isNotNull())
        .groupBy("week_start")
        .agg(
            _ticket_count(ids_unique).cast("long").alias("total_contacts"),
            F.count_distinct("customer_id").cast("long").alias("unique_customers"),
            F.count_if("sla_breach").cast("long").alias("sla_breaches"),
            F.avg("csat_score").alias("avg_csat"),
            F.sum("contact_cost_inr").alias("contact_cost_inr"),
            F.sum("sla_penalty_exposure_inr").alias("sla_penalty_exposure_inr"),
            F.sum("transfer_cost_inr").alias("transfer_cost_inr"),
        )
    )


def _by_week(grouped: DataFrame) -> DataFrame:
    prev = F.lag("total_contacts").over(Window.orderBy("week_start"))
    return grouped.withColumns(
        {
            "sla_breach_rate": safe_ratio("sla_breaches", "total_contacts"),
            "week_over_week_contacts": F.try_divide(F.col("total_contacts").cast("double"), prev.cast("double")) - 1,
        }
    ).orderBy("week_start")


def group_metrics(df: DataFrame, group_col: str, transfer_unit_cost: float = 305.0, ids_unique: bool = False) -> DataFrame:
    """A10: per value of ``group_col`` (NULL group kept), most tickets first."""
    out = df.groupBy(group_col).agg(
        _ticket_count(ids_unique).cast("long").alias("tickets"),
        F.count_if("sla_breach").cast("long").alias("sla_breaches"),
        F.avg("csat_score").alias("avg_csat"),
        F.sum(F.coalesce(F.col("transfers"), F.lit(0.0))).alias("transfer_events"),
        F.sum("contact_cost_inr").alias("contact_cost_inr"),
        F.sum("sla_penalty_exposure_inr").alias("sla_penalty_exposure_inr"),
    )
    return _by_group(out, group_col, transfer_unit_cost)


def _by_group(out: DataFrame, group_col: str, transfer_unit_cost: float) -> DataFrame:
    out = out.withColumns(
        {
            "sla_breach_rate": safe_ratio("sla_breaches", "tickets"),
            "transfer_cost_inr": F.col("transfer_events") * F.lit(float(transfer_unit_cost)),
        }
    )
    return out.orderBy(F.desc("tickets"), F.asc_nulls_first(group_col))


def _transfer_unit(policy: Policy | dict | None) -> float:
    # The marts use 305 when the policy has no transfer cost (enrichment uses 0).
    return as_policy(policy).number("internal_transfer_cost_inr", 305.0)


def channel_metrics(df: DataFrame, policy: Policy | dict | None = None, ids_unique: bool = False) -> DataFrame:
    """By the stripped channel as written (not lower-cased)."""
    return group_metrics(df, "channel", _transfer_unit(policy), ids_unique)


def category_metrics(df: DataFrame, policy: Policy | dict | None = None, ids_unique: bool = False) -> DataFrame:
    """A10b."""
    return group_metrics(df, "category", _transfer_unit(policy), ids_unique)


#: Columns of the tickets that :func:`all_groups` reads.
GROUP_INPUTS = [
    "ticket_id", "customer_id", "week_start", "channel", "category", "source_system", "sla_breach", "csat_score", "transfers", "contact_cost_inr",
    "sla_penalty_exposure_inr", "transfer_cost_inr", "resolved_at", "agent_id", "created_at", *CANONICAL_FLAG_COLUMNS,
]


def all_groups(df: DataFrame) -> DataFrame:
    """A8b, A9, A10a, A10b in one reading: a row per ``kind`` (week, channel, category, source) and key, with the measures of all.

    Every ticket yields a row per kind, aggregated before the shuffle.  The customer goes
    along for weeks only, so that other kinds count distinct nothing.  ``df`` has one row
    per ticket id.  Few rows come out; stage them and split with the functions below.
    """
    none = F.lit(None).cast("string")

    def way(kind: str, key: Column, customer: Column = none) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.when(F.lit(kind == "week"), F.col("week_start")).alias("week"), key.alias("key"), customer.alias("customer"))

    ways = F.array(way("week", none, F.col("customer_id")), way("channel", F.col("channel")), way("category", F.col("category")), way("source", source_name()))
    rows = df.select(*GROUP_INPUTS).withColumn("_w", F.explode(ways)).where("_w.kind <> 'week' or _w.week is not null")
    return rows.groupBy("_w.kind", "_w.week", "_w.key").agg(
        F.count("ticket_id").cast("long").alias("tickets"), F.count_distinct("_w.customer").cast("long").alias("unique_customers"),
        F.count_if("sla_breach").cast("long").alias("sla_breaches"), F.avg("csat_score").alias("avg_csat"),
        F.sum(F.coalesce(F.col("transfers"), F.lit(0.0))).alias("transfer_events"), F.sum("contact_cost_inr").alias("contact_cost_inr"),
        F.sum("sla_penalty_exposure_inr").alias("sla_penalty_exposure_inr"), F.sum("transfer_cost_inr").alias("transfer_cost_inr"), *canonical_counts(),
    )


def weekly_of(groups: DataFrame) -> DataFrame:
    """A9 from :func:`all_groups`."""
    weeks = groups.where("kind = 'week'").select(
        F.col("week").alias("week_start"), F.col("tickets").alias("total_contacts"), "unique_customers", "sla_breaches", "avg_csat", "contact_cost_inr",
        "sla_penalty_exposure_inr", "transfer_cost_inr",
    )
    return _by_week(weeks)


def group_of(groups: DataFrame, kind: str, policy: Policy | dict | None = None) -> DataFrame:
    """A10a or A10b from :func:`all_groups`."""
    rows = groups.where(F.col("kind") == kind).select(F.col("key").alias(kind), "tickets", "sla_breaches", "avg_csat", "transfer_events", "contact_cost_inr", "sla_penalty_exposure_inr")
    return _by_group(rows, kind, _transfer_unit(policy))


def sources_of(groups: DataFrame) -> DataFrame:
    """A5, A6, A8 per source from :func:`all_groups`, as the quality report takes them."""
    return groups.where("kind = 'source'").select(F.col("key").alias("source"), *CANONICAL_COUNT_NAMES)
