"""History-based improvement goal.

Input is the weekly table (one row per calendar week), so every frame here is
bounded by the number of weeks; single-partition windows over it are fine.
The result is a single row with a fixed schema; :func:`goal_as_dict` turns
it into the report object, keeping only the keys of the path taken.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.fixed import (
    GOAL_BASELINE_LONG,
    GOAL_BASELINE_SHORT,
    GOAL_BENCHMARK_METHOD,
    GOAL_HISTORICAL_PERIOD,
    GOAL_METRIC,
    GOAL_REASON_FEW_HISTORY,
    GOAL_REASON_FEW_WEEKS,
    GOAL_REASON_NO_GAP,
    GOAL_REASON_NO_WEEKS,
    OPP_REPEAT,
    OPP_TRANSFERS,
)
from caseflow.sources.policy import Policy, as_policy

LONG_HISTORY_WEEKS = 12
LONG_BASELINE_WEEKS = 8
MIN_WEEKS = 4
MIN_GAP = 0.005
WEEKS_PER_QUARTER = 13


def baseline_split(weekly: DataFrame, min_week_contacts: int = 1) -> DataFrame:
    """W6 + F7: each week tagged ``recent`` or ``historical``.

    With >= 12 weeks the last 8 are recent, otherwise only the last one.
    ``eligible`` marks historical weeks with at least ``min_week_contacts``.
    """
    w = weekly.filter(F.col("week_start").isNotNull()).select(
        "week_start", F.col("total_contacts").cast("long"), F.col("sla_breaches").cast("long")
    )
    n_weeks = F.count(F.lit(1)).over(Window.partitionBy())
    recency = F.row_number().over(Window.orderBy(F.desc("week_start")))
    w = w.withColumns({"n_weeks": n_weeks.cast("long"), "_recency": recency})
    recent_n = F.when(F.col("n_weeks") >= LONG_HISTORY_WEEKS, LONG_BASELINE_WEEKS).otherwise(1)
    period = F.when(F.col("_recency") <= recent_n, "recent").otherwise("historical")
    w = w.withColumn("period", period).drop("_recency")
    eligible = (F.col("period") == "historical") & (F.col("total_contacts") >= min_week_contacts)
    return w.withColumns(
        {
            "eligible": eligible,
            "weekly_rate": F.when(eligible, F.col("sla_breaches") / F.col("total_contacts")),
        }
    )


def _observation(opps: DataFrame | None, name: str, column: str) -> Column:
    return F.first(F.when(F.col("opportunity") == name, F.col(column).cast("double")), ignorenulls=True)


def business_goal(
    weekly: DataFrame,
    opportunities: DataFrame | None = None,
    policy: Policy | dict | None = None,
    min_week_contacts: int = 1,
) -> DataFrame:
    """A16 as one row (see module doc)."""
    p = as_policy(policy)
    credit = p.number("sla_miss_credit_inr", 0.0)
    split = baseline_split(weekly, min_week_contacts)
    spark = weekly.sparkSession

    # One pass over the (calendar-bounded) weekly table: the quartile cutoff is a
    # window aggregate, everything else a conditional aggregate of the same rows.
    cutoff = F.percentile(F.col("weekly_rate"), F.lit(0.25)).over(Window.partitionBy())
    split = split.withColumn("_cutoff", cutoff)
    recent_flag = F.col("period") == "recent"
    in_benchmark = F.col("eligible") & (F.col("weekly_rate") <= F.col("_cutoff"))
    summary = split.agg(
        F.count(F.lit(1)).cast("long").alias("n_weeks"),
        F.coalesce(F.sum(F.when(recent_flag, F.col("total_contacts"))), F.lit(0)).cast("long").alias("recent_contacts"),
        F.coalesce(F.sum(F.when(recent_flag, F.col("sla_breaches"))), F.lit(0)).cast("long").alias("recent_breaches"),
        F.count_if(recent_flag).cast("long").alias("recent_weeks"),
        F.count_if("eligible").cast("long").alias("historical_weeks"),
        F.max("_cutoff").alias("benchmark_cutoff_rate"),
        F.median(F.when(in_benchmark, F.col("weekly_rate"))).alias("target"),
        F.count_if(in_benchmark).cast("long").alias("benchmark_weeks"),
    )
    if opportunities is None:
        obs = spark.range(1).select(*[F.lit(None).cast("double").alias(c) for c in (
            "transfers_current_rate", "transfers_modeled_exposure_inr",
            "repeat_current_rate", "repeat_modeled_exposure_inr")])
    else:
        obs = opportunities.agg(
            _observation(opportunities, OPP_TRANSFERS, "current_rate").alias("transfers_current_rate"),
            _observation(opportunities, OPP_TRANSFERS, "modeled_exposure_inr").alias("transfers_modeled_exposure_inr"),
            _observation(opportunities, OPP_REPEAT, "current_rate").alias("repeat_current_rate"),
            _observation(opportunities, OPP_REPEAT, "modeled_exposure_inr").alias("repeat_modeled_exposure_inr"),
        )
    g = summary.crossJoin(obs)

    n, nh, nw = F.col("n_weeks"), F.col("historical_weeks"), F.col("recent_weeks")
    rc, rb, target = F.col("recent_contacts"), F.col("recent_breaches"), F.col("target")
    current = F.try_divide(rb.cast("double"), rc.cast("double"))
    gap = current - target
    per_week = F.try_divide(rc.cast("double"), nw.cast("double"))
    avoidable = F.greatest(F.lit(0.0), F.try_divide(rb.cast("double"), nw.cast("double")) - per_week * target)
    quarterly = avoidable * WEEKS_PER_QUARTER
    value = quarterly * F.lit(credit)

    enough_weeks = n >= MIN_WEEKS
    enough_history = enough_weeks & (nh >= MIN_WEEKS)
    available = enough_history & F.coalesce(gap >= MIN_GAP, F.lit(False))
    no_gap = enough_history & ~available

    def on(cond: Column, c: Column) -> Column:
        return F.when(cond, c)

    return g.select(
        available.alias("available"),
        F.when(n == 0, GOAL_REASON_NO_WEEKS)
        .when(~enough_weeks, GOAL_REASON_FEW_WEEKS)
        .when(~enough_history, GOAL_REASON_FEW_HISTORY)
        .when(no_gap, GOAL_REASON_NO_GAP)
        .alias("reason"),
        on(n > 0, n).alias("eligible_weeks"),
        on(available, F.lit(GOAL_METRIC)).alias("metric"),
        on(available, current).alias("current_rate"),
        on(available, target).alias("target_rate"),
        on(available, gap).alias("improvement_gap"),
        on(available, rc).alias("current_volume"),
        on(available, avoidable).alias("avoidable_volume_per_week"),
        on(available, quarterly).alias("quarterly_volume_reduction"),
        on(available, F.lit(credit)).alias("unit_cost_inr"),
        on(available, value).alias("quarterly_value_inr"),
        on(available, value).alias("modeled_quarterly_exposure_reduction_inr"),
        on(available, per_week).alias("average_weekly_volume"),
        on(available, F.lit(GOAL_BENCHMARK_METHOD)).alias("benchmark_method"),
        on(available, F.when(nw == LONG_BASELINE_WEEKS, GOAL_BASELINE_LONG).otherwise(GOAL_BASELINE_SHORT)).alias(
            "baseline_period"
        ),
        on(available, F.lit(GOAL_HISTORICAL_PERIOD)).alias("historical_period"),
        on(no_gap, current).alias("current_sla_rate"),
        on(no_gap, target).alias("historical_sla_benchmark"),
        on(no_gap, F.col("transfers_current_rate")).alias("transfers_current_rate"),
        on(no_gap, F.col("transfers_modeled_exposure_inr")).alias("transfers_modeled_exposure_inr"),
        on(no_gap, F.col("repeat_current_rate")).alias("repeat_current_rate"),
        on(no_gap, F.col("repeat_modeled_exposure_inr")).alias("repeat_modeled_exposure_inr"),
        on(enough_history, F.col("benchmark_cutoff_rate")).alias("benchmark_cutoff_rate"),
        on(enough_history, F.col("benchmark_weeks")).alias("benchmark_weeks"),
    )


_AVAILABLE_KEYS = [
    "available", "metric", "current_rate", "target_rate", "improvement_gap", "current_volume",
    "avoidable_volume_per_week", "quarterly_volume_reduction", "unit_cost_inr", "quarterly_value_inr",
    "modeled_quarterly_exposure_reduction_inr", "average_weekly_volume", "eligible_weeks",
    "benchmark_method", "baseline_period", "historical_period",
]


def goal_json(goal: Column) -> Column:
    """The report object of the path taken, as JSON text; null fields of it are kept."""
    keep = {"ignoreNullFields": "false"}

    def pick(*names: str) -> list[Column]:
        return [goal[n].alias(n) for n in names]

    def seen(metric: str, rate: str, exposure: str) -> Column:
        found = F.struct(F.lit(metric).alias("metric"), goal[rate].alias("current_rate"), goal[exposure].alias("modeled_exposure_inr"))
        return F.when(goal[rate].isNotNull() | goal[exposure].isNotNull(), found)

    observed = F.struct(
        seen(OPP_TRANSFERS, "transfers_current_rate", "transfers_modeled_exposure_inr").alias("transfers"),
        seen(OPP_REPEAT, "repeat_current_rate", "repeat_modeled_exposure_inr").alias("repeat_contacts"),
    )
    no_gap = F.struct(*pick("available", "eligible_weeks", "reason", "current_sla_rate", "historical_sla_benchmark"), observed.alias("observed_opportunities"))
    return (
        F.when(goal["available"], F.to_json(F.struct(*pick(*_AVAILABLE_KEYS)), keep))
        .when(goal["reason"] == GOAL_REASON_NO_GAP, F.to_json(no_gap, keep))
        .when(goal["eligible_weeks"].isNotNull(), F.to_json(F.struct(*pick("available", "eligible_weeks", "reason")), keep))
        .otherwise(F.to_json(F.struct(*pick("available", "reason")), keep))
    )


def goal_as_dict(goal: DataFrame) -> dict[str, Any]:
    """The report object of a 1-row goal table."""
    row = goal.select(goal_json(F.struct(*goal.columns)).alias("json")).first()
    return json.loads(row["json"])
