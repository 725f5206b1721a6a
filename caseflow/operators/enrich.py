"""Policy enrichment.

Policy lookups are literal maps (a few keys from configuration) evaluated in
codegen: no join, no shuffle, nothing that grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.fixed import COMPLETED_STATUSES
from caseflow.functions.columns import hours_between, minutes_between, strip_ws, true_or_false, week_start
from caseflow.sources.policy import Policy, as_policy


def lookup(mapping: dict[str, float], key: Column) -> Column:
    """Map lookup; unknown key -> NULL."""
    if not mapping:
        return F.lit(None).cast("double")
    pairs = []
    for k, v in sorted(mapping.items()):
        pairs += [F.lit(k), F.lit(float(v))]
    return F.try_element_at(F.create_map(*pairs), key)


def apply_policy_metrics(df: DataFrame, policy: Policy | dict | None = None) -> DataFrame:
    """Adds the 16 derived columns; source columns are never modified."""
    p = as_policy(policy)
    created, first, resolved = F.col("created_at"), F.col("first_response_at"), F.col("resolved_at")
    channel_key = strip_ws(F.lower(F.coalesce(F.col("channel"), F.lit(""))))

    df = df.withColumn("channel_key", channel_key)
    frm = minutes_between(created, first)
    res_h = hours_between(created, resolved)
    handle_h = hours_between(first, resolved)
    sla_target = lookup(p.sla_minutes(), F.col("channel_key"))
    df = df.withColumns(
        {
            "first_response_minutes": frm,
            # Negative durations are unavailable; the timestamps stay as they are.
            "resolution_time_hours": F.when(res_h >= 0, res_h),
            "handle_time_hours": F.when(handle_h >= 0, handle_h),
            "sla_target_minutes": sla_target,
        }
    )
    breach = true_or_false(F.col("first_response_minutes") > F.col("sla_target_minutes"))
    rbc = true_or_false(resolved < created)
    frbc = true_or_false(first < created)
    rbfr = true_or_false(resolved < first)
    return df.withColumns(
        {
            "sla_breach": breach,
            "contact_cost_inr": F.coalesce(
                lookup(p.contact_costs(), F.col("channel_key")), F.lit(p.number("blended_cost_inr", 0.0))
            ),
            "sla_penalty_exposure_inr": F.when(breach, F.lit(p.number("sla_miss_credit_inr", 0.0))).otherwise(
                F.lit(0.0)
            ),
            "transfer_cost_inr": F.coalesce(F.col("transfers"), F.lit(0.0))
            * F.lit(p.number("internal_transfer_cost_inr", 0.0)),
            "resolved_before_created": rbc,
            "first_response_before_created": frbc,
            "resolved_before_first_response": rbfr,
            "temporal_anomaly": rbc | frbc | rbfr,
            "week_start": week_start(created),
            "resolution_week_start": week_start(resolved),
            "completed_ticket": true_or_false(F.lower(F.col("status")).isin(COMPLETED_STATUSES)),
        }
    )
