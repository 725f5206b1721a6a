"""Opportunity sizing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.fixed import (
    OPP_REPEAT,
    OPP_REPEAT_DEFINITION,
    OPP_SLA,
    OPP_SLA_DEFINITION,
    OPP_TRANSFERS,
    OPP_TRANSFERS_DEFINITION,
)
from caseflow.sources.policy import Policy, as_policy


def opportunities(tickets: DataFrame, repeat: DataFrame, policy: Policy | dict | None = None, ids_unique: bool = False) -> DataFrame:
    """Three rows (SLA breaches, internal transfers, 7-day repeat proxy), largest exposure first.

    Two global aggregates (partial aggregation per task, one row each) joined
    as 1-row frames; no data-sized exchange besides the partial results.
    """
    p = as_policy(policy)
    unit = p.number("internal_transfer_cost_inr", 305.0)
    blended = p.number("blended_cost_inr", 290.0)
    ids = F.count("ticket_id") if ids_unique else F.count_distinct("ticket_id")
    t = tickets.agg(
        F.greatest(ids, F.lit(1)).cast("double").alias("_total"),
        F.count_if("sla_breach").cast("long").alias("_breaches"),
        F.coalesce(F.sum("sla_penalty_exposure_inr"), F.lit(0.0)).alias("_sla_cost"),
        F.coalesce(F.sum(F.coalesce(F.col("transfers"), F.lit(0.0))), F.lit(0.0)).alias("_transfers"),
    )
    r = repeat.agg(F.count_if("repeat_contact_7d").cast("long").alias("_repeats"))
    j = t.crossJoin(r)

    def row(name, rate_num, volume, exposure, definition):
        return F.struct(
            F.lit(name).alias("opportunity"),
            (rate_num.cast("double") / F.col("_total")).alias("current_rate"),
            volume.cast("long").alias("affected_volume"),
            exposure.cast("double").alias("modeled_exposure_inr"),
            F.lit(definition).alias("definition"),
        )

    rows = F.array(
        row(OPP_SLA, F.col("_breaches"), F.col("_breaches"), F.col("_sla_cost"), OPP_SLA_DEFINITION),
        row(OPP_TRANSFERS, F.col("_transfers"), F.col("_transfers"), F.col("_transfers") * F.lit(unit), OPP_TRANSFERS_DEFINITION),
        row(OPP_REPEAT, F.col("_repeats"), F.col("_repeats"), F.col("_repeats") * F.lit(blended), OPP_REPEAT_DEFINITION),
    )
    return j.select(F.inline(rows)).orderBy(F.desc("modeled_exposure_inr"), "opportunity")
