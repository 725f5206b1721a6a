"""Weekly tier-1 leaderboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.fixed import ROSTER_ALIASES, TIER1_TEAMS, TIER_CODES
from caseflow.functions.columns import safe_ratio, strip_ws
from caseflow.operators.dedupe import keep_best, with_read_order
from caseflow.operators.median import exact_median
from caseflow.sources.policy import Policy, as_policy
from caseflow.sources.tables import INGEST_COL

ROSTER_COLUMNS = ["agent_id", "name", "team", "tier"]


def normalize_roster(agents: DataFrame | None) -> DataFrame | None:
    """Alias resolution (first match wins), missing columns as NULL, strings."""
    if agents is None:
        return None
    cols = {}
    for target, candidates in ROSTER_ALIASES.items():
        found = next((c for c in candidates if c in agents.columns), None)
        cols[target] = (F.col(found) if found else F.lit(None)).cast("string")
    agents = with_read_order(agents)
    return agents.select(*[v.alias(k) for k, v in cols.items()], INGEST_COL)


def first_per_agent(roster: DataFrame) -> DataFrame:
    """The first roster row per agent_id in input order (NULL ids form one group)."""
    roster = with_read_order(roster)
    order = [F.col(INGEST_COL).asc(), F.xxhash64(*[F.col(c) for c in ROSTER_COLUMNS]).asc()]
    return keep_best(roster, "agent_id", order).select(*ROSTER_COLUMNS)


def _tier_key(c):
    k = strip_ws(F.lower(F.coalesce(c, F.lit(""))))
    for code, label in TIER_CODES.items():
        k = F.when(k == code, F.lit(label)).otherwise(k)
    return k


def tier1_leaderboard(
    tickets: DataFrame,
    agents: DataFrame | None,
    policy: Policy | dict | None = None,
    ids_unique: bool = False,
) -> DataFrame:
    """Closed tickets per (resolution week, agent, name, effective team).

    Tickets are left-joined to the de-duplicated roster with NULL-safe
    equality.  When no empty tier is eligible, an unmatched ticket can never
    qualify (its tier is ''), so the roster is first cut to eligible tiers and
    the join becomes an inner join on a smaller side.  Whether the roster is
    broadcast is left to Spark, which knows its measured size.
    """
    p = as_policy(policy)
    eligible = p.eligible_tiers()
    roster = normalize_roster(agents)
    base = tickets.filter(F.col("completed_ticket") & F.col("resolution_week_start").isNotNull())

    if roster is None:
        r = None
    else:
        r = first_per_agent(roster).select(
            F.col("agent_id").alias("_r_agent_id"),
            F.col("name").alias("_r_name"),
            F.col("team").alias("_r_team"),
            F.col("tier").alias("_r_tier"),
        )
    if r is not None and "" not in eligible:
        r = r.filter(_tier_key(F.col("_r_tier")).isin(eligible))
        how = "inner"
    else:
        how = "left"

    if r is None:
        x = base.withColumns({"_r_name": F.lit(None).cast("string"), "_r_team": F.lit(None).cast("string"), "_r_tier": F.lit(None).cast("string")})
    else:
        x = base.join(r, base["agent_id"].eqNullSafe(r["_r_agent_id"]), how)

    effective_team = F.coalesce(F.col("_r_team"), F.col("assigned_team"))
    x = x.withColumns({"name": F.col("_r_name"), "effective_team": effective_team})
    team_key = strip_ws(F.lower(F.coalesce(F.col("effective_team"), F.lit(""))))
    x = x.filter(_tier_key(F.col("_r_tier")).isin(eligible) & team_key.isin(TIER1_TEAMS))

    keys = ["resolution_week_start", "agent_id", "name", "effective_team"]
    # Exact and memory-bounded for a hot group (see operators.median); the other
    # figures are sums that ride along.
    sums = {
        "sla_breaches": F.col("sla_breach").cast("long"),
        "_csat": F.col("csat_score"),
        "_csats": F.col("csat_score").isNotNull().cast("long"),
        "tickets_closed": F.col("ticket_id").isNotNull().cast("long"),
    }
    out = exact_median(x, keys, "handle_time_hours", "median_handle_time_hours", sums)
    if not ids_unique:
        distinct = x.groupBy(*keys).agg(F.count_distinct("ticket_id").alias("tickets_closed"))
        right = distinct.select(*[F.col(k).alias(f"_d_{k}") for k in keys], "tickets_closed")
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_d_{k}"))
        out = out.drop("tickets_closed").join(right, same)
    out = out.withColumn("avg_csat", F.try_divide("_csat", "_csats"))
    out = out.select(*keys, F.col("tickets_closed").cast("long"), F.coalesce("sla_breaches", F.lit(0)).cast("long").alias("sla_breaches"), "avg_csat", "median_handle_time_hours")
    out = out.withColumn("sla_breach_rate", safe_ratio("sla_breaches", "tickets_closed"))
    return out.orderBy("resolution_week_start", F.desc("tickets_closed"), F.asc_nulls_first("agent_id"))
