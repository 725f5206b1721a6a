"""Snapshot queries over pipeline outputs.

Each answers one fixed question with a top-k or a bounded head; every limit
here is the feature itself (a top-1 answer, a latest-80 report, a 12-row
sample) and sits behind a total, deterministic order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.fixed import EVIDENCE_LIMITS, EVIDENCE_TICKET_COLUMNS, INTERPRETATION_RULES, NULL_KEY_LABEL
from caseflow.operators.goal import goal_json
from caseflow.operators.quality import MAP_METRICS, SCALAR_METRICS


def top_breach_channel(channel_metrics: DataFrame) -> DataFrame:
    """Channel with the highest SLA breach rate."""
    return channel_metrics.orderBy(F.desc_nulls_last("sla_breach_rate"), F.asc_nulls_first("channel")).limit(1)


def top_opportunity(opportunities: DataFrame) -> DataFrame:
    """R2: largest modelled opportunity."""
    return opportunities.orderBy(F.desc("modeled_exposure_inr"), "opportunity").limit(1)


def latest_week_kpis(weekly: DataFrame, tickets: DataFrame, opportunities: DataFrame) -> DataFrame:
    """Latest week's contacts and breach rate, canonical tickets, total exposure.

    ``max_by`` over the weekly table and two global aggregates: three 1-row
    frames, joined.
    """
    latest = weekly.agg(F.max_by(F.struct("week_start", "total_contacts", "sla_breach_rate"), F.col("week_start")).alias("w"))
    latest = latest.select("w.*").filter(F.col("week_start").isNotNull())
    canon = tickets.agg(F.count(F.lit(1)).cast("long").alias("canonical_rows"))
    exposure = opportunities.agg(F.sum("modeled_exposure_inr").alias("total_modeled_exposure_inr"))
    return latest.crossJoin(canon).crossJoin(exposure)


def anomaly_rate_by_source(tickets: DataFrame) -> DataFrame:
    src = F.coalesce(F.col("source_system"), F.lit(NULL_KEY_LABEL)).alias("source")
    return (
        tickets.groupBy(src)
        .agg(
            F.count(F.lit(1)).cast("long").alias("canonical_rows"),
            F.count_if("temporal_anomaly").cast("long").alias("temporal_anomalies"),
        )
        .withColumn("anomaly_rate", F.col("temporal_anomalies") / F.col("canonical_rows"))
    )


def top_quality_issue(tickets: DataFrame) -> DataFrame:
    """The source with the highest temporal-anomaly rate."""
    return anomaly_rate_by_source(tickets).orderBy(F.desc("anomaly_rate"), "source").limit(1)


def theme_watchlist(themes: DataFrame, n: int = 20) -> DataFrame:
    """Themes worth investigating, lowest satisfaction first, then the largest."""
    return themes.orderBy(F.asc_nulls_last("avg_csat"), F.desc("ticket_count"), "theme_id").limit(n)


def latest_leaderboard(leaderboard: DataFrame, n: int = 80) -> DataFrame:
    """The ``n`` most recent leaderboard rows."""
    return leaderboard.orderBy(
        F.desc("resolution_week_start"),
        F.desc("tickets_closed"),
        F.asc_nulls_first("agent_id"),
        F.asc_nulls_first("name"),
        F.asc_nulls_first("effective_team"),
    ).limit(n)


def ticket_sample(tickets: DataFrame, n: int = 12) -> DataFrame:
    """O10 + P31: the first ``n`` canonical tickets (by id), evidence columns only."""
    cols = [c for c in EVIDENCE_TICKET_COLUMNS if c in tickets.columns]
    out = tickets.select(*cols)
    if "created_at" in cols:
        out = out.withColumn("created_at", F.col("created_at").cast("string"))
    return out.orderBy(F.asc_nulls_last("ticket_id")).limit(n)


def weekly_trend(weekly: DataFrame) -> DataFrame:
    """Contacts and breach rate in percent per week."""
    return weekly.select("week_start", "total_contacts", (F.col("sla_breach_rate") * 100).alias("sla_breach_rate_pct"))


def _records(df: DataFrame, order: list[Column], n: int | None) -> DataFrame:
    """One row: ``total`` rows of ``df``, and its first ``n`` (None: all) as an array of structs."""
    cols = F.struct(*[F.col(c) for c in df.columns])
    head = df.orderBy(*order)
    head = (head if n is None else head.limit(n)).withColumn("_k", F.monotonically_increasing_id())
    records = head.agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col("_k"), cols.alias("r")))), lambda x: x["r"]).alias("records"))
    total = df.agg(F.count(F.lit(1)).alias("total"))
    return total.crossJoin(records)


def quality_object(quality_long: DataFrame) -> DataFrame:
    """The data-quality report as one struct (typed scalars, per-source maps,
    interpretation notes), from one aggregate over the few-row long table."""
    m = F.col("metric")
    fields = []
    for name in SCALAR_METRICS:
        value = F.max(F.when(m == name, F.col("value")))
        fields.append((value if name == "canonical_temporal_anomaly_rate" else value.cast("long")).alias(name))
    for name in MAP_METRICS:
        entries = F.collect_list(F.when(m == name, F.struct(F.col("key"), F.col("value").cast("long"))))
        fields.append(F.map_from_entries(F.array_sort(entries)).alias(name))
    rules = F.create_map(*[x for k, v in INTERPRETATION_RULES.items() for x in (F.lit(k), F.lit(v))])
    return quality_long.agg(F.struct(*fields, rules.alias("interpretation_rules")).alias("value"))


def evidence_pack(
    quality_long: DataFrame,
    goal: DataFrame,
    weekly: DataFrame,
    opportunities: DataFrame,
    channel: DataFrame,
    category: DataFrame,
    themes: DataFrame | None,
    leaderboard: DataFrame,
    tickets: DataFrame,
    limits: dict[str, int | None] | None = None,
) -> DataFrame:
    """One row with one JSON document, column ``evidence``; null fields are kept.

    ``limits`` overrides ``EVIDENCE_LIMITS`` by part; ``part_totals`` in the document
    tells how many rows each part has in full.  The parts are 1-row aggregates of
    bounded heads, so the cross joins combine single rows only.
    """
    top = EVIDENCE_LIMITS | (limits or {})
    latest = [F.desc("resolution_week_start"), F.desc("tickets_closed"), F.asc_nulls_first("agent_id"), F.asc_nulls_first("name"), F.asc_nulls_first("effective_team")]
    sample = tickets.select(*[c for c in EVIDENCE_TICKET_COLUMNS if c in tickets.columns])
    lists = {
        "weekly_metrics": (weekly, ["week_start"]),
        "opportunities": (opportunities, [F.desc("modeled_exposure_inr"), "opportunity"]),
        "channel_metrics": (channel, [F.desc("tickets"), F.asc_nulls_first("channel")]),
        "category_metrics": (category, [F.desc("tickets"), F.asc_nulls_first("category")]),
        "tier1_leaderboard_latest_weeks": (leaderboard, latest),
        "ticket_sample": (sample, [F.asc_nulls_last("ticket_id")]),
    }
    if themes is not None:
        lists["complaint_themes"] = (themes, [F.desc("ticket_count"), "theme_id"])
    out = quality_object(quality_long).withColumnRenamed("value", "data_quality")
    out = out.crossJoin(goal.select(F.struct(*goal.columns).alias("_goal")))
    for name, (df, order) in lists.items():
        part = _records(df, order, top[name])
        out = out.crossJoin(part.select(F.col("total").alias(f"_n_{name}"), F.col("records").alias(name)))
    totals = F.struct(*[F.col(f"_n_{name}").alias(name) for name in lists])
    keep = {"ignoreNullFields": "false"}
    # the goal's fields depend on the path taken, so its object is chosen as text
    parts = [F.concat(F.lit('{"business_goal":'), goal_json(F.col("_goal")))]
    for name, value in [("data_quality", F.col("data_quality")), ("part_totals", totals), *[(n, F.col(n)) for n in lists]]:
        parts.append(F.concat(F.lit(f',"{name}":'), F.to_json(value, keep)))
    return out.select(F.concat(*parts, F.lit("}")).alias("evidence"))


def evidence_parts(pack: DataFrame) -> DataFrame:
    """The document's parts as rows ``(part, total, json)``, to compare them one by one."""
    names = ["weekly_metrics", "opportunities", "channel_metrics", "category_metrics", "tier1_leaderboard_latest_weeks", "ticket_sample"]
    return pack.select(
        F.inline(F.array(*[
            F.struct(
                F.lit(n).alias("part"),
                F.get_json_object("evidence", f"$.part_totals.{n}").cast("long").alias("total"),
                F.json_array_length(F.get_json_object("evidence", f"$.{n}")).cast("long").alias("records"),
            )
            for n in names
        ]))
    )


#: Objects and arrays inside each other in the evidence document.
EVIDENCE_DEPTH = 6


def evidence_values(pack: DataFrame) -> DataFrame:
    """Every value of the document as a row ``path, kind, text, number``, nulls included; empty lists and objects have none.

    The kinds are ``string``, ``boolean`` (both in ``text``), ``number`` and ``null``.
    """
    spark = pack.sparkSession
    level = pack.select(F.lit("").alias("path"), F.parse_json("evidence").alias("v"))
    leaves = []
    for _ in range(EVIDENCE_DEPTH):
        shape = F.schema_of_variant("v")
        nested = shape.startswith("OBJECT") | shape.startswith("ARRAY")
        leaves.append(level.where(~nested))
        level = spark.sql(
            "SELECT CASE WHEN x.key IS NULL THEN concat(path, '[', x.pos, ']') WHEN path = '' THEN x.key ELSE concat(path, '.', x.key) END AS path, x.value AS v "
            "FROM {level}, LATERAL variant_explode(v) x",
            level=level.where(nested),
        )
    values = leaves[0]
    for more in leaves[1:]:
        values = values.unionByName(more)
    shape = F.schema_of_variant("v")
    kind = F.when(shape == "STRING", "string").when(shape == "BOOLEAN", "boolean").when(shape == "VOID", "null").otherwise("number")
    return values.select("path", kind.alias("kind"), F.expr("try_variant_get(v, '$', 'string')").alias("text"), F.expr("try_variant_get(v, '$', 'double')").alias("number")).select(
        "path", "kind", F.when(F.col("kind").isin("string", "boolean"), F.col("text")).alias("text"), F.when(F.col("kind") == "number", F.col("number")).alias("number")
    )
