"""Data-quality report.

Both inputs are folded by source system first (partial aggregation, one small
row per source); a rollup of those few rows adds the totals, and every row then
yields its report lines, so each input is read once.  Result: a long table
``(metric, key, value)``; ``key`` is NULL for scalar metrics.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.fixed import NULL_KEY_LABEL

_COUNTER_METRICS = [
    "raw_rows", "canonical_rows", "unique_ticket_ids", "duplicate_ticket_rows",
    "duplicate_ticket_id_groups", "duplicate_pairs_helpdesk_legacy",
]
_CANONICAL_SUMS = [
    ("missing_resolved_at", "n_missing_resolved"),
    ("missing_agent_id", "n_missing_agent"),
    ("invalid_created_at", "n_invalid_created"),
]
_RAW_SUMS = [
    ("resolved_before_created", "r_rbc"),
    ("first_response_before_created", "r_frbc"),
    ("resolved_before_first_response", "r_rbfr"),
]
_CANONICAL_FLAGS = [
    ("canonical_resolved_before_created", "c_rbc"),
    ("canonical_first_response_before_created", "c_frbc"),
    ("canonical_resolved_before_first_response", "c_rbfr"),
    ("canonical_temporal_anomalies", "c_anom"),
]
SCALAR_METRICS = (
    _COUNTER_METRICS
    + [m for m, _ in _CANONICAL_SUMS]
    + [m for m, _ in _RAW_SUMS]
    + [m for m, _ in _CANONICAL_FLAGS]
    + ["canonical_temporal_anomaly_rate"]
)
MAP_METRICS = ["source_system_counts", "resolved_before_created_by_source", "canonical_temporal_anomalies_by_source"]



CANONICAL_COUNT_NAMES = ["n", *[c for _, c in _CANONICAL_SUMS + _CANONICAL_FLAGS]]
CANONICAL_FLAG_COLUMNS = ["resolved_before_created", "first_response_before_created", "resolved_before_first_response", "temporal_anomaly"]


def source_name() -> Column:
    return F.coalesce(F.col("source_system"), F.lit(NULL_KEY_LABEL))


def _src() -> Column:
    return source_name().alias("source")


def raw_by_source(raw: DataFrame) -> DataFrame:
    """A7 on raw rows, per source (NULL comparisons count as False)."""
    c, f, r = F.col("created_at"), F.col("first_response_at"), F.col("resolved_at")
    return raw.groupBy(_src()).agg(
        F.count_if(r < c).cast("long").alias("r_rbc"),
        F.count_if(f < c).cast("long").alias("r_frbc"),
        F.count_if(r < f).cast("long").alias("r_rbfr"),
    )


def canonical_counts() -> list[Column]:
    """A5, A6, A8 as aggregates, named by ``CANONICAL_COUNT_NAMES``."""
    missing = [F.count_if(F.col(c).isNull()) for c in ("resolved_at", "agent_id", "created_at")]
    counts = [F.count(F.lit(1)), *missing, *[F.count_if(c) for c in CANONICAL_FLAG_COLUMNS]]
    return [c.cast("long").alias(name) for c, name in zip(counts, CANONICAL_COUNT_NAMES, strict=True)]


def canonical_by_source(tickets: DataFrame) -> DataFrame:
    """A5, A6, A8 on enriched canonical tickets, per source."""
    return tickets.groupBy(_src()).agg(*canonical_counts())


def quality_report(raw: DataFrame, tickets: DataFrame | None, counters: DataFrame, by_source: DataFrame | None = None) -> DataFrame:
    """A8b as ``(metric string, key string, value double)``; ``by_source`` stands for the canonical tickets where it is known."""
    none = F.lit(None).cast("string")

    def item(metric: str, key, value):
        return F.struct(F.lit(metric).alias("metric"), key.alias("key"), value.cast("double").alias("value"))

    def totals_and_sources(df: DataFrame, sums: list[str]) -> DataFrame:
        """The few rows per source and their total (``_total``), from one reading of ``df``."""
        return df.rollup("source").agg(*[F.sum(c).alias(c) for c in sums], (F.grouping("source") == 1).alias("_total"))

    cs = totals_and_sources(canonical_by_source(tickets) if by_source is None else by_source, CANONICAL_COUNT_NAMES)
    rs = totals_and_sources(raw_by_source(raw), [c for _, c in _RAW_SUMS])
    rate = F.bround(F.try_divide(F.col("c_anom") * 100.0, F.col("n")), 2)
    canonical = F.when(
        F.col("_total"),
        F.array(*[item(m, none, F.col(c)) for m, c in _CANONICAL_SUMS + _CANONICAL_FLAGS], item("canonical_temporal_anomaly_rate", none, rate)),
    ).otherwise(F.array(item("source_system_counts", F.col("source"), F.col("n")), item("canonical_temporal_anomalies_by_source", F.col("source"), F.col("c_anom"))))
    before = F.when(F.col("_total"), F.array(*[item(m, none, F.col(c)) for m, c in _RAW_SUMS])).otherwise(
        F.array(item("resolved_before_created_by_source", F.col("source"), F.col("r_rbc")))
    )
    scalars = counters.select(F.inline(F.array(*[item(m, none, F.col(m)) for m in _COUNTER_METRICS])))
    out = cs.select(F.inline(canonical)).unionByName(rs.select(F.inline(before))).unionByName(scalars)
    positive_only = F.col("metric").isin("resolved_before_created_by_source", "canonical_temporal_anomalies_by_source")
    return out.filter(~positive_only | (F.col("value") > 0))


def quality_as_dict(rows: list[Any]) -> dict[str, Any]:
    """The report object from the collected long table (a few dozen rows)."""
    out: dict[str, Any] = {}
    maps: dict[str, list[tuple[str, int]]] = {m: [] for m in MAP_METRICS}
    for r in rows:
        metric, key, value = r["metric"], r["key"], r["value"]
        if metric in maps:
            maps[metric].append((key, int(value)))
        elif metric == "canonical_temporal_anomaly_rate":
            out[metric] = value
        else:
            out[metric] = int(value)
    ordered: dict[str, Any] = {m: out[m] for m in SCALAR_METRICS if m in out}
    for m, entries in maps.items():
        ordered[m] = dict(sorted(entries, key=lambda kv: (-kv[1], kv[0])))
    return ordered
