"""Duplicate reconciliation.

One row per ticket_id: the helpdesk copy first, then the most complete row,
then input order (finally a content hash, so the choice never depends on how
rows were partitioned).  All NULL ids collapse to one row.

``row_number() = 1`` directly under the filter lets Catalyst insert a partial
``WindowGroupLimit`` before the shuffle: every map task forwards at most one
row per id, so an id holding a third of all rows costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.fixed import LEGACY_SOURCE, PREFERRED_SOURCE
from caseflow.sources.tables import INGEST_COL

_PRIO = "_source_priority"
_COMPLETE = "_completeness"
_RANK = "_rank"


def source_priority(source: str | Column = "source_system") -> Column:
    """1 for the preferred source, else 0."""
    c = F.col(source) if isinstance(source, str) else source
    return (F.lower(F.coalesce(c, F.lit(""))) == PREFERRED_SOURCE).cast("int")


def completeness(columns: list[str]) -> Column:
    """Number of non-null columns in the row ('' counts as present).

    Written as one SQL expression: one call to build, however wide the table."""
    quoted = ("`" + c.replace("`", "``") + "`" for c in columns)
    return F.expr(" + ".join(f"CAST({q} IS NOT NULL AS INT)" for q in quoted) or "0")


def keep_best(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """First row per ``key`` under ``order`` (NULL keys form one group)."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(w)).filter(F.col(_RANK) == 1).drop(_RANK)


def with_read_order(df: DataFrame) -> DataFrame:
    """Frames from sources carry ``_ingest_order``; others get the order Spark
    reads them in (partition, then row), taken before any shuffle."""
    return df if INGEST_COL in df.columns else df.withColumn(INGEST_COL, F.monotonically_increasing_id())


def canonical_tickets(raw: DataFrame) -> DataFrame:
    """A2: the canonical ticket table (helper columns dropped, P23)."""
    raw = with_read_order(raw)
    data_cols = [c for c in raw.columns if c != INGEST_COL]
    work = raw.withColumns({_PRIO: source_priority(), _COMPLETE: completeness(data_cols)})
    order = [F.col(_PRIO).desc(), F.col(_COMPLETE).desc(), F.col(INGEST_COL).asc()]
    order.append(F.xxhash64(*[F.col(c) for c in data_cols]).asc())
    return keep_best(work, "ticket_id", order).drop(_PRIO, _COMPLETE, INGEST_COL)


def duplicate_counters(raw: DataFrame) -> DataFrame:
    """A1, A3, A4 as one row.

    One aggregation by ticket_id (partial aggregation before the shuffle, so a
    hot id is pre-counted per task), then a global fold of the small result:
    raw_rows, canonical_rows, unique_ticket_ids, duplicate_ticket_rows,
    duplicate_ticket_id_groups, duplicate_pairs_helpdesk_legacy.
    """
    src = F.lower(F.col("source_system"))
    groups = raw.groupBy("ticket_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_or(src == PREFERRED_SOURCE).alias("has_pref"),
        F.bool_or(src == LEGACY_SOURCE).alias("has_legacy"),
    )
    is_dup = F.col("ticket_id").isNotNull() & (F.col("n") > 1)
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("raw_rows"),
        F.count(F.lit(1)).cast("long").alias("canonical_rows"),
        F.count("ticket_id").cast("long").alias("unique_ticket_ids"),
        F.coalesce(F.sum(F.when(is_dup, F.col("n"))), F.lit(0)).cast("long").alias("duplicate_ticket_rows"),
        F.count_if(is_dup).cast("long").alias("duplicate_ticket_id_groups"),
        F.count_if(is_dup & F.coalesce(F.col("has_pref") & F.col("has_legacy"), F.lit(False)))
        .cast("long")
        .alias("duplicate_pairs_helpdesk_legacy"),
    )


def reconcile_duplicates(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(canonical, counters)``; both lazy."""
    return canonical_tickets(raw), duplicate_counters(raw)
