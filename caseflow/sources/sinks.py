"""Sinks (S5, S6).

Tables are written by Spark (parquet by default, CSV on request).  The two
reports are single small objects built from 1-row / few-row results; they are
written as one JSON document per file, by the file system that the path (or
Spark's default) names, so they lie where the tables lie.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from caseflow.sources import files


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None, sort_by: list[str] | None = None
) -> None:
    """``sort_by`` sorts the rows of each file; with ``partition_by``, the rows of a partition go to few files.

    The rebalance hint lets adaptive execution split a partition value that holds most rows.
    """
    if partition_by:
        names = ", ".join(f"`{c}`" for c in partition_by)
        df = df.sparkSession.sql(f"SELECT /*+ REBALANCE({names}) */ * FROM {{df}}", df=df)
    if sort_by:
        df = df.sortWithinPartitions(*(partition_by or []), *sort_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.format(fmt).save(path)


def write_json_report(spark: SparkSession, report: dict[str, Any], path: str) -> None:
    """One JSON document (``default=str``, non-ASCII kept)."""
    files.write_text(spark, path, json.dumps(report, indent=2, default=str, ensure_ascii=False))
