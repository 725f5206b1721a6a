"""Helpers that several operators share."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def find_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    Needed when the driver found it by ``sys.path`` alone, in local mode or with a
    shared code folder; elsewhere ship it with ``--py-files``.
    """
    folder = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if folder not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, folder]))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def local_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small driver-side table (plans, weights) as a JVM-only frame.

    ``schema`` is the DDL of one row; the rows travel as one JSON literal, so
    neither an RDD nor a Python worker is involved.
    """
    parsed = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(parsed))


def utf8(text: str | Column) -> Column:
    """The UTF-8 bytes of a text column; null becomes empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c.cast("string"), F.lit("")).cast("binary")


def words_of(data: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, as UTF-8 bytes.

    ``bytes.split()`` splits at exactly those six characters and
    ``bytes.lower()`` changes exactly A-Z, so no regular expression is needed.
    """
    return data.lower().split()


def bounded_sample(df: DataFrame, column: str, rows: int, most_bytes: int) -> list[str]:
    """Texts of the first ``rows`` rows, for fitting only; longer ones than ``most_bytes`` are left out.

    A top-level limit makes Spark read as few partitions as it needs, instead of
    sending rows of every partition to one task; at most rows * most_bytes reach
    the driver.
    """
    c = F.col(column).cast("string")
    return [r[0] for r in df.select(F.when(F.octet_length(c) <= most_bytes, c)).limit(rows).collect() if r[0]]
