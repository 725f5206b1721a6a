"""The place of each row in a sorted table, as a column.

A sorted frame is dealt by ranges, one part file for each, so the place of a row is the
number of rows in earlier files plus its own place in its file.  Only the files are
counted and summed; the rows are neither ranked in one task nor brought together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseflow.session import stage


def with_position(ordered: DataFrame) -> DataFrame:
    """``ordered``, a sorted frame, with ``position long`` from 0 in its own order."""
    written = stage(ordered).select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    placed = written.withColumn("_part", F.regexp_extract("_file", r"part-(\d+)", 1).cast("long"))
    # a window over the part files, of which there are as many as write tasks
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    files = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return placed.join(files, "_part").withColumn("position", (F.col("_before") + F.col("_at")).cast("long")).drop("_part", "_file", "_at", "_before")
