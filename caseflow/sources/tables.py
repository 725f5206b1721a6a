"""Table sources.

CSV is read as all-string with quoted multi-line fields, then the NA tokens
become NULL; typing happens in :func:`caseflow.operators.normalize.normalize_tickets`.
Parquet and catalog tables are read as they are.  Every source gets an
``_ingest_order`` column (file, block, position) so "input order" tie-breaks
do not depend on how Spark splits the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.fixed import NA_TOKENS
from caseflow.session import stage

INGEST_COL = "_ingest_order"


def with_ingest_order(df: DataFrame) -> DataFrame:
    """Attach a sortable, partitioning-independent input position."""
    return df.withColumn(
        INGEST_COL,
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("pos"),
        ),
    )


def null_na_tokens(df: DataFrame, tokens: list[str] = NA_TOKENS) -> DataFrame:
    """pandas-style NA tokens -> NULL on every string column (exact, untrimmed match)."""
    return df.select(
        *[
            F.when(F.col(c).isin(tokens), F.lit(None).cast("string")).otherwise(F.col(c)).alias(c)
            if isinstance(df.schema[c].dataType, T.StringType)
            else F.col(c)
            for c in df.columns
        ]
    )


def read_csv_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or folder of files, all strings.

    Quoted fields may hold line ends, so one file is parsed by one task; large
    inputs should come as a folder of files, which are parsed side by side.
    """
    raw = (
        spark.read.options(header=True, multiLine=True, escape='"', inferSchema=False, mode="PERMISSIVE")
        .csv(path)
    )
    return with_ingest_order(null_na_tokens(raw))


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def read_table(spark: SparkSession, data_dir: str, name: str) -> DataFrame | None:
    """``<name>.parquet`` or ``<name>.csv`` (file or folder) under ``data_dir``; None when absent."""
    base = str(data_dir).rstrip("/")
    for ext, reader in (("parquet", lambda p: with_ingest_order(spark.read.parquet(p))), ("csv", lambda p: read_csv_table(spark, p))):
        path = f"{base}/{name}.{ext}"
        if _exists(spark, path):
            return reader(path)
    return None


def read_tickets(spark: SparkSession, data_dir: str) -> DataFrame:
    """The mandatory ticket table (S3), which must hold at least one row.

    CSV is parsed once and staged as Parquet, so that the many consumers read
    pruned columns instead of parsing the text again; whether it is empty shows
    on the staged files.
    """
    df = read_table(spark, data_dir, "tickets")
    if df is not None and not _exists(spark, f"{str(data_dir).rstrip('/')}/tickets.parquet"):
        df = stage(df)
    if df is None or df.isEmpty():
        raise FileNotFoundError(f"tickets was not found in {data_dir}")
    return df
