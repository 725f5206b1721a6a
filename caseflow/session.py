"""Spark session and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_spark(
    master: str | None = None,
    app_name: str = "caseflow",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the engine assumes (UTC, AQE, no UI)."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a scratch one only in local mode.

    On a cluster ``spark.checkpoint.dir`` must name shared storage; it is read
    from the session and never replaced.  Only a local session without the
    setting (tests, laptops) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if sc.master.startswith("local-cluster") or not sc.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder before running on a cluster")
    path = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    spark.conf.set(CHECKPOINT_CONF, path)
    return path


def staging_root(spark: SparkSession) -> str:
    """This application's folder for staged tables, below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/staged-{spark.sparkContext.applicationId}"


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts lineage like a checkpoint, but readers get column pruning and filter
    pushdown, and the files are compressed.  The application's staging folder
    is deleted when the JVM ends, or earlier by :func:`drop_staged`.
    """
    spark = df.sparkSession
    root = staging_root(spark)
    path = f"{root}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(jvm_path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage(df: DataFrame) -> None:
    """Delete the files of one table that :func:`stage` gave; it must not be read again."""
    spark = df.sparkSession
    for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
        jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)


def drop_staged(spark: SparkSession) -> None:
    """Delete every table that :func:`stage` wrote in this application."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging_root(spark))
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)
