"""Small files and folders of any Spark file system: texts, listings and renames for manifests and pointers."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it is missing."""
    p, fs = _path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def files_below(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """``(path, length, modification time)`` of every file below ``path``, sorted."""
    p, fs = _path(spark, path)
    found, out = fs.listFiles(p, True), []
    while found.hasNext():
        s = found.next()
        out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(out)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole small file, or None if it is missing."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _path(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write ``path`` so that a reader finds the old text or the new one, never a part: a new file is renamed over it."""
    fresh = f"{path}.{uuid.uuid4().hex}"
    write_text(spark, fresh, text)
    jvm = spark.sparkContext._jvm
    source, target = jvm.org.apache.hadoop.fs.Path(fresh), jvm.org.apache.hadoop.fs.Path(path)
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    files = jvm.org.apache.hadoop.fs.FileContext
    source = files.getFileContext(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(source)
    files.getFileContext(source.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(source, target, overwrite)


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Move a folder to a place that is free; False if another got there first."""
    p, fs = _path(spark, source)
    t, _ = _path(spark, target)
    if fs.exists(t):
        return False
    return fs.rename(p, t)
