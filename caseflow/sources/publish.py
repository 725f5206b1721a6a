"""A set of outputs that appears as one.

The outputs of a run are written below ``<root>/versions/<version>``; the pointer file
``<root>/CURRENT`` names the version to read and is replaced when all of them are there.
A run that stops between two outputs leaves the pointer, and with it the last whole set.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from caseflow.sources import files

POINTER = "CURRENT"


class Publication:
    """A new version under ``root``; ``path`` is where its outputs go."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        # versions sort by the time they began
        self.version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        self.path = f"{self.root}/versions/{self.version}"

    def commit(self, keep: int | None = None) -> None:
        """Make this the version that readers get; with ``keep``, delete older ones but for the newest so many."""
        files.replace_text(self.spark, f"{self.root}/{POINTER}", self.version)
        if keep is not None:
            older = [v for v in files.folders(self.spark, f"{self.root}/versions") if v < self.version]
            for v in older[: max(len(older) - keep, 0)]:
                files.delete(self.spark, f"{self.root}/versions/{v}")


def current_version(spark: SparkSession, root: str) -> str | None:
    """The folder of the version to read, or None before the first one."""
    version = files.read_text(spark, f"{root.rstrip('/')}/{POINTER}")
    return f"{root.rstrip('/')}/versions/{version}" if version else None


def read_published(spark: SparkSession, root: str, names: list[str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """Tables of one version: the pointer is read once for all of them."""
    path = current_version(spark, root)
    if path is None:
        raise FileNotFoundError(f"nothing is published in {root}")
    return {n: spark.read.option("header", True).format(fmt).load(f"{path}/{n}") for n in names}
