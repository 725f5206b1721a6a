"""Results kept across sessions in shared storage.

A result set is named by a key: a hash of the input files (path, length, modification
time), of the policy, the options and this package's code.  Its tables lie in
``<root>/<key>/<name>``, written aside and renamed, so a table is whole or absent and of
two sessions that build it one wins.  A manifest tells what the key stands for and when
it was last used; beyond ``keep`` sets the least recently used go.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Callable
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from caseflow.operators.metrics import all_groups
from caseflow.plans.pipeline import PipelineResult, run_pipeline
from caseflow.session import ensure_checkpoint_dir, stage
from caseflow.sources import files
from caseflow.sources.policy import Policy, as_policy

KEEP = 8
OUTPUTS: dict[str, Callable[[PipelineResult], DataFrame]] = {
    "tickets": lambda r: r.tickets,
    "quality": lambda r: r.quality,
    "weekly_metrics": lambda r: r.weekly_metrics,
    "channel_metrics": lambda r: r.channel_metrics,
    "category_metrics": lambda r: r.category_metrics,
    "repeat_contacts": lambda r: r.repeat_contacts,
    "opportunities": lambda r: r.opportunities,
    "leaderboard": lambda r: r.leaderboard,
    "business_goal": lambda r: r.business_goal,
}


@cache
def code_version() -> str:
    """Hash of the sources that results depend on."""
    folder = Path(__file__).resolve().parents[1]
    digest = hashlib.sha256()
    for path in sorted(folder.rglob("*.py")):
        if path.relative_to(folder).parts[0] != "llm":
            digest.update(str(path.relative_to(folder)).encode() + b"\0" + path.read_bytes())
    return digest.hexdigest()


class ResultCache:
    def __init__(self, spark: SparkSession, root: str | None = None, keep: int = KEEP):
        self.spark, self.keep = spark, keep
        self.root = (root or f"{ensure_checkpoint_dir(spark)}/results").rstrip("/")

    def key(self, data_dir: str, *parts: object) -> str:
        """Names the results of the files below ``data_dir`` under ``parts``; reads listings only."""
        named = [files.files_below(self.spark, data_dir), [repr(p) for p in parts], code_version()]
        return hashlib.sha256(json.dumps(named).encode()).hexdigest()[:32]

    def table(self, key: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """The kept table, or what ``build`` gives, kept from now on."""
        path = f"{self.root}/{key}/{name}"
        if not files.exists(self.spark, path):
            aside = f"{self.root}/{key}/_{name}-{uuid.uuid4().hex}"
            build().write.parquet(aside)
            if not files.rename(self.spark, aside, path):
                files.delete(self.spark, aside)
        return self.spark.read.parquet(path)

    def used(self, key: str, meaning: dict) -> None:
        """Note the use of a set and evict those that were not used for longest."""
        manifest = meaning | {"key": key, "used": time.time()}
        files.replace_text(self.spark, f"{self.root}/{key}/manifest.json", json.dumps(manifest, default=str))
        found = []
        for other in files.folders(self.spark, self.root):
            text = files.read_text(self.spark, f"{self.root}/{other}/manifest.json")
            if text is not None:  # a set without one is being built
                found.append((json.loads(text)["used"], other))
        for _, old in sorted(found, reverse=True)[self.keep :]:
            files.delete(self.spark, f"{self.root}/{old}")


def cached_outputs(
    spark: SparkSession, data_dir: str, policy: Policy | dict | None = None, timestamp_formats: tuple[str, ...] | None = None, cache: ResultCache | None = None
) -> dict[str, DataFrame]:
    """All tables of the pipeline over ``data_dir``; with unchanged files, policy and code they are read as they were kept."""
    cache, policy = cache or ResultCache(spark), as_policy(policy)
    key = cache.key(data_dir, json.dumps(policy.raw, sort_keys=True, default=str), timestamp_formats)
    built: list[PipelineResult] = []

    def result() -> PipelineResult:
        if not built:
            built.append(run_pipeline(spark, data_dir, policy, reuse=stage, timestamp_formats=timestamp_formats))
            built[0].groups = stage(all_groups(built[0].tickets))
        return built[0]

    out = {name: cache.table(key, name, lambda get=get: get(result())) for name, get in OUTPUTS.items()}
    cache.used(key, {"data_dir": data_dir, "tables": list(OUTPUTS)})
    return out
