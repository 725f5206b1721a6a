"""Policy source (S4): a small driver-side configuration.

The policy is a handful of keys, bounded by configuration and not by data, so
its lookups become literal map expressions evaluated inside codegen instead of
joins.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession

from caseflow.fixed import DEFAULT_POLICY


@dataclass(frozen=True)
class Policy:
    raw: dict[str, Any] = field(default_factory=dict)

    @classmethod
    def default(cls) -> "Policy":
        return cls(json.loads(json.dumps(DEFAULT_POLICY)))

    @classmethod
    def from_file(cls, path: str | Path, spark: SparkSession | None = None) -> "Policy":
        """YAML or JSON; with a session, from any file system that Spark can read."""
        if spark is None:
            text = Path(path).read_text(encoding="utf-8")
        else:
            text = spark.read.text(str(path), wholetext=True).first()["value"]
        if str(path).endswith(".json"):
            return cls(json.loads(text) or {})
        try:
            import yaml
        except ImportError as exc:  # pragma: no cover - yaml is baked in
            raise RuntimeError("PyYAML is needed to read a YAML policy") from exc
        return cls(yaml.safe_load(text) or {})

    def get(self, key: str, default: Any = None) -> Any:
        return self.raw.get(key, default)

    # Lookups: keys lower-cased (not trimmed), values as float.
    def sla_minutes(self) -> dict[str, float]:
        return {str(k).lower(): float(v) for k, v in (self.get("first_response_sla_minutes") or {}).items()}

    def contact_costs(self) -> dict[str, float]:
        return {str(k).lower(): float(v) for k, v in (self.get("contact_cost_inr") or {}).items()}

    def number(self, key: str, default: float) -> float:
        return float(self.get(key, default))

    def eligible_tiers(self) -> list[str]:
        tiers = self.get("eligible_leaderboard_tiers", ["Tier 1"])
        return sorted({str(v).lower().strip() for v in tiers})


def as_policy(policy: Policy | dict[str, Any] | None) -> Policy:
    """``None`` is the shipped policy everywhere; ``{}`` is an empty one."""
    if policy is None:
        return Policy.default()
    if isinstance(policy, Policy):
        return policy
    return Policy(dict(policy))
