"""Summarise the physical plan of every catalogued query (docs/PLANS.md).

usage: python tools/plan_summary.py [sf_dir] > docs/PLANS.md
For each query: shuffles (Exchange), broadcasts, join strategies, partial
aggregates, partial window limits and the parquet scans' read schemas.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from caseflow.plans.catalog import queries  # noqa: E402
from caseflow.session import get_spark  # noqa: E402


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def summarise(text: str) -> dict[str, str]:
    exchanges = re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)\(([^)]*)", text)
    shuffles = [f"{kind}({re.sub(r'#\\d+L?', '', keys).split(', ')[0] if keys else ''}…)" if kind != "SinglePartition" else "single" for kind, keys in exchanges]
    single = text.count("Exchange SinglePartition")
    return {
        "shuffles": str(len(exchanges) + single),
        "broadcasts": str(text.count("BroadcastExchange")),
        "joins": ", ".join(sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)", text)))) or "-",
        "partial aggs": str(len(re.findall(r"(?:HashAggregate|ObjectHashAggregate|SortAggregate)\(keys=\[[^\]]*\], functions=\[partial_", text))),
        "partial window limits": str(text.count("WindowGroupLimit") // 2),
        "scans": str(text.count("FileScan parquet")),
    }


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    cols = ["shuffles", "broadcasts", "joins", "partial aggs", "partial window limits", "scans"]
    print("# Physical plans (initial AQE plans, sf0.01)\n")
    print("Generated by `tools/plan_summary.py`. Shuffles counts every Exchange; \"partial window limits\" are")
    print("`WindowGroupLimit` pairs (partial before the shuffle, final after); a staged input shows as a parquet")
    print("scan of its own.")
    print("")
    print("- Queries with several branches read staged tables here: the stages before the staging are not shown.")
    print("- Initial plans print an exchange once per branch; identical ones are reused at run time.\n")
    print("| query | " + " | ".join(cols) + " |")
    print("|---|" + "---|" * len(cols))
    for name, fn in queries().items():
        s = summarise(plan_text(fn(spark, sf)))
        print(f"| {name} | " + " | ".join(s[c] for c in cols) + " |")


if __name__ == "__main__":
    main()
