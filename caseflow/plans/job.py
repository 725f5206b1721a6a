"""Batch job (S7): ``spark-submit -m caseflow.plans.job --data-dir ... --output-dir ...``.

Reads tickets/agents (CSV or parquet), runs the pipeline, writes the seven
tables and the two JSON reports, and prints the reports.  The canonical
ticket table is staged once as Parquet below ``spark.checkpoint.dir`` (shared
storage on a cluster) because eight outputs read it, each with the columns it
needs; that also cuts lineage, so a lost executor never forces a re-read of the
raw input.  Staged files are deleted when the job ends.
With ``--versioned`` the outputs of a run appear together or not at all.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from caseflow.functions.columns import week_start
from caseflow.operators.goal import goal_as_dict
from caseflow.operators.metrics import all_groups
from caseflow.operators.quality import quality_as_dict
from caseflow.operators.themes import complaint_themes
from caseflow.plans.pipeline import PipelineResult, run_pipeline
from caseflow.session import drop_staged, get_spark, stage
from caseflow.sources.policy import Policy
from caseflow.sources.publish import Publication
from caseflow.sources.sinks import write_json_report, write_table

TABLE_OUTPUTS = {
    "weekly_metrics": lambda r, themes: r.weekly_metrics,
    "complaint_themes": lambda r, themes: themes,
    "tier1_leaderboard": lambda r, themes: r.leaderboard,
    "business_opportunities": lambda r, themes: r.opportunities,
    "channel_metrics": lambda r, themes: r.channel_metrics,
    "category_metrics": lambda r, themes: r.category_metrics,
}


#: Older versions that stay for readers which opened them.
KEEP_VERSIONS = 3


def reports(result: PipelineResult) -> tuple[dict, dict]:
    """The two report objects (few-row results collected on the driver)."""
    quality = quality_as_dict(result.quality.collect())
    goal = goal_as_dict(result.business_goal)
    return quality, goal


def repeat_contacts_by_week(result: PipelineResult):
    return result.repeat_contacts.withColumn("week_start", week_start("created_at").cast("date"))


def run(
    spark: SparkSession, data_dir: str, policy_path: str | None, output_dir: str, fmt: str = "parquet", timestamp_formats: tuple[str, ...] | None = None,
    versioned: bool = False,
) -> dict:
    """``versioned``: the outputs appear together, as a version that ``CURRENT`` in ``output_dir`` names at the end."""
    policy = Policy.from_file(policy_path, spark) if policy_path else Policy.default()
    try:
        result = run_pipeline(spark, data_dir, policy, reuse=stage, timestamp_formats=timestamp_formats)
        result.groups = stage(all_groups(result.tickets))  # one reading for four outputs
        themes = complaint_themes(result.tickets)
        publication = Publication(spark, output_dir) if versioned else None
        out = publication.path if publication else output_dir.rstrip("/")
        for name, get in TABLE_OUTPUTS.items():
            write_table(get(result, themes), f"{out}/{name}", fmt)
        # the one output that grows with the tickets: by week, each file in the order of reading
        write_table(repeat_contacts_by_week(result), f"{out}/repeat_contacts_proxy", fmt, ["week_start"], ["customer_id", "created_at", "ticket_id"])
        quality, goal = reports(result)
        quality["timestamp_parsing"] = {r["column"]: {"values": r["values"], "unparsed": r["unparsed"]} for r in result.unparsed.collect()}
        quality["timestamp_date_order"] = {r["column"]: r["date_order"] for r in result.date_orders.collect()}
        write_json_report(spark, quality, f"{out}/data_quality.json")
        write_json_report(spark, goal, f"{out}/business_goal.json")
        if publication:
            publication.commit(KEEP_VERSIONS)
    finally:
        drop_staged(spark)
    return {"data_quality": quality, "business_goal": goal}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Support-ticket analytics batch job")
    parser.add_argument("--data-dir", default="data")
    parser.add_argument("--policy", default=None)
    parser.add_argument("--output-dir", default="outputs")
    parser.add_argument("--format", default="parquet", choices=["parquet", "csv", "json", "orc"])
    parser.add_argument("--master", default=None)
    parser.add_argument("--versioned", action="store_true", help="publish all outputs together, below versions/ with the pointer file CURRENT")
    parser.add_argument("--timestamp-format", action="append", help="a Spark datetime pattern, tried after the ISO spellings; may be repeated")
    args = parser.parse_args(argv)
    spark = get_spark(args.master)
    formats = tuple(args.timestamp_format) if args.timestamp_format else None
    summary = run(spark, args.data_dir, args.policy, args.output_dir, args.format, formats, args.versioned)
    print(json.dumps(summary, indent=2, default=str, ensure_ascii=False))


if __name__ == "__main__":
    main()
