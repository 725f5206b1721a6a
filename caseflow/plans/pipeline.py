"""Whole-pipeline wiring.

``build(...)`` returns lazy DataFrames for every output; nothing runs until a
sink or a caller acts.  The canonical enriched ticket table feeds eight
consumers, so callers that run several outputs should pass ``reuse=stage``
(Parquet in the shared folder, read with column pruning), or a function that
selects the columns it needs before staging.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from caseflow.operators.dedupe import canonical_tickets, duplicate_counters
from caseflow.operators.enrich import apply_policy_metrics
from caseflow.operators.goal import business_goal
from caseflow.operators.leaderboard import tier1_leaderboard
from caseflow.operators.metrics import category_metrics, channel_metrics, group_of, sources_of, weekly_metrics, weekly_of
from caseflow.operators.normalize import date_orders, elected_formats, normalize_tickets, unparsed_timestamps
from caseflow.operators.opportunity import opportunities
from caseflow.operators.quality import quality_report
from caseflow.operators.repeat import repeat_contacts
from caseflow.sources import fixtures
from caseflow.sources.policy import Policy, as_policy
from caseflow.sources.tables import read_table, read_tickets


class PipelineResult:
    """Lazy outputs of one pipeline run; each output is planned on first use."""

    def __init__(self, raw_tickets: DataFrame, agents, policy: Policy, reuse=None, timestamp_formats: Sequence[str] | None = None):
        """``agents``: the roster, ``None``, or a zero-argument callable giving
        either (read only if the leaderboard is used).  ``groups`` may be set to a staged
        :func:`all_groups` of the tickets; weekly, channel, category and quality tables
        then come from it instead of reading the tickets each."""
        self.groups: DataFrame | None = None
        self.policy = policy
        self._agents = agents
        formats = elected_formats(raw_tickets, timestamp_formats)
        self.raw = normalize_tickets(raw_tickets, formats)
        self._unparsed = lambda: unparsed_timestamps(raw_tickets, formats)
        self._orders = lambda: date_orders(raw_tickets)
        tickets = apply_policy_metrics(canonical_tickets(self.raw), policy)
        self.tickets = reuse(tickets) if reuse is not None else tickets

    @cached_property
    def unparsed(self) -> DataFrame:
        return self._unparsed()

    @cached_property
    def date_orders(self) -> DataFrame:
        return self._orders()

    @cached_property
    def counters(self) -> DataFrame:
        return duplicate_counters(self.raw)

    # Canonical tickets carry one row per id, so distinct id counts are plain counts.
    @cached_property
    def quality(self) -> DataFrame:
        return quality_report(self.raw, self.tickets, self.counters, sources_of(self.groups) if self.groups is not None else None)

    @cached_property
    def weekly_metrics(self) -> DataFrame:
        return weekly_metrics(self.tickets, ids_unique=True) if self.groups is None else weekly_of(self.groups)

    @cached_property
    def leaderboard(self) -> DataFrame:
        agents = self._agents() if callable(self._agents) else self._agents
        return tier1_leaderboard(self.tickets, agents, self.policy, ids_unique=True)

    @cached_property
    def repeat_contacts(self) -> DataFrame:
        return repeat_contacts(self.tickets)

    @cached_property
    def opportunities(self) -> DataFrame:
        return opportunities(self.tickets, self.repeat_contacts, self.policy, ids_unique=True)

    @cached_property
    def channel_metrics(self) -> DataFrame:
        return channel_metrics(self.tickets, self.policy, ids_unique=True) if self.groups is None else group_of(self.groups, "channel", self.policy)

    @cached_property
    def category_metrics(self) -> DataFrame:
        return category_metrics(self.tickets, self.policy, ids_unique=True) if self.groups is None else group_of(self.groups, "category", self.policy)

    @cached_property
    def business_goal(self) -> DataFrame:
        return business_goal(self.weekly_metrics, self.opportunities, self.policy)


def build(
    raw_tickets: DataFrame,
    agents,
    policy: Policy | dict | None = None,
    reuse: Callable[[DataFrame], DataFrame] | None = None,
    timestamp_formats: Sequence[str] | None = None,
) -> PipelineResult:
    return PipelineResult(raw_tickets, agents, as_policy(policy), reuse, timestamp_formats)


def run_pipeline(
    spark: SparkSession, data_dir: str, policy: Policy | dict | None = None, reuse=None, timestamp_formats: Sequence[str] | None = None
) -> PipelineResult:
    """From a folder holding tickets/agents as CSV or parquet."""
    tickets = read_tickets(spark, data_dir)
    return build(tickets, lambda: read_table(spark, data_dir, "agents"), policy, reuse, timestamp_formats)


def from_driver_tables(spark: SparkSession, sf_dir: str, policy: Policy | dict | None = None, reuse=None) -> PipelineResult:
    """From the driver's parquet tables through the FX3 ticket/roster views."""
    return build(
        fixtures.raw_tickets(spark, sf_dir),
        lambda: fixtures.agents(spark, sf_dir),
        policy,
        reuse,
    )


def from_edge_tables(spark: SparkSession, sf_dir: str, reuse=None) -> PipelineResult:
    """From views of the driver's tables that reach the rare cases."""
    return build(fixtures.edge_tickets(spark, sf_dir), lambda: fixtures.edge_agents(spark, sf_dir), None, reuse)
