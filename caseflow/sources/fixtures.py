"""Ticket-shaped views over the driver's TPC-H-like tables.

The driver tables hold no tickets, so ``orders`` becomes tickets from two
source systems and ``supplier`` becomes the agent roster, by fixed integer
arithmetic on the keys (FIXTURES.md FX3).  ``documents`` + ``labels`` become
ticket texts for the themes (FX4).  These are views: all further work
(normalisation, de-duplication, enrichment, marts) is the engine's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.sources.tables import INGEST_COL


#: Session setting with which a caller spreads inputs of one row group; unset: no shuffle is added.
SPREAD_CONF = "spark.caseflow.inputPartitions"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _spread(df: DataFrame) -> DataFrame:
    n = df.sparkSession.conf.get(SPREAD_CONF, None)
    return df.repartition(int(n)) if n else df


def _add_minutes(ts: Column, n: Column) -> Column:
    return F.timestamp_add("MINUTE", n, ts)


def _prefixed(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def _unless(cond: Column, value: Column) -> Column:
    """``CASE WHEN NOT cond THEN value END``."""
    return F.when(~cond, value)


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX3 raw tickets: helpdesk rows plus legacy_fd copies (some ids in both)."""
    o = _spread(_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"
    ))
    k = F.col("o_orderkey")
    base = o.select(
        k.alias("k"),
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        _add_minutes(F.col("o_orderdate"), ((k * 37) % 1440).cast("int")).alias("created_at"),
        ((k * 7) % 540 + (F.year("o_orderdate") - 1995) * 12 - 20).cast("int").alias("fr_off"),
        ((k * 13) % 5000 - 60).cast("int").alias("rs_off"),
    )
    k = F.col("k")
    keyed = base.select(
        "*",
        _prefixed("T", k).alias("ticket_id"),
        F.when(F.col("o_orderstatus") == "F", "Resolved")
        .when(F.col("o_orderstatus") == "P", "closed")
        .otherwise("open")
        .alias("status"),
        F.element_at(F.array(*[F.lit(c) for c in ("chat", "Email", "voice", "social", "whatsapp")]), (k % 5 + 1).cast("int")).alias("channel"),
        _prefixed("C", F.col("o_custkey")).alias("customer_id"),
        _prefixed("O", k).alias("order_id"),
        (k % 4).cast("double").alias("transfers"),
    )
    team = (
        F.when(k % 20 == 0, "Chat Frontline")
        .when(k % 20 == 6, "Email Frontline")
        .when(k % 20 == 12, "Voice Frontline")
        .otherwise("Warranty")
    )
    helpdesk = F.when(k % 11 != 3, F.struct(
        "ticket_id",
        "created_at",
        _unless(k % 17 == 0, _add_minutes(F.col("created_at"), F.col("fr_off"))).alias("first_response_at"),
        _unless(k % 23 == 0, _add_minutes(F.col("created_at"), F.col("rs_off"))).alias("resolved_at"),
        "status",
        "channel",
        "customer_id",
        "order_id",
        _unless(k % 29 == 0, F.col("o_orderpriority")).alias("category"),
        team.alias("assigned_team"),
        _unless(k % 31 == 0, _prefixed("A", k % 100)).alias("agent_id"),
        "transfers",
        _unless(k % 6 == 0, (k % 6).cast("double")).alias("csat_score"),
        F.lit("helpdesk").alias("source_system"),
        (k * 2).alias(INGEST_COL),
    ))
    legacy = F.when((k % 11 == 3) | (k % 10 == 0), F.struct(
        "ticket_id",
        "created_at",
        F.lit(None).cast("timestamp_ntz").alias("first_response_at"),
        _unless(k % 23 == 0, _add_minutes(F.col("created_at"), F.col("rs_off") - 2000)).alias("resolved_at"),
        "status",
        "channel",
        "customer_id",
        "order_id",
        F.lit(None).cast("string").alias("category"),
        F.lit("Chat Frontline").alias("assigned_team"),
        F.lit(None).cast("string").alias("agent_id"),
        "transfers",
        F.lit(None).cast("double").alias("csat_score"),
        F.lit("legacy_fd").alias("source_system"),
        (k * 2 + 1).alias(INGEST_COL),
    ))
    copies = F.filter(F.array(helpdesk, legacy), lambda c: c.isNotNull())
    return keyed.select(F.inline(copies))


def agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX3 roster from ``supplier``."""
    s = F.col("s_suppkey")
    return _table(spark, sf_dir, "supplier").select(
        _prefixed("A", s).alias("agent_id"),
        F.col("s_name").alias("name"),
        F.when(s % 4 == 0, "Chat Frontline")
        .when(s % 4 == 1, "Email Frontline")
        .when(s % 4 == 2, "Voice Frontline")
        .otherwise("Warranty")
        .alias("team"),
        F.when(s % 3 == 0, "Tier 1").when(s % 3 == 1, "1").otherwise("Tier 2").alias("tier"),
        s.alias(INGEST_COL),
    )


def document_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FX4: ``documents`` as ticket texts; csat from ``labels`` (left join on doc_id).

    ``labels`` covers a subset of documents and grows with them, so this is a
    plain equi-join and Spark/AQE choose the strategy from measured sizes.
    """
    d = _spread(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    lab = _table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = d.join(lab, "doc_id", "left")
    doc = F.col("doc_id")
    return j.select(
        _prefixed("D", doc).alias("ticket_id"),
        F.col("text").alias("customer_message"),
        F.lit("").alias("agent_notes"),
        F.col("lang").alias("category"),
        (doc % 4).cast("double").alias("transfers"),
        (F.lit(1.0) + F.lit(4.0) * F.col("quality").cast("double")).alias("csat_score"),
        (doc % 3 == 0).alias("sla_breach"),
    )


def edge_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets from ``orders`` that reach the rare cases: missing and padded ids, repeated
    rows of one source, missing times and customers, a zero csat, few weeks."""
    k = F.col("o_orderkey")
    created = _add_minutes(F.lit("2024-01-01").cast("timestamp_ntz"), ((k * 61) % 25920).cast("int"))
    rows = _spread(_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")).select(
        _unless(k % 97 == 5, F.when(k % 13 == 1, F.concat(F.lit("  T"), k.cast("string"), F.lit(" "))).otherwise(_prefixed("T", k))).alias("ticket_id"),
        _unless(k % 41 == 7, created).alias("created_at"),
        _add_minutes(created, (k % 300 - 3).cast("int")).alias("first_response_at"),
        _add_minutes(created, ((k * 13) % 5000 - 60).cast("int")).alias("resolved_at"),
        F.when(k % 3 == 0, " Resolved").otherwise("open").alias("status"),
        F.element_at(F.array(*[F.lit(c) for c in ("chat", " Email ", "voice")]), (k % 3 + 1).cast("int")).alias("channel"),
        _unless(k % 37 == 6, _prefixed("C", F.col("o_custkey") % 50)).alias("customer_id"),
        _prefixed("O", k).alias("order_id"),
        F.col("o_orderpriority").alias("category"),
        F.lit("Email Frontline").alias("assigned_team"),
        _unless(k % 31 == 0, _prefixed("A", k % 20)).alias("agent_id"),
        (k % 4).cast("double").alias("transfers"),
        (k % 6).cast("double").alias("csat_score"),
        _unless(k % 43 == 2, F.lit("helpdesk")).alias("source_system"),
        (k * 2).alias(INGEST_COL),
        k.alias("k"),
    )
    # a second row of the same source, less complete and read later
    copies = F.when(F.col("k") % 19 == 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    both = rows.withColumn("_copy", F.explode(copies))
    again = F.col("_copy") == 1
    return both.withColumns({"category": _unless(again & (F.col("k") % 2 == 0), F.col("category")), INGEST_COL: F.col(INGEST_COL) + F.col("_copy")}).drop("_copy", "k")


def edge_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A roster with repeated and missing agent ids."""
    s = F.col("s_suppkey")
    base = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    return base.select(
        _unless(s % 11 == 3, _prefixed("A", s % 20)).alias("agent_id"),
        F.col("s_name").alias("name"),
        F.when(s % 2 == 0, "Chat Frontline").alias("team"),
        F.when((s + F.col("_copy")) % 3 == 0, "Tier 2").otherwise(" TIER 1 ").alias("tier"),
        (s * 2 + F.col("_copy")).alias(INGEST_COL),
    )


def spelled_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` dates written in many spellings (and some that are none), with the instant that is meant."""
    k = F.col("o_orderkey")
    at = _add_minutes(F.col("o_orderdate"), ((k * 37) % 1440).cast("int"))
    text = lambda fmt: F.date_format(at, fmt)
    spellings = [
        text("yyyy-MM-dd HH:mm:ss"), text("yyyy-MM-dd'T'HH:mm:ss'Z'"), text("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), text("yyyy-MM-dd'T'HH:mm:ss'+00:00'"),
        F.date_format(_add_minutes(at, F.lit(330)), "yyyy-MM-dd'T'HH:mm:ss'+05:30'"), text("MM/dd/yyyy HH:mm"), text("yyyy-MM-dd hh:mm:ss a"),
        F.concat(text("yyyy-MM-dd HH:mm:ss"), F.lit(".000000001")), text("MMM d, yyyy HH:mm"), F.concat(F.lit("  "), text("yyyy/MM/dd HH:mm"), F.lit(" ")),
        F.lit("not a date"), F.lit(" "),
    ]
    return _spread(_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")).select(
        _prefixed("T", k).alias("ticket_id"), F.element_at(F.array(*spellings), (k % len(spellings) + 1).cast("int")).alias("created_at")
    )


def ordered_date_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` dates as slashed text: day first, month first, days up to 12 only (which tell no order), and a few of the other order."""
    k = F.col("o_orderkey")
    at = _add_minutes(F.col("o_orderdate"), ((k * 37) % 1440).cast("int"))
    low = _add_minutes(F.trunc("o_orderdate", "month").cast("timestamp_ntz"), ((k % 12) * 1440 + (k * 37) % 1440).cast("int"))
    day, month = (lambda c: F.date_format(c, "dd/MM/yyyy HH:mm")), (lambda c: F.date_format(c, "MM/dd/yyyy HH:mm"))
    return _spread(_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")).select(
        _prefixed("T", k).alias("ticket_id"), F.when(k % 50 == 1, month(at)).otherwise(day(at)).alias("created_at"),
        month(low).alias("first_response_at"), month(at).alias("resolved_at"),
    )
