"""Conversations as ordered turns, and keys of their prefixes.

A turn's place comes from two levels: rows are counted per (conversation, run of
``RUN`` turn numbers), the counts give each run's offset, and a window ranks the
rows of one run only, so a conversation of any length is dealt to many tasks.
Running sums along a conversation are made the same way.

The key of a prefix is 128 bits: every turn gives two 64-bit hashes of its place and
of the SHA-256 of its role and text, and the key is the MD5 of both exact sums and the
depth.  Sums need no chain, hence the two levels.  Equal prefixes have equal keys; that
different ones do not is as certain as 128 bits make it.

Order: ``turn``, nulls first; turns with one number by the hash of their role and text,
so that any row order gives the same conversation.  Null roles and texts are empty.
Rows of one conversation whose turn numbers fall into one run (or are all null) are
ranked in one task, by a window that spills.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RUN = 1024
#: Words of a text: ``[^\x20\x09-\x0D]+``.
WORD = r"[^ \t\n\x0B\f\r]+"


def running(df: DataFrame, group: list[str], order: str, values: list[str]) -> DataFrame:
    """``df`` with each of ``values`` replaced by its inclusive running sum in ``group``, in the order of the distinct integers ``order``."""
    cut = df.withColumn("_run", F.expr(f"`{order}` div {RUN}"))
    sums = cut.groupBy(*group, "_run").agg(*[F.sum(v).alias(v) for v in values])
    before = Window.partitionBy(*group).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, "_run", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_before_{v}") for v in values])
    upto = Window.partitionBy(*group, "_run").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = cut.withColumns({v: F.sum(v).over(upto) for v in values}).join(offsets, [*group, "_run"])
    return inside.withColumns({v: F.col(v) + F.col(f"_before_{v}") for v in values}).drop("_run", *[f"_before_{v}" for v in values])


def ordered_turns(turns: DataFrame) -> DataFrame:
    """``turns(conv_id, turn, a, b, ...)`` with ``at``, the place from 0 in its conversation, in place of ``turn``; ids are not null."""
    cut = turns.withColumn("_run", F.expr(f"turn div {RUN}"))
    sizes = cut.groupBy("conv_id", "_run").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("_run")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("conv_id").alias("_c"), F.col("_run").alias("_r"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy("conv_id", "_run").orderBy(F.asc_nulls_first("turn"), "a", "b")) - 1
    placed = cut.withColumn("_rank", rank).join(offsets, (F.col("conv_id") == F.col("_c")) & F.col("_run").eqNullSafe(F.col("_r")))
    return placed.withColumn("at", (F.col("_before") + F.col("_rank")).cast("long")).drop("turn", "_run", "_r", "_c", "_before", "_rank")


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def turn_hashes(role: Column, text: Column) -> list[Column]:
    """``a`` and ``b``: 120 bits of the SHA-256 of a role and a text."""
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return [F.conv(F.substring(digest, i, 15), 16, 10).cast("long").alias(name) for i, name in ((1, "a"), (16, "b"))]


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def _key(depth: Column, a: Column, b: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), a.cast("string"), b.cast("string")).cast("binary")))


ROOT_DEPTH = 0


def root_key() -> Column:
    return _key(F.lit(ROOT_DEPTH), F.lit(0), F.lit(0))


def prefix_keys(turns: DataFrame, totals: list[str]) -> DataFrame:
    """``(conv_id, d, key, parent_key, ...)`` of every prefix of ``turns(conv_id, at, a, b, ...)``; ``totals`` gain running sums named ``sum_*``."""
    wide = "decimal(20,0)"
    marks = turns.withColumns({
        "_a": F.xxhash64("at", "a", "b").cast(wide),
        "_b": F.xxhash64(F.lit(1), "b", "a", "at").cast(wide),
        **{f"sum_{t}": F.col(t) for t in totals},
    }).withColumns({"_own_a": F.col("_a"), "_own_b": F.col("_b")})
    summed = running(marks, ["conv_id"], "at", ["_a", "_b", *[f"sum_{t}" for t in totals]])
    depth = F.col("at") + 1
    return summed.select(
        "conv_id", depth.alias("d"),
        _key(depth, F.col("_a").cast("decimal(38,0)"), F.col("_b").cast("decimal(38,0)")).alias("key"),
        _key(F.col("at"), (F.col("_a") - F.col("_own_a")).cast("decimal(38,0)"), (F.col("_b") - F.col("_own_b")).cast("decimal(38,0)")).alias("parent_key"),
        *[c for t in totals for c in (t, f"sum_{t}")],
    )


def each_depth(df: DataFrame, low: str, high: str) -> DataFrame:
    """A row for every depth ``d`` from ``low`` (not negative) to ``high``, both included, made in two steps so that no array is long."""
    part = F.explode(F.sequence(F.expr(f"`{low}` div {RUN}"), F.expr(f"`{high}` div {RUN}")))
    parts = df.where(F.col(low) <= F.col(high)).withColumn("_part", part)
    start, end = F.greatest(F.col(low), F.col("_part") * RUN), F.least(F.col(high), F.col("_part") * RUN + RUN - 1)
    return parts.withColumn("d", F.explode(F.sequence(start.cast("long"), end.cast("long")))).drop("_part")
