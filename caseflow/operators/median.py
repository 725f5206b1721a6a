"""Exact per-group median that stays memory-bounded under skew.

Spark's exact ``median`` keeps a value->count map per group that cannot spill.
Here values are counted by (group, value) first, with map-side combine, which
spreads a hot group over all tasks.  The counts are summed per whole-number
bucket of the value; a running sum over a group's buckets finds the one or two
buckets that hold the middle ranks, and a running sum over the distinct values
inside these finds the median (the mean of the two middle values).  Only bucket
sums of a group meet in one task.  NULL values are ignored; a group of only NULLs
gets NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median", sums: dict[str, Column] | None = None) -> DataFrame:
    """``keys + sums + [out]``: one row per group; ``sums``: further expressions to add up per group."""
    keys, sums = list(keys), sums or {}
    v = F.col(value).cast("double")
    counted = df.select(*keys, v.alias("_v"), *[c.alias(n) for n, c in sums.items()]).groupBy(*keys, "_v").agg(
        F.count("_v").alias("_c"), *[F.sum(n).alias(n) for n in sums]
    ).withColumn("_b", F.floor("_v"))

    buckets = counted.groupBy(*keys, "_b").agg(F.sum("_c").alias("_c"), *[F.sum(n).alias(n) for n in sums])
    group = Window.partitionBy(*keys)
    upto = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = buckets.withColumns({"_n": F.sum("_c").over(group), "_to": F.sum("_c").over(upto)})
    lower, upper = F.floor((F.col("_n") - 1) / 2), F.ceil((F.col("_n") - 1) / 2)
    middle = F.col("_b").isNotNull() & (F.col("_to") > lower) & (F.col("_to") - F.col("_c") <= upper)
    # one row per group, with its one or two middle buckets
    groups = placed.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in sums], F.max("_n").alias("_n"),
        F.collect_list(F.when(middle, F.struct("_b", (F.col("_to") - F.col("_c")).alias("_from")))).alias("_mid"),
    )
    wanted = groups.select(*[F.col(k).alias(f"_g_{k}") for k in keys], F.col("_n"), *[n for n in sums], F.explode_outer("_mid").alias("_m"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_g_{k}"))
    inside = wanted.join(counted.drop(*sums), same & (F.col("_b") == F.col("_m._b")), "left")
    run = Window.partitionBy(*[f"_g_{k}" for k in keys], "_m._b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = inside.withColumn("_to", F.col("_m._from") + F.sum("_c").over(run))

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_to") > rank) & (F.col("_to") - F.col("_c") <= rank), F.col("_v")))

    found = ranked.groupBy(*[f"_g_{k}" for k in keys], "_n", *sums).agg(((at(lower) + at(upper)) / 2).alias(out))
    return found.select(*[F.col(f"_g_{k}").alias(k) for k in keys], *sums, out)
