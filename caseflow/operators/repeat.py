"""Repeat contacts.

The previous contact of a customer is a ``lag`` by (created_at, ticket_id).
A plain ``Window.partitionBy("customer_id")`` would put every row of a very
large customer (a shared mailbox, a placeholder id) into one task, and many of
its rows may even share one instant (date-only or batch-stamped times).  So no
window sees rows of tickets:

1. rows are counted per (customer, instant), with map-side combine; the smallest
   content hash of the first ticket id at the instant is kept;
2. distinct instants are lagged within time buckets, and the last instant of each
   bucket across buckets, a number bounded by the calendar span;
3. the row that is first at its instant gets the previous instant; every other
   row of the instant has a predecessor at the same instant.

The result is exact for any bucket size.  Missing ticket ids sort last.  Input is the
canonical table, with one row per ticket id.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseflow.functions.columns import days_between, true_or_false

_EPOCH = dt.datetime(1970, 1, 1)
_BUCKET = "_time_bucket"
DEFAULT_BUCKET_SECONDS = 3600


def in_reading_order(contacts: DataFrame) -> DataFrame:
    """By customer and time; contacts of one instant by id, a missing one last."""
    return contacts.orderBy("customer_id", "created_at", F.asc_nulls_last("ticket_id"))


def repeat_contacts(df: DataFrame, window_days: float = 7.0, bucket_seconds: int = DEFAULT_BUCKET_SECONDS) -> DataFrame:
    """Columns: ticket_id, customer_id, created_at, category, order_id,
    prior_contact_at, days_since_prior_contact, repeat_contact_7d.

    Rows without customer or creation time are left out (F2).  The output is
    not sorted; see :func:`in_reading_order`.
    """
    seconds = F.timestamp_diff("SECOND", F.lit(_EPOCH).cast("timestamp_ntz"), F.col("created_at"))
    x = (
        df.select("ticket_id", "customer_id", "created_at", "category", "order_id")
        .filter(F.col("customer_id").isNotNull() & F.col("created_at").isNotNull())
        .withColumn(_BUCKET, F.floor(seconds / F.lit(bucket_seconds)))
    )
    keys = ["customer_id", _BUCKET]
    instant = [*keys, "created_at"]

    # the first ticket of an instant: the smallest id, a missing id last; rows that
    # are equal in it (repeated ids) are told apart by their other columns
    rank = F.struct(F.col("ticket_id").isNull().alias("m"), F.col("ticket_id").alias("i"), F.xxhash64("category", "order_id").alias("h"))
    instants = x.groupBy(*instant).agg(F.min(rank).alias("_first"))
    buckets = instants.groupBy(*keys).agg(F.max("created_at").alias("_bucket_last"))
    carried = buckets.select(
        *keys,
        F.lag("_bucket_last").over(Window.partitionBy("customer_id").orderBy(_BUCKET)).alias("_carry"),
    )
    in_bucket = Window.partitionBy(*keys).orderBy("created_at")
    lagged = instants.withColumn("_local", F.lag("created_at").over(in_bucket)).join(carried, keys, "left")
    lagged = lagged.select(*instant, "_first", F.coalesce("_local", "_carry").alias("_before"))

    joined = x.join(lagged, instant)
    prior = F.when(rank.eqNullSafe(F.col("_first")), F.col("_before")).otherwise(F.col("created_at"))
    days = days_between(prior, F.col("created_at"))
    return joined.select(
        "ticket_id",
        "customer_id",
        "created_at",
        "category",
        "order_id",
        prior.alias("prior_contact_at"),
        days.alias("days_since_prior_contact"),
        true_or_false(days.between(0, window_days)).alias("repeat_contact_7d"),
    )
