"""Normalisation (P1-P6): complete the ticket schema and coerce types.

Works on all-string CSV input and on typed inputs alike: strings are parsed
with coercion (bad values become NULL), typed columns are only cast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.fixed import NUMERIC_COLUMNS, STRIPPED_COLUMNS, TEXT_COLUMNS, TICKET_COLUMNS, TIMESTAMP_COLUMNS
from caseflow.functions.columns import (
    DAY_FIRST_FORMATS,
    DEFAULT_TIMESTAMP_FORMATS,
    SLASHED_RE,
    clean_text,
    nan_to_null,
    parse_number,
    parse_timestamp,
    strip_ws,
)


def complete_schema(df: DataFrame, columns: Sequence[tuple[str, str]] = TICKET_COLUMNS) -> DataFrame:
    """Add each missing column as a typed NULL; extra columns are kept."""
    missing = {name: F.lit(None).cast(dtype) for name, dtype in columns if name not in df.columns}
    return df.withColumns(missing) if missing else df


def _as_timestamp(schema: T.StructType, name: str, formats: Sequence[str]) -> Column:
    dtype = schema[name].dataType
    c = F.col(name)
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    return parse_timestamp(c, formats)


def _as_number(schema: T.StructType, name: str) -> Column:
    dtype = schema[name].dataType
    if isinstance(dtype, T.NumericType):
        return nan_to_null(F.col(name).cast("double"))
    return parse_number(F.col(name))


def _text_timestamps(raw: DataFrame) -> list[str]:
    return [n for n in TIMESTAMP_COLUMNS if n in raw.columns and isinstance(raw.schema[n].dataType, T.StringType)]


def date_orders(raw: DataFrame) -> DataFrame:
    """The order of day and month in the slashed dates of each text column of timestamps.

    ``column, slashed, day_first, month_first, date_order``: the number of dates like
    ``a/b/yyyy``, of those that only the one or the other order can read, and the order
    that the column's dates elect together: ``month first`` or ``day first`` by the greater
    number, ``ambiguous`` if no date tells (read month first) and ``none`` without such dates.
    One reading, one aggregate.
    """
    names = _text_timestamps(raw)
    counts = []
    for n in names:
        text = strip_ws(n)
        # nothing but a slashed date has a number here, and null compares as unknown
        a, b = (F.regexp_extract(text, SLASHED_RE, i).try_cast("int") for i in (1, 2))
        counts.append(F.struct(
            F.lit(n).alias("column"), F.count_if(text.rlike(SLASHED_RE)).alias("slashed"),
            F.count_if((a > 12) & (b <= 12)).alias("day_first"), F.count_if((a <= 12) & (b > 12)).alias("month_first"),
        ))
    empty = F.array().cast("array<struct<column:string,slashed:bigint,day_first:bigint,month_first:bigint>>")
    rows = raw.agg((F.array(*counts) if counts else F.first(empty)).alias("c")).select(F.inline("c"))
    day, month = F.col("day_first"), F.col("month_first")
    order = F.when(F.col("slashed") == 0, "none").when(day + month == 0, "ambiguous").when(day > month, "day first").otherwise("month first")
    return rows.withColumn("date_order", order)


def elected_formats(raw: DataFrame, timestamp_formats: Sequence[str] | None = None) -> dict[str, Sequence[str]]:
    """The formats of each text column of timestamps: the given ones, or the known ones in the column's own date order."""
    names = _text_timestamps(raw)
    if timestamp_formats is not None or not names:
        return dict.fromkeys(names, timestamp_formats or DEFAULT_TIMESTAMP_FORMATS)
    orders = {r["column"]: r["date_order"] for r in date_orders(raw).collect()}
    return {n: DAY_FIRST_FORMATS if orders.get(n) == "day first" else DEFAULT_TIMESTAMP_FORMATS for n in names}


def unparsed_timestamps(raw: DataFrame, timestamp_formats: Sequence[str] | dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Per text column of timestamps: ``column, values, unparsed`` (non-blank values, and those of no known format).

    ``timestamp_formats``: see :func:`normalize_tickets`.
    """
    formats = timestamp_formats if isinstance(timestamp_formats, dict) else elected_formats(raw, timestamp_formats)
    counts = [
        F.struct(
            F.lit(n).alias("column"),
            F.count_if(strip_ws(n) != "").alias("values"),
            F.count_if((strip_ws(n) != "") & parse_timestamp(n, formats[n]).isNull()).alias("unparsed"),
        )
        for n in _text_timestamps(raw)
    ]
    empty = F.array().cast("array<struct<column:string,values:bigint,unparsed:bigint>>")
    return raw.agg((F.array(*counts) if counts else F.first(empty)).alias("c")).select(F.inline("c"))


def normalize_tickets(df: DataFrame, timestamp_formats: Sequence[str] | dict[str, Sequence[str]] | None = None) -> DataFrame:
    """P1-P6 in one projection.

    * timestamps: coercing parse to TIMESTAMP_NTZ (P2).  ``timestamp_formats`` are the
      formats of all text columns, or of each; None elects the order of day and month per
      column from its own dates, in one aggregate that runs at once
    * numbers: coercing parse to double, NaN -> NULL (P3); csat 0 -> NULL (P4)
    * 13 id/label columns: string + Unicode strip, '' stays '' (P5)
    * message / notes: NULL -> '', whitespace runs -> one space, strip (P6)
    Output: the 21 ticket columns in canonical order, then any extra columns.
    """
    formats = timestamp_formats if isinstance(timestamp_formats, dict) else elected_formats(df, timestamp_formats)
    df = complete_schema(df)
    schema = df.schema
    exprs: dict[str, Column] = {}
    for name in TIMESTAMP_COLUMNS:
        exprs[name] = _as_timestamp(schema, name, formats.get(name, DEFAULT_TIMESTAMP_FORMATS))
    for name in NUMERIC_COLUMNS:
        exprs[name] = _as_number(schema, name)
    exprs["csat_score"] = F.nullif(exprs["csat_score"], F.lit(0.0))
    for name in STRIPPED_COLUMNS:
        exprs[name] = strip_ws(F.col(name).cast("string"))
    for name in TEXT_COLUMNS:
        exprs[name] = clean_text(F.col(name))
    ordered = [name for name, _ in TICKET_COLUMNS]
    extras = [c for c in df.columns if c not in exprs]
    return df.select(*[exprs[name].alias(name) for name in ordered], *extras)
