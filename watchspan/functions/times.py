"""Time expressions that keep the type of the column they work on."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def parse_ts(text: Column) -> Column:
    """ISO-8601 text to a timestamp; null when missing or unreadable."""
    return F.try_to_timestamp(text)


def event_hour(df: DataFrame, ts: str) -> Column:
    # date_trunc turns a zone-less timestamp into a zoned one
    return F.date_trunc("hour", F.col(ts)).cast(df.schema[ts].dataType)


def day_of_week(day: Column) -> Column:
    """0 for Sunday up to 6 for Saturday."""
    return F.dayofweek(day) - 1


def as_literal(value: str | date | datetime | Column, dtype: T.DataType) -> Column:
    """A literal of the column's own type, so that comparisons with it reach the scan."""
    if isinstance(value, Column):
        return value.cast(dtype)
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast(dtype)


def max_literal(df: DataFrame, col: str, day: str | None = None) -> Column:
    """The column's maximum as a literal: one row reaches the driver, later filters push down.

    `day` names the partition column that holds the column's date. The newest day is then found first
    and the column is read in that partition only.
    """
    dtype = df.schema[col].dataType
    if day is not None:
        newest = df.agg(F.max(day).alias("d")).first()["d"]
        df = df.filter(F.col(day) == F.lit(newest))
    top = df.agg(F.max(col).cast("string").alias("m")).first()["m"]
    return F.lit(top).cast(dtype)
