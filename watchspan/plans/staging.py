"""Staging views: processed rows with their day and hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from watchspan.functions.times import event_hour

# The token view leaves out the application name, as its consumers never read it.
_DROPPED = {"token": ["application_name"]}


def stage(df: DataFrame, app: str, ts: str = "timestamp") -> DataFrame:
    """Add event_date and event_hour; `app` is an application, or 'token_scopes' for scope rows.

    A day that is already there is the partition column of the processed table and is kept, so that
    filters on it prune partitions.
    """
    day = F.col("event_date") if "event_date" in df.columns else F.to_date(F.col(ts)).alias("event_date")
    rest = [c for c in df.columns if c not in (ts, "event_date", "event_hour", *_DROPPED.get(app, []))]
    return df.select(ts, day, event_hour(df, ts).alias("event_hour"), *rest)
