"""Day-over-day change of the set of items an entity uses.

A row (entity, item, day) says two things: the item is present on that day, and it was present the
day before the next one. Folding both kinds per (entity, item, day) gives what is new, kept and
removed without joining the table to itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from watchspan.functions.keys import surrogate_key
from watchspan.operators.joins import lookup_join


def app_scopes(scope_facts: DataFrame, event_facts: DataFrame) -> DataFrame:
    """(app_id, scope_key, event_date) of scope rows whose event, on the same day, has an application."""
    events = event_facts.filter(F.col("app_id").isNotNull()).select("unique_id", "event_date", "app_id")
    rows = scope_facts.filter(F.col("scope_key").isNotNull()).select("unique_id", "event_date", "scope_key")
    return lookup_join(rows, events, ["unique_id", "event_date"], "scope_key").filter(F.col("app_id").isNotNull())


def set_presence(df: DataFrame, key: str, item: str, day: str = "event_date", since: Column | None = None) -> DataFrame:
    """Per key, item and day: whether the item is there now and whether it was the day before."""
    known = df.filter(F.col(key).isNotNull() & F.col(item).isNotNull() & F.col(day).isNotNull())
    if since is not None:
        known = known.filter(F.col(day) >= F.date_sub(since, 1))
    both = F.array(
        F.struct(F.col(day).alias("event_date"), F.lit(1).alias("now"), F.lit(0).alias("before")),
        F.struct(F.date_add(F.col(day), 1).alias("event_date"), F.lit(0).alias("now"), F.lit(1).alias("before")),
    )
    rows = known.select(key, item, F.inline(both)).groupBy(key, item, "event_date").agg(
        F.max("now").alias("now"), F.max("before").alias("before")
    )
    return rows if since is None else rows.filter(F.col("event_date") >= since)


def set_drift_daily(df: DataFrame, key: str = "app_id", item: str = "scope_key", day: str = "event_date", since: Column | None = None) -> DataFrame:
    """Totals, additions and removals per key and day.

    With `since` one day more is read than is returned, so the first returned day has its prior day.
    """
    now, before = F.col("now"), F.col("before")
    rows = set_presence(df, key, item, day, since).groupBy(key, "event_date").agg(
        F.sum(now).alias("total_scopes"),
        F.sum(before).alias("prior_day_scopes"),
        F.sum(now * (1 - before)).alias("new_scopes_count"),
        F.sum((1 - now) * before).alias("removed_scopes_count"),
    )
    return rows.select(
        surrogate_key(key, "event_date").alias("app_scope_drift_day_key"),
        "*",
        (F.col("new_scopes_count") - F.col("removed_scopes_count")).alias("net_scope_change"),
        ((F.col("new_scopes_count") > 0) | (F.col("removed_scopes_count") > 0)).alias("has_scope_drift"),
    )


def set_drift_items(df: DataFrame, key: str = "app_id", item: str = "scope_key", day: str = "event_date", since: Column | None = None) -> DataFrame:
    """One row per item added to or removed from a key's set on a day."""
    rows = set_presence(df, key, item, day, since).filter(F.col("now") != F.col("before"))
    change = F.when(F.col("now") == 1, "added").otherwise("removed")
    out = rows.select(key, "event_date", item, change.alias("change_type"))
    return out.select(surrogate_key(key, "event_date", item, "change_type").alias("app_scope_drift_scope_day_key"), "*")
