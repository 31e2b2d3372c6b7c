"""Daily and hourly activity aggregates.

All are plain grouped aggregates: partial sums are formed before each shuffle, and distinct counts
are first shuffled by (group, value), so a group with a third of all rows is spread over all tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from watchspan.functions.keys import surrogate_key
from watchspan.functions.scopes import is_high_risk
from watchspan.operators.joins import lookup_join

SOURCES = ("token", "admin", "login", "drive", "saml")
APP_SOURCES = ("token", "admin", "drive")


def _total() -> Column:
    return F.count(F.lit(1)).alias("total_events")


def _distinct(**named: str) -> list[Column]:
    return [F.count_distinct(F.col(col)).alias(name) for name, col in named.items()]


def per_source(sources: tuple[str, ...]) -> list[Column]:
    return [F.count_if(F.col("source") == s).alias(f"{s}_events") for s in sources]


def activity_daily(
    events: DataFrame, keys: list[str], key_name: str, distinct: dict[str, str], sources: tuple[str, ...] = SOURCES
) -> DataFrame:
    """Events per key and day: total, per source, and the wanted distinct counts."""
    by = [*keys, "event_date"]
    rows = events.groupBy(*by).agg(_total(), *_distinct(**distinct), *per_source(sources))
    return rows.select(surrogate_key(*by).alias(key_name), "*")


def user_activity_daily(events: DataFrame, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """Per user and day; events without a user form a group of their own."""
    return activity_daily(events, ["user_key"], "user_day_key", {"distinct_events": "unique_id"}, sources)


def app_activity_daily(events: DataFrame, sources: tuple[str, ...] = APP_SOURCES) -> DataFrame:
    with_app = events.filter(F.col("app_id").isNotNull() & F.col("source").isin(*sources))
    return activity_daily(
        with_app, ["app_id"], "app_day_key", {"distinct_users": "user_key", "distinct_events": "unique_id"}, sources
    )


def ip_activity_daily(events: DataFrame, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    with_ip = events.filter(F.col("ip_key").isNotNull())
    return activity_daily(with_ip, ["ip_key"], "ip_day_key", {"distinct_users": "user_key", "distinct_apps": "app_id"}, sources)


def geo_daily(events: DataFrame, dim_ip: DataFrame, sources: tuple[str, ...] = SOURCES) -> DataFrame:
    """Per day and place; the place is the address dimension's, unknown parts group as null."""
    place = ["region_code", "subdivision_code", "asn"]
    with_ip = events.filter(F.col("ip_key").isNotNull()).select("event_date", "ip_key", "user_key", "unique_id", "source")
    placed = lookup_join(with_ip, dim_ip.select("ip_key", *place), ["ip_key"], "unique_id")
    rows = placed.groupBy("event_date", *place).agg(
        _total(), *_distinct(distinct_events="unique_id", distinct_users="user_key"), *per_source(sources)
    )
    known = [F.coalesce(F.col(c).cast("string"), F.lit("unk")) for c in place]
    return rows.select(surrogate_key(*known, "event_date").alias("geo_day_key"), "*")


def first_seen(df: DataFrame, keys: list[str], day: str, since: Column, required: str | None = None) -> DataFrame:
    """First day of every key combination over all history, kept when it is not before `since`."""
    rows = df if required is None else df.filter(F.col(required).isNotNull())
    return rows.groupBy(*keys).agg(F.min(day).alias("first_seen_date")).filter(F.col("first_seen_date") >= since)


def new_regions(events: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    keys = ["user_key", "region_code", "subdivision_code"]
    return first_seen(events, keys, "event_date", F.date_sub(as_of, days), "region_code")


def volume_hourly(events: DataFrame) -> DataFrame:
    by = ["source", "event_hour", "event_date"]
    rows = events.groupBy(*by).agg(_total(), *_distinct(distinct_events="unique_id"))
    return rows.select(surrogate_key("source", "event_hour").alias("app_hour_key"), "*")


def admin_actions_daily(admin: DataFrame) -> DataFrame:
    rows = admin.groupBy("app_id", "event_date").agg(
        _total(),
        *_distinct(distinct_users="user_key", distinct_events="unique_id"),
        F.count_if("impersonation").alias("impersonation_events"),
        F.count("caller_type").alias("caller_type_present"),
    )
    key = surrogate_key(F.coalesce("app_id", F.lit("unknown")), "event_date")
    return rows.select(key.alias("admin_day_key"), "*")


def admin_breakdown_daily(admin: DataFrame) -> DataFrame:
    rows = admin.groupBy("event_date", "caller_type", "impersonation").agg(
        _total(), *_distinct(distinct_events="unique_id", distinct_users="user_key")
    )
    key = surrogate_key(F.coalesce("caller_type", F.lit("unknown")), "event_date", "impersonation")
    return rows.select(key.alias("admin_breakdown_day_key"), "*")


def scope_usage_daily(scopes: DataFrame) -> DataFrame:
    rows = scopes.groupBy("scope_key", "event_date").agg(
        F.count(F.lit(1)).alias("total_scope_usages"),
        *_distinct(distinct_events="unique_id", distinct_users="user_key", distinct_ips="ip_key"),
    )
    return rows.select(surrogate_key("scope_key", "event_date").alias("scope_day_key"), "*")


def scope_risk_daily(scopes: DataFrame) -> DataFrame:
    risky = is_high_risk(F.col("product_bucket"), F.col("service"))
    flagged = scopes.select("event_date", "unique_id", "user_key", risky.alias("_risky"))
    flagged = flagged.withColumn("_risky_id", F.when(F.col("_risky"), F.col("unique_id")))
    rows = flagged.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("total_scope_usages"),
        *_distinct(distinct_events="unique_id", distinct_users="user_key"),
        F.count_if("_risky").alias("high_risk_scope_usages"),
        *_distinct(high_risk_events="_risky_id"),
    )
    return rows.select(surrogate_key("event_date").alias("scope_risk_day_key"), "*")
