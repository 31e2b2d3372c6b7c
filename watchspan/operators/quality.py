"""Data-quality views and checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def event_gaps(daily: DataFrame, bounds: DataFrame, as_of: Column, key: str = "app_id", day: str = "event_date", count: str = "total_events", days: int = 30) -> DataFrame:
    """Days of the calendar's last `days` on which a key has no events.

    `bounds` is the calendar's one row (min_day, max_day). The expected days come from a sequence and
    the observed ones, at most one per calendar day, from a bounded set per key; no grid is joined.
    """
    since = F.date_sub(as_of, days)
    first = F.greatest(bounds.select("min_day").scalar(), since)
    last = bounds.select("max_day").scalar()
    seen = F.when((F.col(day) >= since) & (F.col(count) != 0) & F.col(key).isNotNull(), F.col(day))
    expected = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))
    return (
        daily.groupBy(key)
        .agg(F.collect_set(seen).alias("_seen"))
        .select(key, F.explode(F.array_except(expected, "_seen")).alias(day))
        .withColumn(count, F.lit(0).cast("bigint"))
    )


def duplicates_daily(events: DataFrame) -> DataFrame:
    """Days and sources on which an event id occurs more than once."""
    rows = events.groupBy("event_date", "source").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct("unique_id").alias("distinct_event_ids")
    )
    return rows.withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_event_ids")).filter("duplicate_rows > 0")


def check_not_null(df: DataFrame, cols: list[str], name: str) -> DataFrame:
    """Null count of each column, all in one aggregate: model, test, column, violations."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in cols))
    rows = counts.unpivot([], list(cols), "column_name", "violations")
    return rows.select(F.lit(name).alias("model"), F.lit("not_null").alias("test"), "column_name", "violations")


def check_unique(df: DataFrame, cols: list[str], name: str) -> DataFrame:
    """Number of repeated non-null values (or combinations) of the columns."""
    known = reduce(lambda a, c: a & F.col(c).isNotNull(), cols, F.lit(True))
    repeated = df.filter(known).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return repeated.agg(F.count(F.lit(1)).alias("violations")).select(
        F.lit(name).alias("model"), F.lit("unique").alias("test"), F.lit(",".join(cols)).alias("column_name"), "violations"
    )


def check_table(df: DataFrame, required: list[str], unique: list[str | list[str]], name: str) -> DataFrame:
    """All null and uniqueness checks of a table from one scan and one shuffle: model, test, column_name, violations.

    Every row gives one entry per check: for a uniqueness check a 128-bit hash of the value, for a null check whether the
    value is missing. Entries are folded by check and hash in the task already, so a null check sends one row per task
    and a value that occurs very often one as well.
    """
    no_hash = F.lit(0).cast("bigint")
    entries = [
        F.struct(F.lit("not_null").alias("test"), F.lit(c).alias("column_name"), no_hash.alias("high"), no_hash.alias("low"), F.col(c).isNull().cast("bigint").alias("missing"))
        for c in required
    ]
    for cols in unique:
        cols = [cols] if isinstance(cols, str) else cols
        known = reduce(Column.__and__, (F.col(c).isNotNull() for c in cols))
        entries.append(
            F.when(known, F.struct(
                F.lit("unique").alias("test"), F.lit(",".join(cols)).alias("column_name"),
                F.xxhash64(*cols).alias("high"), F.xxhash64(F.lit(1), *cols).alias("low"), no_hash.alias("missing"),
            ))
        )
    checks = [("not_null", c) for c in required] + [("unique", c if isinstance(c, str) else ",".join(c)) for c in unique]
    rows = df.select(F.inline(F.array_compact(F.array(*entries))))
    folded = rows.groupBy("test", "column_name", "high", "low").agg(F.count(F.lit(1)).alias("_n"), F.sum("missing").alias("_missing"))
    broken = F.count_if((F.col("test") == "unique") & (F.col("_n") > 1)) + F.sum("_missing")
    found = folded.groupBy("test", "column_name").agg(broken.alias("violations"))
    # a table without rows fulfils every check
    listed = df.sparkSession.createDataFrame(checks, "test string, column_name string")
    out = listed.join(F.broadcast(found), ["test", "column_name"], "left")
    return out.select(F.lit(name).alias("model"), "test", "column_name", F.coalesce("violations", F.lit(0)).alias("violations"))


def misplaced_rows(df: DataFrame, ts: str, hour: str) -> DataFrame:
    """Rows whose time lies outside the hour partition they are stored in."""
    return df.filter(F.date_trunc("hour", F.col(ts)) != F.date_trunc("hour", F.col(hour)))


# Columns that may not be null, and columns that must be unique, per model.
STAGED = ("stg_admin_events", "stg_login_events", "stg_drive_events", "stg_saml_events", "stg_token_events")
EVENT_FACTS = ("fact_admin_event", "fact_login_event", "fact_drive_event", "fact_saml_event", "fact_token_event")
CHECKS: dict[str, tuple[list[str], list[str]]] = {
    **{m: (["unique_id", "timestamp"], ["unique_id"]) for m in STAGED},
    "stg_token_event_scopes": (["unique_id", "timestamp"], []),
    **{m: (["unique_id", "timestamp"], ["unique_id"]) for m in EVENT_FACTS},
    "fact_token_scope": (["unique_id", "scope_name", "timestamp"], []),
    "fact_admin_actions_daily": (["admin_day_key", "event_date"], ["admin_day_key"]),
    "fact_geo_activity_daily": (["geo_day_key", "event_date"], ["geo_day_key"]),
    "fact_scope_risk_daily": (["scope_risk_day_key", "event_date"], ["scope_risk_day_key"]),
    "dq_app_event_gaps": (["app_id", "event_date"], []),
    "fact_event_volume_hourly": (["app_hour_key", "event_hour"], ["app_hour_key"]),
    "fact_scope_cooccurrence_daily": (["scope_pair_day_key", "event_date"], ["scope_pair_day_key"]),
    "fact_admin_action_breakdown_daily": (["admin_breakdown_day_key", "event_date"], ["admin_breakdown_day_key"]),
    "dq_duplicate_events_daily": (["event_date", "source"], []),
    "fact_geo_new_regions": (["user_key", "region_code"], []),
    "fact_user_activity_baseline": (
        ["user_baseline_day_key", "user_key", "event_date", "total_events", "token_total_bytes"],
        ["user_baseline_day_key"],
    ),
    "fact_app_activity_baseline": (
        ["app_baseline_day_key", "app_id", "event_date", "total_events", "token_total_bytes"],
        ["app_baseline_day_key"],
    ),
    "agg_token_top_users_48h": (["actor_email", "actor_profile_id", "event_count", "total_bytes"], []),
    "agg_token_top_methods_48h": (["method_name", "event_count", "total_bytes"], []),
    "agg_event_volume_spikes": (["source", "event_hour"], []),
    "agg_token_top_apps_48h": (["app_id"], []),
    "agg_high_risk_scopes_7d": (["window_start", "window_end"], []),
    "agg_high_risk_scope_names_7d": (["scope_name"], []),
    "agg_scope_pairs_high_risk_7d": (["event_date"], []),
    "agg_admin_action_alerts_48h": (["event_date"], []),
    "agg_geo_recent_48h": (["event_date"], []),
    "agg_dq_dupes_30d": (["event_date", "source"], []),
    "agg_dq_gaps_30d": (["app_id", "event_date"], []),
    "agg_token_intensity_outliers_48h": (["app_id"], []),
}


def dq_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Every listed check for the given models, one row each."""
    parts = []
    for name, df in tables.items():
        parts.append(check_table(df, *CHECKS[name], name))
    return reduce(DataFrame.unionByName, parts)
