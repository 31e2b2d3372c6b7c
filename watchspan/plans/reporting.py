"""Report views on facts and aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from watchspan.functions.ratios import safe_ratio, z_score
from watchspan.functions.scopes import HIGH_RISK_SERVICES, is_high_risk
from watchspan.functions.times import max_literal
from watchspan.operators.joins import lookup_join
from watchspan.operators.rank import global_rank


def last_hours(df: DataFrame, hours: int = 48, ts: str = "timestamp", day: str | None = None) -> DataFrame:
    """Rows of the last hours before the newest one; `day` is the table's date partition, if it has one."""
    return _in_window(df, _window(df, hours, ts, day)[0], ts, day)


def _window(df: DataFrame, hours: int, ts: str, day: str | None) -> tuple[Column, Column]:
    end = max_literal(df, ts, day)
    return end - F.expr(f"INTERVAL {hours} HOURS"), end


def _in_window(df: DataFrame, start: Column, ts: str, day: str | None) -> DataFrame:
    rows = df if day is None else df.filter(F.col(day) >= F.to_date(start))
    return rows.filter(F.col(ts) >= start)


def _recent_totals(
    fact: DataFrame, by: list[str], hours: int, ts: str, day: str | None, average: bool = False, required: str | None = None
) -> DataFrame:
    """Events and bytes per group in the last hours, with the window's bounds."""
    start, end = _window(fact, hours, ts, day)
    rows = _in_window(fact, start, ts, day)
    if required:
        rows = rows.filter(F.col(required).isNotNull())
    measures = [F.count(F.lit(1)).alias("event_count"), F.sum("num_bytes").alias("total_bytes")]
    if average:
        measures.append(F.avg("num_bytes").alias("avg_bytes_per_event"))
    return rows.groupBy(*by).agg(*measures).withColumns({"window_start": start, "window_end": end})


def _ranked(totals: DataFrame, order: list[Column], name: str, limit: int | None) -> DataFrame:
    if limit is None:
        return global_rank(totals, order, name)
    top = totals.orderBy(*order).limit(limit)
    return top.withColumn(name, F.row_number().over(Window.orderBy(*order)))


USERS = ["actor_email", "actor_profile_id"]


def top_users(
    fact: DataFrame, hours: int = 48, ts: str = "timestamp", by: list[str] = USERS, limit: int | None = None, day: str | None = None
) -> DataFrame:
    """Users by events, then bytes; equal ones in the order of their names. `limit` for only the first ones."""
    order = [F.desc_nulls_last("event_count"), F.desc_nulls_last("total_bytes"), *(F.asc_nulls_last(c) for c in by)]
    return _ranked(_recent_totals(fact, by, hours, ts, day), order, "rank_by_events", limit)


def top_methods(
    fact: DataFrame, hours: int = 48, ts: str = "timestamp", method: str = "method_name", limit: int | None = None, day: str | None = None
) -> DataFrame:
    """Methods by bytes, then events."""
    order = [F.desc_nulls_last("total_bytes"), F.desc_nulls_last("event_count"), F.asc_nulls_last(method)]
    return _ranked(_recent_totals(fact, [method], hours, ts, day, required=method), order, "rank_by_bytes", limit)


def top_apps(fact: DataFrame, hours: int = 48, ts: str = "timestamp", app: str = "app_id", day: str | None = None) -> DataFrame:
    rows = _recent_totals(fact, [app], hours, ts, day, average=True)
    return rows.orderBy(F.desc_nulls_last("total_bytes"), F.desc_nulls_last("event_count"), F.asc_nulls_last(app))


def intensity_outliers(
    fact: DataFrame, hours: int = 48, limit: int = 50, ts: str = "timestamp", app: str = "app_id", day: str | None = None
) -> DataFrame:
    """Applications with the most bytes per event."""
    rows = _recent_totals(fact, [app], hours, ts, day, average=True)
    return rows.orderBy(F.desc_nulls_last("avg_bytes_per_event"), F.asc_nulls_last(app)).limit(limit)


def volume_spikes(hourly: DataFrame, as_of: Column, sigma: float = 3.0, recent_hours: int = 48, base_days: int = 7) -> DataFrame:
    """Recent hours far above their source's weekly mean.

    A source has at most base_days * 24 hourly rows, so its statistics come from a small window.
    """
    base = hourly.filter(F.col("event_hour") >= as_of - F.expr(f"INTERVAL {base_days} DAYS"))
    of_source = Window.partitionBy("source")
    rows = base.withColumns(
        {"mean_events": F.avg("total_events").over(of_source), "std_events": F.stddev_pop("total_events").over(of_source)}
    )
    rows = rows.filter(
        (F.col("event_hour") >= as_of - F.expr(f"INTERVAL {recent_hours} HOURS"))
        & (F.col("std_events") > 0)
        & (F.col("total_events") > F.col("mean_events") + F.lit(sigma) * F.col("std_events"))
    )
    return rows.select(
        "source", "event_hour", "event_date", "total_events", "distinct_events", "mean_events", "std_events",
        z_score(F.col("total_events"), F.col("mean_events"), F.col("std_events")).alias("z_score"),
    ).orderBy(F.desc_nulls_last("event_hour"), F.asc_nulls_last("source"))


def recent(df: DataFrame, days: int, as_of: Column, day: str = "event_date", cols: list[str] | None = None, order: list[Column] | None = None) -> DataFrame:
    """Rows of the last days, newest first."""
    rows = df.filter(F.col(day) >= F.date_sub(as_of, days))
    rows = rows.select(*cols) if cols else rows
    return rows.orderBy(F.desc_nulls_last(day), *(order or []))


def admin_alerts(breakdown: DataFrame, as_of: Column) -> DataFrame:
    cols = ["event_date", "caller_type", "impersonation", "total_events", "distinct_events", "distinct_users"]
    return recent(breakdown, 2, as_of, cols=cols, order=[F.desc_nulls_last("total_events")])


def geo_recent(geo: DataFrame, as_of: Column) -> DataFrame:
    return recent(geo.drop("geo_day_key"), 2, as_of, order=[F.desc_nulls_last("total_events")])


def dq_dupes(duplicates: DataFrame, as_of: Column) -> DataFrame:
    return recent(duplicates, 30, as_of, order=[F.asc_nulls_last("source")])


def dq_gaps(gaps: DataFrame, as_of: Column, key: str = "app_id") -> DataFrame:
    return recent(gaps, 30, as_of, order=[F.asc_nulls_last(key)])


def high_risk_summary(risk: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Sums of the daily figures; daily distinct counts are added up, not counted anew."""
    sums = ["total_scope_usages", "distinct_events", "distinct_users", "high_risk_scope_usages", "high_risk_events"]
    rows = risk.filter(F.col("event_date") >= F.date_sub(as_of, days)).agg(
        *(F.sum(c).alias(c) for c in sums),
        F.min("event_date").alias("window_start"),
        F.max("event_date").alias("window_end"),
    )
    return rows.withColumns(
        {
            "pct_high_risk_scopes": safe_ratio(F.col("high_risk_scope_usages"), F.col("total_scope_usages")),
            "pct_high_risk_events": safe_ratio(F.col("high_risk_events"), F.col("distinct_events")),
        }
    )


def high_risk_scopes(scopes: DataFrame, dim_scope: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Usages and active days of the scopes the dimension marks as high risk.

    Usages are folded per scope and day first, so the dimension is joined to few rows.
    """
    daily = (
        scopes.filter(F.col("event_date") >= F.date_sub(as_of, days))
        .groupBy("scope_name", "event_date")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    risky = dim_scope.filter(is_high_risk(F.col("product_bucket"), F.col("service"))).select("scope_name")
    rows = daily.join(risky, "scope_name", "left_semi").groupBy("scope_name").agg(
        F.sum("_n").alias("scope_usages"), F.count("event_date").alias("active_days")
    )
    return rows.orderBy(F.desc_nulls_last("scope_usages"), F.asc_nulls_last("scope_name"))


def high_risk_pairs(pairs: DataFrame, dim_scope: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    rows = pairs.filter(F.col("event_date") >= F.date_sub(as_of, days))
    for side in ("a", "b"):
        services = dim_scope.select(F.col("scope_name").alias(f"scope_{side}"), F.col("service").alias(f"service_{side}"))
        rows = lookup_join(rows, services, [f"scope_{side}"], "scope_pair_day_key")
    risky = F.lit(False)
    for side in ("a", "b"):
        risky = risky | F.coalesce(F.col(f"service_{side}").isin(*HIGH_RISK_SERVICES), F.lit(False))
    return (
        rows.filter(risky)
        .select("event_date", "scope_a", "scope_b", "service_a", "service_b", "cooccurrence_count", "distinct_events", "distinct_users")
        .orderBy(F.desc_nulls_last("cooccurrence_count"))
    )
