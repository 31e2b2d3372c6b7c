"""Scope census: how often each scope occurs in raw logs, and its CSV sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from watchspan.functions.params import scope_list_sql
from watchspan.functions.scopes import is_readonly, scope_service_census


def scope_census(activities: DataFrame) -> DataFrame:
    """Occurrences per (scope, bucket, service, read-only), most frequent first."""
    rows = activities.selectExpr(f"inline({scope_list_sql('get(events, 0).parameters')})")
    name = F.col("scope_name")
    return (
        rows.groupBy(name, "product_bucket", scope_service_census(name).alias("service"), is_readonly(name).alias("is_readonly"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "scope_name", F.asc_nulls_last("product_bucket"))
    )


def write_scope_census(df: DataFrame, path: str) -> None:
    """CSV with a header; a missing bucket is an empty field, flags are true or false."""
    filled = df.withColumn("product_bucket", F.coalesce("product_bucket", F.lit("")))
    filled.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)
