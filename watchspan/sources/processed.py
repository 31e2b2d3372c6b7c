"""Processed daily Parquet: sink, scans, source binding."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from watchspan.schemas import APPS, processed_schema
from watchspan.sources.warehouse import load


def with_event_date(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return df.withColumn("event_date", F.to_date(F.col(ts)))


def table_path(path: str, app: str, kind: str = "events") -> str:
    return f"{path}/{app}/{kind}"


def write_daily(df: DataFrame, path: str, ts: str = "timestamp") -> None:
    """Snappy Parquet by day. A day that occurs in `df` is replaced as a whole, other days stay.

    Rows are spread by AQE inside each day, so one busy day is still written by many tasks.
    """
    (
        with_event_date(df, ts)
        .hint("rebalance", "event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy("event_date")
        .parquet(path)
    )


def read_processed(
    spark: SparkSession, path: str, app: str, kind: str = "events", since: date | str | None = None
) -> DataFrame:
    """Scan a processed table with its fixed schema; `since` prunes day directories. A missing table is empty."""
    schema = T.StructType(processed_schema(app, kind).fields + [T.StructField("event_date", T.DateType())])
    df = load(spark, table_path(path, app, kind), schema)
    if df is None:
        df = spark.createDataFrame([], schema)
    if since is not None:
        df = df.filter(F.col("event_date") >= F.lit(str(since)).cast("date"))
    return df


def earliest_partition(df: DataFrame) -> date | None:
    """The first day present; only the partition column is read."""
    return df.agg(F.min("event_date").alias("d")).first()["d"]


def register_sources(spark: SparkSession, path: str) -> list[str]:
    """Bind the six processed tables as temporary views."""
    names = []
    for app, kind in [(a, "events") for a in APPS] + [("token", "event_scopes")]:
        name = f"{app}_events" if kind == "events" else f"{app}_event_scopes"
        read_processed(spark, path, app, kind).drop("event_date").createOrReplaceTempView(name)
        names.append(name)
    return names
