"""Run manifests: one JSON document per fetch run, in a directory per application."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from watchspan.schemas import MANIFEST


def manifest_rows(windows: DataFrame, coverage: DataFrame, by: list[str], start: str, end: str) -> DataFrame:
    """Fold per-window coverage into one manifest per run; empty windows are not listed.

    `windows` has one row per planned window of a run, `by` identifies the run.
    """
    planned = windows.groupBy(*by).agg(
        F.min(start).alias("start"), F.max(end).alias("end"), F.count(F.lit(1)).cast("int").alias("num_windows")
    )
    used = windows.join(coverage, [*by, "idx"])
    ranges = F.struct(F.col("idx"), F.col("window_start").alias("start"), F.col("window_end").alias("end"))
    seen = used.groupBy(*by).agg(
        F.min("earliest_event_time").alias("earliest_event_time"),
        F.max("latest_event_time").alias("latest_event_time"),
        F.sum("num_events").alias("num_events"),
        # one entry per window of the run
        F.array_sort(F.collect_list(ranges)).alias("windows"),
    )
    out = planned.join(seen, by, "left")
    return out.withColumns(
        {"num_events": F.coalesce("num_events", F.lit(0)), "windows": F.coalesce("windows", F.array().cast(MANIFEST["windows"].dataType))}
    )


def write_manifest(df: DataFrame, path: str) -> None:
    """Append manifests, one directory per application."""
    df.write.mode("append").partitionBy("app").json(path)


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    """All manifests with their application; pretty-printed or one line each. Unreadable files become null rows."""
    schema = T.StructType([*MANIFEST.fields, T.StructField("app", T.StringType())])
    return spark.read.option("multiLine", True).schema(schema).json(path)
