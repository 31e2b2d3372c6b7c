"""Cursor state per application and stage.

The table is a log: an update appends one row and a read takes the latest row of each
(application, stage). Nothing is overwritten while being read and the other stages stay untouched.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from watchspan.operators.dedup import dedup_latest
from watchspan.operators.incremental import FIRST_RUN_HOURS
from watchspan.schemas import CONTROL
from watchspan.sources.warehouse import load

STAGES = ("fetcher", "processor", "loader")


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """Latest row per (app, stage); empty when nothing was stored. Old rows with only `last_run` use it as cursor."""
    log = load(spark, path, CONTROL)
    if log is None:
        return spark.createDataFrame([], CONTROL)
    latest = dedup_latest(log, ["app", "stage"], "updated_at")
    filled = F.when((F.col("stage") == "fetcher") & F.col("cursor").isNull(), F.col("last_run")).otherwise(F.col("cursor"))
    return latest.withColumn("cursor", filled)


def control_or_default(spark: SparkSession, path: str, app: str, as_of: datetime) -> DataFrame:
    """The application's rows, or a fetcher row that starts 48 hours before `as_of`."""
    rows = read_control(spark, path).filter(F.col("app") == app)
    start = F.lit(str(as_of)).cast("timestamp") - F.expr(f"INTERVAL {FIRST_RUN_HOURS} HOURS")
    default = spark.range(1).select(
        F.lit(app).alias("app"), F.lit("fetcher").alias("stage"), start.alias("cursor"), start.alias("last_run")
    )
    default = default.join(rows.filter(F.col("stage") == "fetcher").select("app"), "app", "left_anti")
    return rows.unionByName(default, allowMissingColumns=True)


def update_control(
    spark: SparkSession, path: str, app: str, stage: str, cursor: datetime | None, last_run: datetime | None = None,
    run_id: str | None = None, snapshot_path: str | None = None, status: str = "success", updated_at: datetime | None = None,
) -> None:
    """Append a row. Times are wall-clock times of the session's zone, whatever the zone of the driver's machine."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage {stage!r}")
    _append(spark, path, [(app, stage, cursor, last_run or cursor, run_id, snapshot_path, status, updated_at)])


def reset_stages(spark: SparkSession, path: str, apps: list[str], stages: tuple[str, ...] = ("processor", "loader")) -> None:
    """Clear cursors so that the stages run from the start; the fetch cursor stays."""
    _append(spark, path, [(a, s, None, None, None, None, "reset", None) for a in apps for s in stages])


def compact_control(spark: SparkSession, path: str) -> None:
    """Fold the log's files into one that holds the latest rows.

    Only the files that were listed first are removed, after the folded rows are stored. Rows appended meanwhile lie in other
    files and stay; between the two steps, or if the second fails, rows are there twice, which a read does not notice.
    """
    log = load(spark, path, CONTROL)
    files = [] if log is None else log.inputFiles()
    if len(files) < 2:
        return
    rows = dedup_latest(spark.read.schema(CONTROL).parquet(*files), ["app", "stage"], "updated_at").collect()  # one per application and stage
    _append(spark, path, [tuple(r) for r in rows])
    for name in files:
        old = spark._jvm.org.apache.hadoop.fs.Path(name)
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, False)


def _append(spark: SparkSession, path: str, rows: list[tuple]) -> None:
    """Store control rows; times travel as text, and a row without `updated_at` gets the present time."""
    texts = [tuple(str(v) if isinstance(v, datetime) else v for v in row) for row in rows]
    log = spark.createDataFrame(texts, ", ".join(f"{c} string" for c in CONTROL.names))
    log = log.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in CONTROL.fields))
    log = log.withColumn("updated_at", F.coalesce("updated_at", F.current_timestamp().cast(CONTROL["updated_at"].dataType)))
    log.coalesce(1).write.mode("append").parquet(path)
