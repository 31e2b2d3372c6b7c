"""How late events arrive, and the backward overlap that covers it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def _minutes(later: Column, earlier: Column) -> Column:
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.greatest(F.lit(0.0), micros / F.lit(60_000_000.0))


def estimate_overlap(
    manifests: DataFrame, pct: int = 95, pad: float = 1.0, cap: int | None = 10, mode: str = "head", apps: tuple[str, ...] = ()
) -> DataFrame:
    """Per application: distribution of the quiet time at both ends of its runs, and the overlap to use.

    A run counts when all four times are known. `head` measures from the run's start to its first
    event; `early` measures how far the first event lies before the start. A group holds one row per
    run, a number fixed by time and window length, so an exact percentile per group is safe.

    An application of `apps` without any manifest gets a row of its own: no run, no gaps, no overlap needed.
    """
    times = ("start", "end", "earliest_event_time", "latest_event_time")
    usable = F.lit(True)
    for t in times:
        usable = usable & F.col(t).isNotNull()
    start, first = F.col("start"), F.col("earliest_event_time")
    head = _minutes(first, start) if mode == "head" else _minutes(start, first)
    rows = manifests.select(
        "app",
        usable.alias("_used"),
        F.when(usable, head).alias("head"),
        F.when(usable, _minutes(F.col("end"), F.col("latest_event_time"))).alias("tail"),
        F.when(usable, first).alias("_first"),
        F.when(usable, F.col("latest_event_time")).alias("_last"),
    )

    def spread(col: str) -> list[Column]:
        fns = {"p": F.percentile(col, F.lit(pct / 100)), "min": F.min(col), "mean": F.avg(col), "max": F.max(col)}
        return [F.round(fn, 3).alias(f"{col}_gap_{k}") for k, fn in fns.items()]

    per_app = rows.groupBy("app").agg(
        F.count(F.lit(1)).alias("files_considered"),
        F.count_if("_used").alias("runs_used"),
        *spread("head"),
        *spread("tail"),
        F.min("_first").alias("earliest_event_time"),
        F.max("_last").alias("latest_event_time"),
    )
    wanted = F.ceil(F.col("head_gap_p") + F.lit(float(pad)))
    if cap is not None:
        wanted = F.least(wanted, F.lit(cap))
    out = per_app.withColumn("recommended_overlap_minutes", F.when(F.col("runs_used") > 0, wanted).otherwise(0).cast("bigint"))
    if not apps:
        return out
    named = manifests.sparkSession.createDataFrame([(a,) for a in apps], "app string").join(out.select("app"), "app", "left_anti")
    counts = {c: F.lit(0).cast("bigint") for c in ("files_considered", "runs_used", "recommended_overlap_minutes")}
    return out.unionByName(named.withColumns(counts), allowMissingColumns=True)


def estimate_overlap_total(per_app: DataFrame) -> DataFrame:
    """One row over all applications; the recommendation is the largest one."""
    with_runs = F.col("runs_used") > 0
    span = _minutes(F.max("latest_event_time"), F.min("earliest_event_time"))
    return per_app.agg(
        F.count(F.lit(1)).alias("apps_considered"),
        F.count_if(with_runs).alias("apps_with_runs"),
        F.coalesce(F.sum("files_considered"), F.lit(0)).alias("total_files_considered"),
        F.coalesce(F.sum("runs_used"), F.lit(0)).alias("total_runs_used"),
        F.coalesce(F.max(F.when(with_runs, F.col("recommended_overlap_minutes"))), F.lit(0)).alias("recommended_max_minutes"),
        F.when(F.max("latest_event_time").isNotNull(), span).alias("total_duration_minutes"),
    )
