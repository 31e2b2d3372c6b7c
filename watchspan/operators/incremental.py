"""Cursors, lookbacks and keyed merges."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from watchspan.functions.times import as_literal, max_literal
from watchspan.operators.dedup import dedup_latest
from watchspan.operators.joins import lookup_join, without_keys

OVERLAP_MINUTES = 3
FIRST_RUN_HOURS = 48
SMALL_APP_WINDOWS = {"admin": 24, "login": 48, "saml": 48, "drive": 48}
DEFAULT_WINDOW_HOURS = 6


def with_overlap(cursor: Column, minutes: int = OVERLAP_MINUTES) -> Column:
    """A cursor moved back, so that late arrivals are read again."""
    return cursor - F.expr(f"INTERVAL {minutes} MINUTES")


def since_max(
    df: DataFrame, target: DataFrame, ts: str, lookback: str, target_ts: str | None = None, day: str | None = None
) -> DataFrame:
    """Rows from the target's highest time minus the lookback on; all rows when it is empty.

    The bound is fetched first and becomes a literal, so it reaches the scan. With `day`, the date
    partition of both tables, the bound is read from the target's newest partition and the source's
    partitions are pruned.
    """
    floor = high_water(target, target_ts or ts, df.schema[ts].dataType.simpleString(), day) - F.expr(f"INTERVAL {lookback}")
    rows = df if day is None else df.filter(F.col(day) >= F.to_date(floor))
    return rows.filter(F.col(ts) >= floor)


def high_water(target: DataFrame, ts: str, as_type: str, day: str | None = None) -> Column:
    lowest = F.lit("1970-01-01").cast(target.schema[ts].dataType)
    return F.coalesce(max_literal(target, ts, day), lowest).cast(as_type)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str], newest: str | None = None) -> DataFrame:
    """Target after a merge on unique keys: matching rows replaced, others added.

    Updates are made unique first (latest by `newest` where given). Columns follow the updates:
    new ones are null for old rows, dropped ones disappear.
    """
    fresh = dedup_latest(updates, keys, newest)
    kept = without_keys(target, fresh, keys)
    return kept.unionByName(fresh, allowMissingColumns=True).select(*updates.columns)


def replace_tail(target: DataFrame, source: DataFrame, ts_col: str, start: datetime | str | Column, first_run: bool = False) -> DataFrame:
    """Target with everything after `start` taken from the source; on a first run `start` itself counts too."""
    bound = as_literal(start, target.schema[ts_col].dataType)
    ts = F.col(ts_col)
    # rows without a time are never part of the tail
    tail = F.coalesce(ts >= bound if first_run else ts > bound, F.lit(False))
    return target.filter(~tail).unionByName(source.filter(tail), allowMissingColumns=True)


def next_cursor(*frames: DataFrame, ts: str = "timestamp") -> datetime | None:
    """Highest time over the loaded slices, in the session's zone; empty slices are skipped.

    It travels as text, so the zone of the driver's machine plays no part.
    """
    tops = [f.agg(F.max(ts).cast("string").alias("m")).first()["m"] for f in frames]
    return max((datetime.fromisoformat(t) for t in tops if t is not None), default=None)


def resolve_start(
    control: DataFrame, app: str, kind: str, as_of: datetime | str, earliest: date | str | None = None,
    overlap: int = OVERLAP_MINUTES, hours: int = FIRST_RUN_HOURS,
) -> DataFrame:
    """Where a stage starts reading, one row `start`.

    Its own cursor less the overlap; else the earliest day present; else, for the processor, the
    fetcher's last event or last run less the overlap; else `hours` before `as_of`.
    """
    mine = F.max(F.when(F.col("stage") == kind, F.col("cursor")))
    steps = [with_overlap(mine, overlap), F.lit(str(earliest) if earliest else None).cast("timestamp")]
    if kind == "processor":
        fetched = F.col("stage") == "fetcher"
        steps += [
            with_overlap(F.max(F.when(fetched, F.col("cursor"))), overlap),
            with_overlap(F.max(F.when(fetched, F.col("last_run"))), overlap),
        ]
    steps.append(F.lit(str(as_of)).cast("timestamp") - F.expr(f"INTERVAL {hours} HOURS"))
    return control.filter(F.col("app") == app).agg(F.coalesce(*steps).alias("start"))


def date_window(start: Column, as_of: Column, last_event: Column | None = None) -> tuple[Column, Column]:
    """Days to read: one before the start up to the last day known to be fetched."""
    end = F.to_date(as_of)
    if last_event is not None:
        end = F.least(end, F.to_date(last_event))
    return F.date_sub(F.to_date(start), 1), end


def date_batches(spark: SparkSession, start: date | str, end: date | str, n: int) -> DataFrame:
    """Closed day ranges of n days that cover [start, end]; the last may be shorter."""
    bounds = spark.range(1).select(F.lit(str(start)).cast("date").alias("s"), F.lit(str(end)).cast("date").alias("e"))
    steps = F.when(F.col("s") <= F.col("e"), F.sequence("s", "e", F.expr(f"INTERVAL {n} DAYS"))).otherwise(F.array().cast("array<date>"))
    return bounds.select(F.explode(steps).alias("batch_start"), "e").select(
        "batch_start", F.least(F.date_add("batch_start", n - 1), "e").alias("batch_end")
    )


def window_hours(app: Column, default: int = DEFAULT_WINDOW_HOURS) -> Column:
    """Fetch window length of an application."""
    out = F.when(app == "admin", SMALL_APP_WINDOWS["admin"])
    for name in ("login", "saml", "drive"):
        out = out.when(app == name, SMALL_APP_WINDOWS[name])
    return out.otherwise(default)


def split_windows(ranges: DataFrame, start: str, end: str, hours: Column | int) -> DataFrame:
    """Each row's [start, end) cut into windows of the given hours: idx, window_start, window_end.

    A rest shorter than a second is left out.
    """
    hours = F.lit(hours) if isinstance(hours, int) else hours
    step = F.make_dt_interval(F.lit(0), hours)
    starts = F.when(F.col(start) < F.col(end), F.sequence(F.col(start), F.col(end), step)).otherwise(
        F.array().cast(f"array<{ranges.schema[start].dataType.simpleString()}>")
    )
    cut = ranges.select("*", step.alias("_step"), F.posexplode(starts).alias("idx", "window_start"))
    cut = cut.withColumn("window_end", F.least(F.col("window_start") + F.col("_step"), F.col(end))).drop("_step")
    return cut.filter(F.col("window_end") - F.col("window_start") >= F.expr("INTERVAL 1 SECOND"))


def time_windows(spark: SparkSession, start: datetime | str, end: datetime | str, hours: int = DEFAULT_WINDOW_HOURS) -> DataFrame:
    """Windows of one range."""
    one = spark.range(1).select(F.lit(str(start)).cast("timestamp").alias("s"), F.lit(str(end)).cast("timestamp").alias("e"))
    return split_windows(one, "s", "e", hours).drop("s", "e")


def run_coverage(events: DataFrame, windows: DataFrame, by: list[str], ts: str = "timestamp") -> DataFrame:
    """Count, first and last event time per window; windows without events are left out.

    Windows of one range are equally long, so an event's window index is computed from its time and
    the range's start: a lookup on `by` instead of a join on ranges, then one grouped aggregate.
    """
    def micros(col: str) -> Column:
        return F.unix_micros(F.col(col).cast("timestamp"))

    spans = windows.groupBy(*by).agg(
        F.min("window_start").alias("_from"),
        F.max("window_end").alias("_to"),
        F.max(micros("window_end") - micros("window_start")).alias("_length"),
    )
    placed = lookup_join(events.select(*by, ts), spans, by, ts).filter(
        (F.col(ts) >= F.col("_from")) & (F.col(ts) < F.col("_to"))
    )
    placed = placed.withColumn("_since", micros(ts) - micros("_from"))
    return (
        placed.withColumn("idx", F.expr("_since div _length").cast("int"))
        .groupBy(*by, "idx")
        .agg(
            F.count(F.lit(1)).alias("num_events"),
            F.min(ts).alias("earliest_event_time"),
            F.max(ts).alias("latest_event_time"),
        )
    )


def interval_coverage(events: DataFrame, windows: DataFrame, by: list[str], keys: list[str], ts: str = "timestamp", bin_seconds: int = 3600) -> DataFrame:
    """Count, first and last event time per window, for windows of any length that may overlap or leave gaps.

    Windows are [window_start, window_end), named by `by` and `keys`; those without events are left out. Windows and
    events are cut into bins of time, and an event looks up the windows that touch its bin: a lookup on (by, bin)
    that is unique on its key, so a busy bin is spread like any hot key. A bin lists the windows that touch it, whose
    number is that of the runs at a time.
    """
    def bin_of(seconds: Column) -> Column:
        return F.floor(seconds / F.lit(bin_seconds)).cast("bigint")

    first, last = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("window_start", "window_end"))
    touched = F.explode(F.sequence(bin_of(first / 1_000_000), bin_of((last - 1) / 1_000_000)))
    window = F.struct(*keys, F.col("window_start").cast("timestamp").alias("window_start"), F.col("window_end").cast("timestamp").alias("window_end"))
    listed = windows.filter(F.col("window_start") < F.col("window_end")).select(*by, window.alias("w"), touched.alias("_bin"))
    listed = listed.groupBy(*by, "_bin").agg(F.collect_list("w").alias("_windows"))
    at = F.col(ts).cast("timestamp")
    placed = lookup_join(events.select(*by, ts, bin_of(F.unix_micros(at) / 1_000_000).alias("_bin")), listed, [*by, "_bin"], ts)
    inside = F.filter("_windows", lambda w: (w["window_start"] <= at) & (at < w["window_end"]))
    hits = placed.select(*by, ts, F.explode(inside).alias("w")).select(*by, *(F.col(f"w.{k}").alias(k) for k in keys), ts)
    return hits.groupBy(*by, *keys).agg(
        F.count(F.lit(1)).alias("num_events"), F.min(ts).alias("earliest_event_time"), F.max(ts).alias("latest_event_time")
    )
