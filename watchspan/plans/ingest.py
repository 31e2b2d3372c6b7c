"""Raw files to processed daily tables to loaded tables, from cursor to cursor."""

from __future__ import annotations

from datetime import date, datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from watchspan.operators.dedup import dedup_latest
from watchspan.operators.incremental import date_window, next_cursor, resolve_start
from watchspan.operators.normalize import explode_scopes, normalize
from watchspan.plans.models import Warehouse
from watchspan.schemas import APPS
from watchspan.sources import control as C
from watchspan.sources.processed import read_processed, table_path, write_daily
from watchspan.sources.raw import app_path, misplaced_errors, parse_lines, read_lines, split_errors
from watchspan.sources.warehouse import replace_days, stored_days

SCOPE_KEYS = ["unique_id", "scope_name", "product_bucket"]


def processed_frames(activities: DataFrame, app: str) -> dict[str, DataFrame]:
    """Deduplicated processed tables of an application: events, and scopes for token."""
    out = {"events": dedup_latest(normalize(activities, app), ["unique_id"])}
    if app == "token":
        out["event_scopes"] = dedup_latest(explode_scopes(activities), SCOPE_KEYS)
    return out


def ingest(
    spark: SparkSession, raw: str, processed: str, app: str, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """Parse, flatten, deduplicate over the whole range and replace the days written. Returns the dead letters.

    An activity whose own day lies outside the range read is a dead letter: the rest of that day was not read, so
    writing it would replace a whole day by a part of it.
    """
    parsed = parse_lines(read_lines(spark, raw, app, start, end))
    good, bad = split_errors(misplaced_errors(parsed, start, end))
    if app == "token":
        good = good.persist(StorageLevel.DISK_ONLY)  # read by both tables, parsed once
    for kind, df in processed_frames(good, app).items():
        write_daily(df, table_path(processed, app, kind))
    good.unpersist()
    return bad


def process_recent(
    spark: SparkSession, control: str, raw: str, processed: str, app: str, as_of: datetime, run_id: str | None = None
) -> DataFrame:
    """Ingest the days since the processor's cursor and move the cursor to the newest event. Returns the dead letters.

    The days read start one before the cursor, so that the days written are whole, and end with the
    last day known to be fetched.
    """
    state = C.read_control(spark, control)
    landed = stored_days(spark, app_path(raw, app))
    if not landed:
        return spark.createDataFrame([], "error string, raw string")
    start = resolve_start(state, app, "processor", as_of, landed[0])
    fetcher = state.filter((F.col("app") == app) & (F.col("stage") == "fetcher"))
    fetched = fetcher.agg(F.max("cursor").cast("string").alias("c")).first()["c"]  # text: no part for the driver's own zone
    last_event = None if fetched is None else F.lit(fetched).cast("timestamp")
    days = start.select(*date_window(F.col("start"), F.lit(str(as_of)).cast("timestamp"), last_event)).first()
    bad = ingest(spark, raw, processed, app, *days)
    newest = next_cursor(read_processed(spark, processed, app, since=days[0]))
    if newest is not None:
        C.update_control(spark, control, app, "processor", newest, run_id=run_id)
    return bad


def load_recent(
    spark: SparkSession, control: str, processed: str, loaded: str, app: str, as_of: datetime, run_id: str | None = None
) -> None:
    """Replace the tail of the loaded tables from the loader's cursor on, with a cursor for each table.

    Whole days are replaced, which covers the overlap and also the first moment of a first run.
    """
    for kind in ("events", "event_scopes") if app == "token" else ("events",):
        days = stored_days(spark, table_path(processed, app, kind))
        if not days:
            continue
        name = app if kind == "events" else f"{app}_scopes"
        state = C.read_control(spark, control)
        since = resolve_start(state, name, "loader", as_of, days[0]).select(F.to_date("start").alias("day")).first()["day"]
        tail = read_processed(spark, processed, app, kind, since)
        replace_days(spark, table_path(loaded, app, kind), tail, since)
        newest = next_cursor(tail)
        if newest is not None:
            C.update_control(spark, control, name, "loader", newest, run_id=run_id)


def rebuild_tables(
    spark: SparkSession, control: str, raw: str, processed: str, loaded: str, as_of: datetime, apps: tuple[str, ...] = APPS
) -> None:
    """Clear the processor's and loader's cursors and make the processed and loaded tables again from all landed days.

    The control log is folded first, so that the runs after the reset read one file.
    """
    C.reset_stages(spark, control, [*apps, *(["token_scopes"] if "token" in apps else [])])
    C.compact_control(spark, control)
    for app in apps:
        process_recent(spark, control, raw, processed, app, as_of)
        load_recent(spark, control, processed, loaded, app, as_of)


def rebuild(
    spark: SparkSession, control: str, raw: str, processed: str, loaded: str, root: str, as_of: datetime, apps: tuple[str, ...] = APPS
) -> dict[str, DataFrame]:
    """Clear the processor's and loader's cursors and build everything again; the fetch cursor is kept."""
    rebuild_tables(spark, control, raw, processed, loaded, as_of, apps)
    return Warehouse(spark, root, loaded, full_refresh=True).build()
