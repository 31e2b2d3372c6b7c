"""Operators on stored tables that grow, as queries: increments, late rows, cursors, layouts and restarts.

Each query builds its tables in several steps from parts of the given ones, and returns what is stored in the end. The expected
SQL says what a single build over all rows gives.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from watchspan.operators import activity as A
from watchspan.operators import baseline as B
from watchspan.operators.dedup import dedup_latest
from watchspan.operators.incremental import date_batches, date_window, interval_coverage, next_cursor, resolve_start
from watchspan.operators.normalize import classify_scopes, conform
from watchspan.operators.quality import dq_report
from watchspan.plans import driver_views as V
from watchspan.plans.carry import carry_app_baseline, carry_user_baseline
from watchspan.plans.dims import DIMENSIONS
from watchspan.plans.driver_queries import CUT, NOVELTY_DAYS, _dims, scratch
from watchspan.plans.ingest import SCOPE_KEYS, load_recent, process_recent, rebuild_tables
from watchspan.plans.models import DIMS, Warehouse
from watchspan.plans.staging import stage
from watchspan.schemas import APPS, SCOPE_SCHEMA, processed_schema
from watchspan.sources import control as C
from watchspan.sources.census import scope_census, write_scope_census
from watchspan.sources.changes import BuildLog, Snapshots
from watchspan.sources.manifests import read_manifests, write_manifest
from watchspan.sources.processed import earliest_partition, read_processed, register_sources, table_path, write_daily
from watchspan.sources.raw import app_path, land_raw, parse_lines, read_raw, split_errors
from watchspan.sources.warehouse import ensure_table, load, materialize, merge_days, replace_listed_days, staged, stored_days
from watchspan.streaming import activity_stream as S

Query = Callable[[SparkSession, str], DataFrame]

# The month of events drawn out over seven months: each of its days becomes a week, dealt out by event.
SPREAD_DAYS = "cast(6 * (extract(day from ts) - 1) + event_id % 7 as int)"
# Applications are seen on every n-th day only, n from 1 to 9.
SPARSE = "(extract(day from ts) + event_id % 7 + k) % (1 + k % 9) = 0"
# Rows arrive in three parts by time; every eleventh comes a part later, months late at worst.
PART_ENDS = ("2024-04-10", "2024-06-20")
LATE_EVERY = 11


def spread_events(s: SparkSession, sf: str, sparse: bool = False) -> DataFrame:
    """All activities over seven months, with the part in which they arrive."""
    rows = V.with_k(V.read(s, sf, "events"))
    if sparse:
        rows = rows.filter(SPARSE)
    rows = rows.withColumn("ts", F.col("ts") + F.make_dt_interval(F.expr(SPREAD_DAYS)))
    in_time = F.lit(1) + sum((F.col("ts") >= F.lit(end).cast("timestamp_ntz")).cast("int") for end in PART_ENDS)
    part = F.least(in_time + (F.col("event_id") % LATE_EVERY == 0).cast("int"), F.lit(1 + len(PART_ENDS)))
    return rows.withColumn("part", part)


def _arrivals(rows: DataFrame, part: int, path: str, to_table: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Store the days that get rows in a part, whole, as the loader does; the stored table."""
    s = rows.sparkSession
    day = F.to_date("ts")
    days = {r[0] for r in rows.filter(F.col("part") == part).select(day.alias("d")).distinct().collect()}
    replace_listed_days(s, path, to_table(rows.filter((F.col("part") <= part) & day.isin(sorted(days)))), days)
    return load(s, path)


def _audit(rows: DataFrame) -> DataFrame:
    return stage(rows.selectExpr(*V.select_list(V.AUDIT, "array")), "")


def app_baseline_incremental(s: SparkSession, sf: str) -> DataFrame:
    """Baselines of applications seen on every n-th day only, built in three parts with late rows."""
    root, rows = scratch(s), staged(spread_events(s, sf, sparse=True))
    log, states = BuildLog(s, f"{root}/_built"), Snapshots(s, f"{root}/_state")
    for part in (1, 2, 3):
        events = _arrivals(rows, part, f"{root}/events", _audit)
        days, now = log.pending("baseline", {"events": f"{root}/events"})
        replace_listed_days(s, f"{root}/daily", A.app_activity_daily(events if days is None else events.filter(F.col("event_date").isin(sorted(days)))), days or {k[1] for k in now})
        since = None if days is None else min(days)
        carry_app_baseline(s, f"{root}/baseline", states, load(s, f"{root}/daily"), events.filter("source = 'token'"), since)
        log.record("baseline", now)
    return load(s, f"{root}/baseline")


def _newest(events: DataFrame) -> date:
    return events.agg(F.max("event_date").alias("d")).first()["d"]


def _user_scopes(rows: DataFrame, events: DataFrame) -> DataFrame:
    scopes = rows.filter("event_type = 'click'").selectExpr("'u' || event_id as unique_id", f"inline({V.SCOPE_PAIRS})")
    token = events.filter(F.col("source") == "token").select("unique_id", "user_key", "event_date")
    return scopes.join(token, "unique_id").select("user_key", "event_date", F.col("scope_name").alias("scope_key"))


def user_baseline_incremental(s: SparkSession, sf: str) -> DataFrame:
    """Baselines, breadth and sliding novelty of users over seven months, built in three parts with late rows."""
    root, rows = scratch(s), staged(spread_events(s, sf))
    log, states, items = BuildLog(s, f"{root}/_built"), Snapshots(s, f"{root}/_state"), Snapshots(s, f"{root}/_items")
    addresses = staged(V.address_table(s, sf))
    for part in (1, 2, 3):
        events = _arrivals(rows, part, f"{root}/events", _audit)
        days, now = log.pending("baseline", {"events": f"{root}/events"})
        since = None if days is None else min(days)
        scopes = _user_scopes(rows.filter(F.col("part") <= part), events)
        carry_user_baseline(
            s, f"{root}/baseline", states, items, A.user_activity_daily(events), events, scopes, addresses, _newest(events), since, NOVELTY_DAYS
        )
        log.record("baseline", now)
    return load(s, f"{root}/baseline")


def novelty_incremental(s: SparkSession, sf: str) -> DataFrame:
    """New applications per user in a window that slides over seven months, from the state of the days on which items were used."""
    root, rows = scratch(s), staged(spread_events(s, sf))
    items = Snapshots(s, f"{root}/_items")
    nothing = s.createDataFrame([], "user_key string, event_date date, scope_key string, ip_key string, asn bigint, unique_id string")
    for part in (1, 2, 3):
        events = _audit(rows.filter(F.col("part") <= part))
        today = _newest(events)
        held = items.at_most(today)
        new = _audit(rows.filter(F.col("part") == part)).agg(F.min("event_date").alias("d")).first()["d"]
        since, first = F.lit(str(new)).cast("date"), F.date_sub(F.lit(str(today)).cast("date"), NOVELTY_DAYS)
        used = B.item_days(events.filter(F.col("event_date") >= since), nothing, nothing)
        items.save(staged(B.advance_items(None if held is None else held[1], used, first, since)), today)
    counts = B.debut_counts(items.at_most(date.max)[1], NOVELTY_DAYS)
    return counts.select("user_key", "event_date", F.col(f"new_apps_count_{NOVELTY_DAYS}d").alias("new_items")).filter("new_items > 0")


def _processed_in_parts(s: SparkSession, sf: str, root: str, apps: tuple[str, ...] = APPS) -> list[Callable[[], None]]:
    """Steps that store processed events up to a day and then all; of the first part every eleventh event comes late."""

    def step(early: bool) -> None:
        for app in apps:
            rows = V.processed(s, sf, app)
            if early:
                rows = rows.filter((F.col("timestamp") < F.lit("2024-01-18 12:00:00").cast("timestamp_ntz")) & (F.crc32(F.col("unique_id").cast("binary")) % LATE_EVERY != 0))
            write_daily(rows, table_path(root, app))

    return [lambda: step(True), lambda: step(False)]


def late_rows_reach_facts(s: SparkSession, sf: str) -> DataFrame:
    """The token fact of a warehouse built twice; the second time rows up to weeks old have come."""
    root = scratch(s)
    stg = V.staged(s, sf)
    dims = {k: staged(df) for k, df in _dims(stg).items()}
    for step in _processed_in_parts(s, sf, f"{root}/processed", ("token",)):
        step()
        house = Warehouse(s, f"{root}/models", f"{root}/processed")
        house.build_staging()
        house.tables |= {"dim_user": dims["user"], "dim_ip_address": dims["ip"], "dim_application": dims["application"], "dim_scope": DIMENSIONS["dim_scope"].build({"token_scopes": house.tables["stg_token_event_scopes"]})}
        house.build_facts()
    return house.tables["fact_token_event"]


def dims_incremental(s: SparkSession, sf: str) -> DataFrame:
    """Dimensions carried on from the parts of days and months: keys with their attributes as text."""
    root = scratch(s)
    for step in _processed_in_parts(s, sf, f"{root}/processed"):
        step()
        house = Warehouse(s, f"{root}/models", f"{root}/processed")
        house.build_staging()
        house.build_dims()
    parts = []
    for name in DIMS[:3]:
        df = house.tables[name]
        texts = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in sorted(df.columns[1:])))
        parts.append(df.select(F.lit(name).alias("dimension"), F.col(df.columns[0]).alias("row_key"), texts.alias("attributes")))
    days = house.tables["dim_time"].select(F.lit("dim_time").alias("dimension"), F.col("date_day").cast("string").alias("row_key"), F.col("day_name").alias("attributes"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(days)


def merged_with_moved_keys(s: SparkSession, sf: str) -> DataFrame:
    """Events stored by day, then merged through the index of keys with new ones and with copies that move to other days."""
    path = f"{scratch(s)}/events"
    rows = V.read(s, sf, "events").select("event_id", F.col("ts").alias("timestamp"), "event_type", "value")
    rows = rows.withColumn("event_date", F.to_date("timestamp"))
    cut = F.lit(CUT).cast("timestamp_ntz")
    early = rows.filter(F.col("timestamp") < cut)
    moved = early.filter("event_id % 10 = 0").withColumns({"timestamp": F.col("timestamp") + F.expr("INTERVAL 4 DAYS"), "value": F.col("value") + 1})
    moved = moved.withColumn("event_date", F.to_date("timestamp"))
    for part in (early, rows.filter(F.col("timestamp") >= cut).unionByName(moved), moved.filter("event_id % 20 = 0")):
        merge_days(s, path, part, ["event_id"], "timestamp", indexed=True)
    return load(s, path)


# --- coverage, checks, streams ---


def manifest_coverage(s: SparkSession, sf: str) -> DataFrame:
    """Events per window of the manifests of fetch runs, read back from their files; windows are of uneven length, overlap and leave gaps."""
    path = f"{scratch(s)}/manifests"
    events = V.audit_events(s, sf).select(F.col("source").alias("app"), "timestamp")
    ranges = events.groupBy("app").agg(F.min("timestamp").cast("date").cast("timestamp").alias("start"), F.max("timestamp").cast("timestamp").alias("end"), F.count(F.lit(1)).alias("num_events"))
    starts = F.sequence(F.lit(0), F.floor((F.unix_seconds("end") - F.unix_seconds("start")) / 18000).cast("int"))
    window = F.transform(starts, lambda i: F.struct(
        i.alias("idx"), (F.col("start") + F.make_dt_interval(F.lit(0), i * 5)).alias("start"),
        (F.col("start") + F.make_dt_interval(F.lit(0), i * 5 + 2 * (1 + i % 7))).alias("end"),
    ))
    runs = ranges.withColumn("windows", window).withColumns({"run_id": F.concat(F.lit("run-"), "app"), "num_windows": F.size("windows")})
    write_manifest(runs, path)
    read = read_manifests(s, path).select("app", "run_id", F.inline("windows"))
    windows = read.select("app", "run_id", "idx", F.col("start").alias("window_start"), F.col("end").alias("window_end"))
    return interval_coverage(events, windows, ["app"], ["run_id", "idx"])


# The registered query that stands for a checked model, and a column it has under another name.
MODEL_QUERIES = {
    "fact_token_event": "fact_token", "fact_admin_event": "fact_admin", "fact_drive_event": "fact_drive", "fact_login_event": "fact_login",
    "fact_saml_event": "fact_saml", "fact_token_scope": "fact_token_scope", "fact_admin_actions_daily": "admin_actions_daily",
    "fact_geo_activity_daily": "geo_activity_daily", "fact_scope_risk_daily": "scope_risk_daily", "dq_app_event_gaps": "event_gaps",
    "fact_event_volume_hourly": "event_volume_hourly", "fact_scope_cooccurrence_daily": "scope_cooccurrence",
    "fact_admin_action_breakdown_daily": "admin_breakdown_daily", "dq_duplicate_events_daily": "duplicate_events", "fact_geo_new_regions": "new_regions",
    "fact_user_activity_baseline": "user_baseline", "fact_app_activity_baseline": "app_baseline", "agg_token_top_users_48h": "top_users",
    "agg_token_top_methods_48h": "top_methods", "agg_event_volume_spikes": "volume_spikes", "agg_token_top_apps_48h": "top_apps",
    "agg_high_risk_scopes_7d": "high_risk_summary", "agg_high_risk_scope_names_7d": "high_risk_scopes", "agg_scope_pairs_high_risk_7d": "high_risk_pairs",
    "agg_admin_action_alerts_48h": "admin_alerts", "agg_geo_recent_48h": "geo_recent", "agg_dq_dupes_30d": "recent_duplicates",
    "agg_dq_gaps_30d": "recent_gaps", "agg_token_intensity_outliers_48h": "intensity_outliers",
}
RENAMED = {"dq_app_event_gaps": ("user_key", "app_id"), "agg_dq_gaps_30d": ("user_key", "app_id")}


def model_checks(s: SparkSession, sf: str) -> DataFrame:
    """Every null and uniqueness check of every checked model, one scan of each."""
    from watchspan.plans.driver_queries import QUERIES as plain

    staged_views = V.staged(s, sf)
    tables = {f"stg_{a}_events": df for a, df in staged_views.items()}
    tables["stg_token_event_scopes"] = stage(V.token_scopes(s, sf), "token_scopes")
    for model, query in MODEL_QUERIES.items():
        tables[model] = plain[query](s, sf).withColumnsRenamed(dict([RENAMED[model]]) if model in RENAMED else {})
    return dq_report(tables)


def stream_raw_restart(s: SparkSession, sf: str) -> DataFrame:
    """Lines of drive activities with all eight faults, streamed in two runs of several batches, the last batch replayed: what is stored and what is not."""
    root = scratch(s)
    lines = V.raw_lines(s, sf, "drive", broken=True)
    sink = S.letter_sink("drive", f"{root}/events", f"{root}/letters", f"{root}/ledger")
    for part in (0, 1):
        lines.filter(F.col("event_id") % 2 == part).select("value").repartition(2).write.mode("append").text(f"{root}/raw")
        S.run_available(S.stream_lines(s, f"{root}/raw", 1), f"{root}/checkpoint", "append", sink)
    last = S.BatchLedger(s, f"{root}/ledger").last()
    sink(lines.select("value"), last)
    stored = load(s, f"{root}/events").select(F.lit("stored").alias("outcome"))
    letters = s.read.parquet(f"{root}/letters").select(F.col("error").alias("outcome"))
    return stored.unionByName(letters).groupBy("outcome").agg(F.count(F.lit(1)).alias("lines"))


# --- cursors, windows of work, control ---

AS_OF = "2024-03-01 00:00:00"
OVERLAP = 3


def _tops(s: SparkSession, sf: str) -> dict[str, datetime]:
    """Newest event time of each application, one per application."""
    rows = V.audit_events(s, sf).groupBy("source").agg(F.max("timestamp").cast("string").alias("t")).collect()
    return {r["source"]: datetime.fromisoformat(r["t"]) for r in rows}


def start_chain(s: SparkSession, sf: str) -> DataFrame:
    """Where the processor and the loader of each application start, and the days they read, each from another step of the chain."""
    path, tops = f"{scratch(s)}/control", _tops(s, sf)
    C.update_control(s, path, "token", "processor", tops["token"])
    C.update_control(s, path, "token", "loader", tops["token"])
    C.update_control(s, path, "token", "fetcher", tops["token"])
    C.update_control(s, path, "login", "fetcher", tops["login"])
    C.update_control(s, path, "drive", "fetcher", None, last_run=tops["drive"])
    earliest = {"admin": V.processed(s, sf, "admin").agg(F.min("timestamp").cast("date").alias("d")).first()["d"]}
    control, out = C.read_control(s, path), []
    for app in APPS:
        for kind in ("processor", "loader"):
            start = resolve_start(control, app, kind, AS_OF, earliest.get(app)).withColumns({"app": F.lit(app), "kind": F.lit(kind)})
            last = F.lit(str(tops[app])).cast("timestamp") if app == "login" else None
            first, end = date_window(F.col("start"), F.lit(AS_OF).cast("timestamp"), last)
            out.append(start.select("app", "kind", "start", first.alias("first_day"), end.alias("last_day")))
    return reduce(DataFrame.unionByName, out)


def cursor_after_load(s: SparkSession, sf: str) -> DataFrame:
    """The cursor of each application after slices of events, scopes and nothing were loaded."""
    rows = []
    for app in APPS:
        slices = [V.processed(s, sf, app).filter("event_type <> 'view'")]
        if app == "token":
            later = F.col("timestamp") + F.expr("INTERVAL 1 MINUTE")
            slices.append(V.token_scopes(s, sf).withColumn("timestamp", later))
        top = next_cursor(*slices)
        rows.append((app, None if top is None else str(top)))
    return s.createDataFrame(rows, "app string, cursor string").withColumn("cursor", F.col("cursor").cast("timestamp_ntz"))


def control_log(s: SparkSession, sf: str) -> DataFrame:
    """The control rows after several rounds of updates, with the log folded in between while another row is appended."""
    path, tops = f"{scratch(s)}/control", _tops(s, sf)
    for turn in (3, 2, 1, 0):
        for app, top in sorted(tops.items()):
            C.update_control(s, path, app, "processor", top - timedelta(hours=turn), run_id=f"r{turn}", updated_at=top + timedelta(days=3 - turn))
        C.compact_control(s, path)
    C.update_control(s, path, "saml", "loader", tops["saml"], updated_at=tops["saml"])
    C.reset_stages(s, path, ["admin"], ("processor",))
    C.compact_control(s, path)
    return C.read_control(s, path).select("app", "stage", "cursor", "run_id", "status")


def _landed(s: SparkSession, sf: str, root: str, apps: tuple[str, ...] = APPS) -> None:
    for app in apps:
        land_raw(split_errors(parse_lines(V.raw_lines(s, sf, app)))[0], f"{root}/raw", app, compress=app in ("token", "saml"))


def rebuilt_tables(s: SparkSession, sf: str) -> DataFrame:
    """Loaded rows by application and day after half the days were loaded from cursor to cursor and all was then rebuilt from the landed files."""
    root, apps = scratch(s), ("token", "saml")
    paths = [f"{root}/{n}" for n in ("control", "raw", "processed", "loaded")]
    _landed(s, sf, root, apps)
    control, raw, processed, loaded = paths
    for app in apps:
        C.update_control(s, control, app, "fetcher", datetime(2024, 1, 15))
        process_recent(s, control, raw, processed, app, datetime(2024, 3, 1))
        load_recent(s, control, processed, loaded, app, datetime(2024, 3, 1))
        C.update_control(s, control, app, "fetcher", datetime(2024, 2, 28))
    rebuild_tables(s, control, raw, processed, loaded, datetime(2024, 3, 1), apps)
    kinds = [("token", "events"), ("token", "event_scopes"), ("saml", "events")]
    rows = [read_processed(s, loaded, a, k).select(F.lit(a).alias("app"), F.lit(k).alias("kind"), "event_date") for a, k in kinds]
    return reduce(DataFrame.unionByName, rows).groupBy("app", "kind", "event_date").agg(F.count(F.lit(1)).alias("n"))


def day_batches(s: SparkSession, sf: str) -> DataFrame:
    """Closed ranges of seven days that cover the days of each application; the last may be shorter."""
    out = []
    for app in APPS:
        days = V.processed(s, sf, app).agg(F.min("timestamp").cast("date").alias("a"), F.max("timestamp").cast("date").alias("b")).first()
        if days["a"] is not None:
            out.append(date_batches(s, days["a"], days["b"], 7).withColumn("app", F.lit(app)))
    return reduce(DataFrame.unionByName, out)


# --- scans, sinks, models ---

DAYS = ("2024-01-08", "2024-01-17")


def raw_days(s: SparkSession, sf: str) -> DataFrame:
    """Landed activities of a closed range of days, from plain and compressed files by day and by day and hour."""
    root = scratch(s)
    _landed(s, sf, root)
    parts = [read_raw(s, f"{root}/raw", a, *DAYS).select(F.lit(a).alias("app"), "event_date", F.col("id.uniqueQualifier").alias("unique_id")) for a in APPS]
    return reduce(DataFrame.unionByName, parts).groupBy("app", "event_date").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("unique_id").alias("n_ids"))


def processed_since(s: SparkSession, sf: str) -> DataFrame:
    """Processed rows of recent days, by application and day."""
    root = scratch(s)
    for app in APPS:
        write_daily(V.processed(s, sf, app), table_path(root, app))
    parts = [read_processed(s, root, a, since=DAYS[1]).select(F.lit(a).alias("app"), "event_date", "ip_address") for a in APPS]
    return reduce(DataFrame.unionByName, parts).groupBy("app", "event_date").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("ip_address").alias("n_addresses"))


def earliest_days(s: SparkSession, sf: str) -> DataFrame:
    """The first day of each application's landed and processed tables, from their partitions."""
    root = scratch(s)
    _landed(s, sf, root)
    rows = []
    for app in APPS:
        write_daily(V.processed(s, sf, app).filter(F.col("timestamp") >= F.lit(DAYS[0]).cast("timestamp_ntz")), table_path(f"{root}/processed", app))
        first = min(stored_days(s, app_path(f"{root}/raw", app)), default=None)
        rows.append((app, first, earliest_partition(read_processed(s, f"{root}/processed", app))))
    return s.createDataFrame(rows, "app string, raw_day date, processed_day date")


def scope_dedup(s: SparkSession, sf: str) -> DataFrame:
    """Scope rows with repeats, kept once per event, scope and bucket, where a missing bucket is one too; the latest counts."""
    rows = V.token_scopes(s, sf)
    later = rows.filter("crc32(cast(unique_id as binary)) % 3 = 0").withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 SECOND"))
    bare = rows.filter("crc32(cast(unique_id as binary)) % 3 = 1").withColumn("product_bucket", F.lit(None).cast("string"))
    return dedup_latest(rows.unionByName(later).unionByName(bare).unionByName(rows), SCOPE_KEYS)


def merged_with_new_column(s: SparkSession, sf: str) -> DataFrame:
    """A merged model that gets a new column and loses one: old rows have null there."""
    path, name = f"{scratch(s)}/model", "watchspan_wider_model"
    rows = V.read(s, sf, "events").select("event_id", F.col("ts").alias("timestamp"), F.to_date("ts").alias("event_date"), "event_type", "value")
    materialize(rows.filter("event_id % 2 = 0 or event_id % 5 = 0"), name, "incremental", path, ["event_id"])
    wider = rows.filter("event_id % 2 = 1").drop("event_type").withColumn("doubled", F.col("value") * 2)
    return materialize(wider, name, "incremental", path, ["event_id"])


def materialized_models(s: SparkSession, sf: str) -> DataFrame:
    """Source views, an empty table made from a schema, and a view, a table and a merged model, read by their names."""
    root = scratch(s)
    for app in APPS:
        write_daily(V.processed(s, sf, app), table_path(root, app))
    write_daily(conform(classify_scopes(V.token_scopes(s, sf)), SCOPE_SCHEMA), table_path(root, "token", "event_scopes"))
    names = register_sources(s, root)
    # a name of its own: the folder of an earlier session's table may still be in the warehouse
    made = f"watchspan_empty_{uuid.uuid4().hex}"
    ensure_table(s, made, processed_schema("token"))
    users = s.table("token_events").groupBy("actor_email").agg(F.count(F.lit(1)).alias("n"), F.max("timestamp").cast("date").alias("event_date"))
    for kind in ("view", "table", "incremental"):
        materialize(users, f"watchspan_users_{kind}", kind, f"{root}/{kind}", ["actor_email"])
        names.append(f"watchspan_users_{kind}")
    materialize(users.withColumn("n", F.col("n") + 1), "watchspan_users_incremental", "incremental", f"{root}/incremental", ["actor_email"])
    counts = [s.table(n).select(F.lit(n).alias("model")).groupBy("model").agg(F.count(F.lit(1)).alias("rows")) for n in names]
    empty = s.table(made).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("watchspan_empty").alias("model"), "rows")
    total = s.table("watchspan_users_incremental").agg(F.sum("n").alias("rows")).select(F.lit("sum of n").alias("model"), "rows")
    return reduce(DataFrame.unionByName, [*counts, empty, total])


def census_csv(s: SparkSession, sf: str) -> DataFrame:
    """The census of scopes, written as CSV and read back as text fields."""
    path = f"{scratch(s)}/census"
    write_scope_census(scope_census(split_errors(parse_lines(V.raw_lines(s, sf, "token")))[0]), path)
    return s.read.option("header", True).option("nullValue", "\0").csv(path).withColumn("count", F.col("count").cast("bigint")).fillna("", ["product_bucket"])


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        app_baseline_incremental, user_baseline_incremental, novelty_incremental, late_rows_reach_facts, dims_incremental, merged_with_moved_keys,
        manifest_coverage, model_checks, stream_raw_restart, start_chain, cursor_after_load, control_log, rebuilt_tables, day_batches,
        raw_days, processed_since, earliest_days, scope_dedup, merged_with_new_column, materialized_models, census_csv,
    )
}
