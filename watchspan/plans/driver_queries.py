"""Every operator as a query on the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from watchspan.functions import max_literal, scope_service_census, scope_suffix, surrogate_key
from watchspan.operators import activity as A
from watchspan.operators import baseline as B
from watchspan.operators import drift as DR
from watchspan.operators import incremental as I
from watchspan.operators import normalize as N
from watchspan.operators import overlap as O
from watchspan.operators import quality as Q
from watchspan.operators.cooccurrence import cooccurrence_daily, tasks_for
from watchspan.operators.dedup import dedup_any, dedup_latest, dedup_report
from watchspan.plans import dims as D
from watchspan.plans import driver_views as V
from watchspan.plans import reporting as R
from watchspan.plans.facts import fact, fact_scope
from watchspan.plans.ingest import ingest
from watchspan.plans.staging import stage
from watchspan.schemas import APPS
from watchspan.session import configure, ensure_checkpoint_dir
from watchspan.sources.census import scope_census
from watchspan.sources.manifests import manifest_rows
from watchspan.sources.processed import read_processed
from watchspan.sources.raw import land_raw, parse_lines, read_raw_any, split_errors
from watchspan.sources.warehouse import merge_days, replace_days, staged, write_days
from watchspan.streaming import activity_stream as S

Query = Callable[[SparkSession, str], DataFrame]

# Parameters that keep the results telling on a month of events.
CUT = "2024-01-20 00:00:00"
REPEAT_EVERY = 10
SPIKE_SIGMA = 2.0
NEW_REGION_DAYS = 10
NOVELTY_DAYS = 20


def comparable(df: DataFrame) -> DataFrame:
    """Plain column types: zone-less times, 64-bit integers, rounded doubles, lists as text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), ",")
        out.append(c.alias(f.name))
    return df.select(*out)


def scratch(spark: SparkSession) -> str:
    """A new folder on the storage all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/scratch-{uuid.uuid4().hex}"


def _today(spark: SparkSession, sf: str) -> Column:
    return F.to_date(max_literal(V.read(spark, sf, "events"), "ts"))


def _ship_day(spark: SparkSession, sf: str) -> Column:
    return F.to_date(max_literal(V.read(spark, sf, "lineitem"), "l_shipdate"))


def repeated_events(spark: SparkSession, sf: str) -> DataFrame:
    """All activities, every tenth twice: the copy is a second younger and has other bytes."""
    rows = V.with_k(V.read(spark, sf, "events"))
    copy = rows.filter(F.col("event_id") % REPEAT_EVERY == 0).selectExpr(
        "event_id", "ts + interval 1 second as ts", "user_id", "event_type", "value + 1 as value", "props", "k"
    )
    return stage(rows.unionByName(copy).selectExpr(*V.select_list(V.AUDIT, "array")), "")


# --- reports ---


def top_users(s: SparkSession, sf: str) -> DataFrame:
    return R.top_users(V.audit_events(s, sf))


def top_user(s: SparkSession, sf: str) -> DataFrame:
    return R.top_users(V.audit_events(s, sf), limit=1).select("actor_email", "actor_profile_id", "event_count")


def top_methods(s: SparkSession, sf: str) -> DataFrame:
    return R.top_methods(V.audit_events(s, sf))


def top_method(s: SparkSession, sf: str) -> DataFrame:
    return R.top_methods(V.audit_events(s, sf), limit=1).select("method_name", "total_bytes")


def top_apps(s: SparkSession, sf: str) -> DataFrame:
    return R.top_apps(V.audit_events(s, sf))


def intensity_outliers(s: SparkSession, sf: str) -> DataFrame:
    return R.intensity_outliers(V.audit_events(s, sf))


def last_hours(s: SparkSession, sf: str) -> DataFrame:
    return R.last_hours(V.audit_events(s, sf), 48).select("unique_id", "timestamp", "num_bytes")


def volume_spikes(s: SparkSession, sf: str) -> DataFrame:
    as_of = max_literal(V.read(s, sf, "events"), "ts")
    return R.volume_spikes(A.volume_hourly(V.audit_events(s, sf)), as_of, SPIKE_SIGMA)


def high_risk_summary(s: SparkSession, sf: str) -> DataFrame:
    return R.high_risk_summary(A.scope_risk_daily(V.baskets(s, sf)), _ship_day(s, sf))


def high_risk_scopes(s: SparkSession, sf: str) -> DataFrame:
    rows = V.baskets(s, sf)
    return R.high_risk_scopes(rows, D.dim_scope(rows), _ship_day(s, sf))


def high_risk_pairs(s: SparkSession, sf: str) -> DataFrame:
    """The pairs of the report's days only, stored by day as the report reads them."""
    path, today, n = scratch(s), _ship_day(s, sf), V.read(s, sf, "lineitem").count()
    write_days(cooccurrence_daily(V.baskets(s, sf, tasks_for(s, n)), since=F.date_sub(today, 7), rows=n), f"{path}/pairs")
    D.dim_scope(V.baskets(s, sf)).write.parquet(f"{path}/scopes")
    return R.high_risk_pairs(s.read.parquet(f"{path}/pairs"), s.read.parquet(f"{path}/scopes"), today)


def admin_alerts(s: SparkSession, sf: str) -> DataFrame:
    return R.admin_alerts(A.admin_breakdown_daily(V.audit_events(s, sf)), _today(s, sf))


def geo_recent(s: SparkSession, sf: str) -> DataFrame:
    return R.geo_recent(A.geo_daily(V.audit_events(s, sf), V.address_table(s, sf)), _today(s, sf))


def recent_duplicates(s: SparkSession, sf: str) -> DataFrame:
    return R.dq_dupes(Q.duplicates_daily(repeated_events(s, sf)), _today(s, sf))


def recent_gaps(s: SparkSession, sf: str) -> DataFrame:
    return R.dq_gaps(event_gaps(s, sf), _today(s, sf), "user_key")


# --- aggregates ---


def user_activity_daily(s: SparkSession, sf: str) -> DataFrame:
    return A.user_activity_daily(V.audit_events(s, sf))


def app_activity_daily(s: SparkSession, sf: str) -> DataFrame:
    return A.app_activity_daily(V.audit_events(s, sf))


def ip_activity_daily(s: SparkSession, sf: str) -> DataFrame:
    return A.ip_activity_daily(V.audit_events(s, sf))


def geo_activity_daily(s: SparkSession, sf: str) -> DataFrame:
    return A.geo_daily(V.audit_events(s, sf), V.address_table(s, sf))


def new_regions(s: SparkSession, sf: str) -> DataFrame:
    return A.new_regions(V.audit_events(s, sf), _today(s, sf), NEW_REGION_DAYS)


def event_volume_hourly(s: SparkSession, sf: str) -> DataFrame:
    return A.volume_hourly(V.audit_events(s, sf))


def admin_actions_daily(s: SparkSession, sf: str) -> DataFrame:
    return A.admin_actions_daily(V.audit_events(s, sf))


def admin_breakdown_daily(s: SparkSession, sf: str) -> DataFrame:
    return A.admin_breakdown_daily(V.audit_events(s, sf))


def scope_usage_daily(s: SparkSession, sf: str) -> DataFrame:
    return A.scope_usage_daily(V.baskets(s, sf))


def scope_risk_daily(s: SparkSession, sf: str) -> DataFrame:
    return A.scope_risk_daily(V.baskets(s, sf))


def scope_cooccurrence(s: SparkSession, sf: str) -> DataFrame:
    n = V.read(s, sf, "lineitem").count()
    return cooccurrence_daily(V.baskets(s, sf, tasks_for(s, n)), rows=n)


def app_baseline(s: SparkSession, sf: str) -> DataFrame:
    events = V.audit_events(s, sf)
    return B.app_baseline(A.app_activity_daily(events), events.filter(F.col("source") == "token"))


def user_baseline(s: SparkSession, sf: str) -> DataFrame:
    events = V.audit_events(s, sf)
    scopes = V.token_scopes(s, sf).join(
        events.filter(F.col("source") == "token").select("unique_id", "user_key", "event_date"), "unique_id"
    )
    scopes = scopes.select("user_key", "event_date", F.col("scope_name").alias("scope_key"))
    return B.user_baseline(
        A.user_activity_daily(events), events, scopes, V.address_table(s, sf), _today(s, sf), novelty_days=NOVELTY_DAYS
    )


def novelty(s: SparkSession, sf: str) -> DataFrame:
    return B.novelty(V.audit_events(s, sf), "user_key", "app_id", "event_date", _today(s, sf), NOVELTY_DAYS)


def _app_scope_days(s: SparkSession, sf: str) -> DataFrame:
    rows = V.with_k(V.read(s, sf, "events"))
    return rows.selectExpr("event_type as app_id", "cast(k as string) as scope_key", "cast(ts as date) as event_date")


def scope_drift_daily(s: SparkSession, sf: str) -> DataFrame:
    return DR.set_drift_daily(_app_scope_days(s, sf))


def scope_drift_items(s: SparkSession, sf: str) -> DataFrame:
    return DR.set_drift_items(_app_scope_days(s, sf))


def client_scope_drift(s: SparkSession, sf: str) -> DataFrame:
    """Drift of the scopes of each client application, from scope rows joined to their events."""
    scopes = stage(V.token_scopes(s, sf), "token_scopes").withColumnRenamed("scope_name", "scope_key")
    events = V.staged(s, sf)["token"].withColumnRenamed("client_id", "app_id")
    return DR.set_drift_daily(DR.app_scopes(scopes, events))


# --- data quality ---


def event_gaps(s: SparkSession, sf: str) -> DataFrame:
    events = V.audit_events(s, sf)
    bounds = D.day_bounds([events])
    return Q.event_gaps(A.user_activity_daily(events), bounds, _today(s, sf), "user_key")


def duplicate_events(s: SparkSession, sf: str) -> DataFrame:
    return Q.duplicates_daily(repeated_events(s, sf))


def dq_report(s: SparkSession, sf: str) -> DataFrame:
    rows = repeated_events(s, sf)
    return (
        Q.check_not_null(rows, ["unique_id", "timestamp", "user_key", "app_id", "num_bytes"], "events")
        .unionByName(Q.check_unique(rows, ["unique_id"], "events"))
        .unionByName(Q.check_unique(rows, ["user_key", "event_hour"], "events"))
    )


def misplaced_rows(s: SparkSession, sf: str) -> DataFrame:
    rows = V.read(s, sf, "events").selectExpr(
        "event_id", "ts", "case when event_id % 50 = 0 then ts + interval 1 hour else ts end as stored_hour"
    )
    return Q.misplaced_rows(rows, "ts", "stored_hour").select("event_id", "ts")


# --- dimensions and facts ---


def dim_user(s: SparkSession, sf: str) -> DataFrame:
    return D.dim_user(V.staged(s, sf))


def dim_ip(s: SparkSession, sf: str) -> DataFrame:
    return D.dim_ip(V.staged(s, sf))


def dim_application(s: SparkSession, sf: str) -> DataFrame:
    return D.dim_application(V.staged(s, sf))


def dim_scope(s: SparkSession, sf: str) -> DataFrame:
    return D.dim_scope(V.baskets(s, sf))


def dim_time(s: SparkSession, sf: str) -> DataFrame:
    return D.dim_time(V.staged(s, sf))


def _dims(stg: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {"user": D.dim_user(stg), "ip": D.dim_ip(stg), "application": D.dim_application(stg)}


def _fact(app: str) -> Query:
    def query(s: SparkSession, sf: str) -> DataFrame:
        stg = V.staged(s, sf)
        return fact(app, stg, _dims(stg))

    return query


def fact_token_scope(s: SparkSession, sf: str) -> DataFrame:
    stg = V.staged(s, sf)
    scopes = stage(N.classify_scopes(V.token_scopes(s, sf)), "token_scopes")
    return fact_scope(stg, scopes, {**_dims(stg), "scope": D.dim_scope(scopes)})


# --- incremental ---


def incremental_upsert(s: SparkSession, sf: str) -> DataFrame:
    """A token fact built up to the cut and then carried on equals the fact built at once."""
    stg = V.staged(s, sf)
    dims = {k: staged(df) for k, df in _dims(stg).items()}
    before = {**stg, "token": stg["token"].filter(F.col("timestamp") < F.lit(CUT).cast("timestamp_ntz"))}
    target = fact("token", before, dims)
    return I.upsert(target, fact("token", stg, dims, target), ["unique_id"], "timestamp")


def merged_table(s: SparkSession, sf: str) -> DataFrame:
    """Events stored by day, then merged with younger copies of some of them."""
    rows = repeated_events(s, sf).select("unique_id", "timestamp", "event_date", "source", "num_bytes")
    path = f"{scratch(s)}/merged"
    bound = F.lit(CUT).cast("timestamp_ntz")
    merge_days(s, path, rows.filter(F.col("timestamp") < bound), ["unique_id"], "timestamp")
    merge_days(s, path, rows.filter(F.col("timestamp") >= bound - F.expr("INTERVAL 5 MINUTES")), ["unique_id"], "timestamp")
    return s.read.parquet(path)


def replaced_days(s: SparkSession, sf: str) -> DataFrame:
    """Daily totals stored up to the cut, then the last stored day and the following ones made anew."""
    events = V.audit_events(s, sf)
    path = f"{scratch(s)}/daily"
    write_days(A.user_activity_daily(events.filter(F.col("timestamp") < F.lit(CUT).cast("timestamp_ntz"))), path)
    newest = s.read.parquet(path).agg(F.date_sub(F.max("event_date"), 1).alias("d")).first()["d"]
    replace_days(s, path, A.user_activity_daily(events.filter(F.col("event_date") >= F.lit(newest))), newest)
    return s.read.parquet(path)


def tail_replace(s: SparkSession, sf: str) -> DataFrame:
    rows = V.audit_events(s, sf).select("unique_id", "timestamp", "num_bytes")
    old = rows.filter(F.col("timestamp") < F.lit("2024-01-25").cast("timestamp_ntz")).withColumn("load", F.lit("first"))
    return I.replace_tail(old, rows.withColumn("load", F.lit("second")), "timestamp", CUT)


def latest_rows(s: SparkSession, sf: str) -> DataFrame:
    return dedup_latest(repeated_events(s, sf).select("unique_id", "timestamp", "source", "num_bytes"), ["unique_id"])


def distinct_keys(s: SparkSession, sf: str) -> DataFrame:
    return dedup_any(repeated_events(s, sf).select("unique_id", "source", "user_key"), ["unique_id"])


def repeat_counts(s: SparkSession, sf: str) -> DataFrame:
    return dedup_report(repeated_events(s, sf), ["unique_id"])


def _windows(s: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    events = V.audit_events(s, sf).select("source", "timestamp")
    ranges = events.groupBy("source").agg(
        F.min("timestamp").cast("date").cast("timestamp_ntz").alias("start"), F.max("timestamp").alias("end")
    )
    windows = I.split_windows(ranges, "start", "end", I.window_hours(F.col("source")))
    return windows, I.run_coverage(events, windows, ["source"])


def run_coverage(s: SparkSession, sf: str) -> DataFrame:
    windows, covered = _windows(s, sf)
    return windows.select("source", "idx", "window_start", "window_end").join(covered, ["source", "idx"], "left")


def run_manifests(s: SparkSession, sf: str) -> DataFrame:
    windows, covered = _windows(s, sf)
    rows = manifest_rows(windows, covered, ["source"], "start", "end")
    return rows.withColumn("windows", F.size("windows"))


def _manifests(s: SparkSession, sf: str) -> DataFrame:
    return run_coverage(s, sf).select(
        F.col("source").alias("app"),
        F.col("window_start").alias("start"),
        F.col("window_end").alias("end"),
        "earliest_event_time",
        "latest_event_time",
    )


def overlap_estimate(s: SparkSession, sf: str) -> DataFrame:
    return O.estimate_overlap(_manifests(s, sf))


def overlap_of_all_apps(s: SparkSession, sf: str) -> DataFrame:
    """The estimate when only three applications have manifests: the others have rows without runs."""
    return O.estimate_overlap(_manifests(s, sf).filter(F.col("app").isin("token", "admin", "login")), apps=APPS)


def overlap_total(s: SparkSession, sf: str) -> DataFrame:
    return O.estimate_overlap_total(O.estimate_overlap(_manifests(s, sf)))


# --- raw logs ---


def _usable(s: SparkSession, sf: str, app: str) -> DataFrame:
    return split_errors(parse_lines(V.raw_lines(s, sf, app)))[0]


def _flatten(app: str) -> Query:
    return lambda s, sf: N.normalize(_usable(s, sf, app), app)


def _all_apps(of_app: Callable[[str], DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, (of_app(a) for a in APPS))


def flatten_generic(s: SparkSession, sf: str) -> DataFrame:
    rows = _all_apps(lambda app: N.flatten_generic(_usable(s, sf, app)).withColumn("app", F.lit(app)))
    named = F.col("parameters")
    return rows.select(
        "app", "unique_id", "actor_email", "asn",
        F.coalesce(F.size(named), F.lit(0)).alias("n_parameters"),
        F.try_element_at(named, F.lit("login_type")).alias("login_type"),
        F.try_element_at(named, F.lit("is_suspicious")).alias("is_suspicious"),
    )


def dead_letters(s: SparkSession, sf: str) -> DataFrame:
    """Lines of all applications that break one of the eight rules."""
    bad = _all_apps(lambda app: split_errors(parse_lines(V.raw_lines(s, sf, app, broken=True)))[1].withColumn("app", F.lit(app)))
    return bad.groupBy("app", "error").agg(F.count(F.lit(1)).alias("lines"))


def scope_explode(s: SparkSession, sf: str) -> DataFrame:
    return N.explode_scopes(_usable(s, sf, "token"))


def scope_classify(s: SparkSession, sf: str) -> DataFrame:
    rows = N.classify_scopes(V.token_scopes(s, sf))
    name = F.col("scope_name")
    rows = rows.withColumns({"scope_suffix": scope_suffix(name), "census_service": scope_service_census(name)})
    by = ["scope_name", "product_bucket", "scope_family", "scope_suffix", "service", "census_service", "is_readonly"]
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def census(s: SparkSession, sf: str) -> DataFrame:
    return scope_census(_usable(s, sf, "token"))


def mixed_shapes(s: SparkSession, sf: str) -> DataFrame:
    """Activities of all applications in files of lines (batches, arrays, single objects) and in pretty-printed files, unpacked again."""
    path = scratch(s)
    for app in APPS:
        rows = V.raw_lines(s, sf, app)
        rows.filter("event_id % 5 <> 4").selectExpr(
            "case event_id % 3 when 0 then '{\"items\": [' || value || ']}' when 1 then '[' || value || ', ' || value || ']' "
            "else value end as value"
        ).write.text(f"{path}/{app}/doc=-1")
        # one document over many lines per file, of a fiftieth of the rows each
        documents = rows.filter("event_id % 5 = 4").groupBy(F.expr("event_id % 50 as doc")).agg(
            F.expr("'{\"items\": [\n' || array_join(sort_array(collect_list(value)), ',\n') || '\n]}'").alias("value")
        )
        documents.write.mode("append").partitionBy("doc").text(f"{path}/{app}")
    files = _all_apps(lambda app: read_raw_any(s, f"{path}/{app}", "auto").select(F.lit(app).alias("app"), F.col("id.uniqueQualifier").alias("unique_id")))
    return files.groupBy("app", "unique_id").agg(F.count(F.lit(1)).alias("n"))


def ingested_table(s: SparkSession, sf: str) -> DataFrame:
    """Raw files landed by day, then parsed, deduplicated and stored by day."""
    path = scratch(s)
    for app in APPS:
        land_raw(_usable(s, sf, app), f"{path}/raw", app, compress=app != "login")
        ingest(s, f"{path}/raw", f"{path}/processed", app)
    shared = [c for c in V.BASE if c != "application_name"]
    return _all_apps(lambda app: read_processed(s, f"{path}/processed", app).select(F.lit(app).alias("app"), *shared))


def surrogate_keys(s: SparkSession, sf: str) -> DataFrame:
    return V.audit_events(s, sf).select(
        "unique_id", surrogate_key("user_key", "event_date", "num_bytes", "impersonation").alias("row_key")
    )


# --- streaming ---


def _stream(s: SparkSession, sf: str) -> DataFrame:
    schema = V.read(s, sf, "events").schema
    return s.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def stream_volume(s: SparkSession, sf: str) -> DataFrame:
    """Hourly counts of a stream in six files, in which every tenth event comes twice and every seventh a file late."""
    path = scratch(s)
    rows = V.read(s, sf, "events").selectExpr("event_type as source", "ts as timestamp", "event_id as unique_id", "cast((extract(day from ts) - 1) / 5 as int) as file")
    sent = rows.withColumn("file", F.least(F.col("file") + (F.col("unique_id") % 7 == 0).cast("int"), F.lit(5)))
    again = sent.filter("unique_id % 10 = 0").withColumn("file", F.least(F.col("file") + 1, F.lit(5)))
    sent = staged(sent.unionByName(again))
    for i in range(6):
        sent.filter(F.col("file") == i).drop("file").coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = s.readStream.schema(sent.drop("file").schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    counted = S.stream_volume(S.dedup_stream(S.with_lateness(stream, lateness="11 days")))
    S.run_available(counted, f"{path}/checkpoint", "update", S.hourly_sink(f"{path}/volume"))
    return s.read.parquet(f"{path}/volume").drop("event_date")


def stream_merge(s: SparkSession, sf: str) -> DataFrame:
    path = scratch(s)
    rows = V.with_k(_stream(s, sf)).selectExpr("'u' || event_id as unique_id", "ts as timestamp", "event_type", "value")
    S.run_available(rows, f"{path}/checkpoint", "append", S.merge_sink(f"{path}/events", ["unique_id"]))
    return s.read.parquet(f"{path}/events").drop("event_date")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        top_users, top_user, top_methods, top_method, top_apps, intensity_outliers, last_hours, volume_spikes,
        high_risk_summary, high_risk_scopes, high_risk_pairs, admin_alerts, geo_recent, recent_duplicates, recent_gaps,
        user_activity_daily, app_activity_daily, ip_activity_daily, geo_activity_daily, new_regions, event_volume_hourly,
        admin_actions_daily, admin_breakdown_daily, scope_usage_daily, scope_risk_daily, scope_cooccurrence,
        app_baseline, user_baseline, novelty, scope_drift_daily, scope_drift_items, client_scope_drift,
        event_gaps, duplicate_events, dq_report, misplaced_rows,
        dim_user, dim_ip, dim_application, dim_scope, dim_time, fact_token_scope,
        incremental_upsert, merged_table, replaced_days, tail_replace, latest_rows, distinct_keys, repeat_counts,
        run_coverage, run_manifests, overlap_estimate, overlap_of_all_apps, overlap_total,
        flatten_generic, dead_letters, scope_explode, scope_classify, census, mixed_shapes, ingested_table,
        surrogate_keys, stream_volume, stream_merge,
    )
}
QUERIES |= {f"fact_{a}": _fact(a) for a in APPS}
QUERIES |= {f"flatten_{a}": _flatten(a) for a in APPS}


def _checked(query: Query) -> Query:
    return lambda spark, sf_dir: comparable(query(configure(spark), sf_dir))


def all_queries() -> dict[str, Query]:
    from watchspan.plans.driver_history import QUERIES as history  # it uses helpers of this module

    return {name: _checked(q) for name, q in (QUERIES | history).items()}
