"""Event facts: staged rows with the keys of their dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from watchspan.functions.keys import surrogate_key
from watchspan.operators.incremental import high_water, since_max
from watchspan.operators.joins import fits_broadcast, heavy_hashes, lookup_join

LATENESS = "5 minutes"
USER = ["actor_profile_id", "actor_email"]
_TIME = ["unique_id", "timestamp", "event_date", "event_hour"]
_KEYS = ["user_key", "ip_key", *USER, "ip_address", "customer_id"]
_GEO = ["region_code", "subdivision_code"]
_EVENT = ["event_type", "event_name"]

# What each fact exposes after the shared columns, in order.
_OWN = {
    "token": ["app_id", "app_name", "client_type", "api_name", "accessing_app_name", *_GEO, "num_bytes",
              "scope_count", "has_drive_scope", "has_gmail_scope", "has_admin_scope", *_EVENT, "method_name",
              "product_buckets"],
    "admin": ["app_id", "oauth_app_name_dim", "client_type", "api_name", "application_name", "oauth_app_name",
              *_GEO, "resource_detail_count", "caller_type", "impersonation", *_EVENT],
    "drive": ["app_id", "app_name", "client_type", "api_name", *_GEO, "resource_detail_count", "resource_id_count",
              "applied_label_count", "primary_event", "billable", "actor_is_collaborator_account", "user_query",
              "parsed_query", "originating_app_id", "applied_label_titles", *_EVENT],
    "login": [*_GEO, "resource_detail_count", "is_suspicious", "login_type", "login_challenge_methods", *_EVENT],
    "saml": [*_GEO, "orgunit_path", "initiated_by", "saml_sp_name", "saml_status_code",
             "saml_second_level_status_code", "saml_failure_type", *_EVENT],
}
_APP_COLUMN = {"token": "client_id", "admin": "oauth_client_id", "drive": "oauth_client_id"}


def _keyed(base: DataFrame, dims: dict[str, DataFrame], spread_by: str, hot: dict[str, list[int]]) -> DataFrame:
    """Add user and address keys."""
    rows = lookup_join(base, dims["user"].select(*USER, "user_key"), USER, spread_by, hot=hot["user"])
    return lookup_join(rows, dims["ip"].select("ip_address", "ip_key"), ["ip_address"], spread_by, hot=hot["ip"])


def _hot_keys(tables: list[DataFrame], frames: list[tuple[DataFrame, dict[str, list[str]]]]) -> dict[str, list[int]]:
    """Hot keys of all lookups from one pass over the narrow base rows; no pass where every table is small enough to broadcast."""
    if all(fits_broadcast(t) for t in tables):
        return {name: [] for _, keys in frames for name in keys}
    return heavy_hashes(frames)


def fact(
    app: str,
    stg: dict[str, DataFrame],
    dims: dict[str, DataFrame],
    target: DataFrame | None = None,
    lookback: str = LATENESS,
) -> DataFrame:
    """Rows of an event fact. With a target only rows from its last time minus the lookback on.

    Rows with a null profile or e-mail get no user key: equality never holds for them.
    """
    base = stg[app] if target is None else since_max(stg[app], target, "timestamp", lookback, day="event_date")
    names = {"user": USER, "ip": ["ip_address"]} | ({"app": [_APP_COLUMN[app]]} if app in _APP_COLUMN else {})
    tables = [dims[n] for n in ("user", "ip", "application") if n != "application" or app in _APP_COLUMN]
    hot = _hot_keys(tables, [(base, names)])
    rows = _keyed(base, dims, "unique_id", hot)
    if app in _APP_COLUMN:
        # the application's attributes come from the dimension, not from the event
        attrs = ["app_name", "client_type", "api_name"]
        rows = rows.withColumnRenamed(_APP_COLUMN[app], "app_id").drop("app_name", "client_type", "api_name")
        rows = lookup_join(
            rows, dims["application"].select("app_id", *attrs), ["app_id"], "unique_id", hot=hot["app"],
        )
        if app == "admin":
            rows = rows.withColumnRenamed("app_name", "oauth_app_name_dim")
    return rows.withColumn("hour_of_day", F.hour("timestamp")).select(*_TIME, "hour_of_day", *_KEYS, *_OWN[app])


def fact_scope(
    stg: dict[str, DataFrame],
    scopes: DataFrame,
    dims: dict[str, DataFrame],
    target: DataFrame | None = None,
    lookback: str = LATENESS,
) -> DataFrame:
    """Scope rows with the keys of the event they belong to."""
    base, events = scopes, stg["token"]
    if target is not None:
        base = since_max(scopes, target, "timestamp", lookback, day="event_date")
        # a scope row is never later than the row kept of its event, so older days of events are not needed
        floor = high_water(target, "timestamp", scopes.schema["timestamp"].dataType.simpleString(), "event_date")
        events = events.filter(F.col("event_date") >= F.to_date(floor - F.expr(f"INTERVAL {lookback}")))
    events = events.select("unique_id", *USER, "ip_address")
    frames = [(events, {"user": USER, "ip": ["ip_address"]}), (base, {"event": ["unique_id"], "scope": ["scope_name"]})]
    hot = _hot_keys([events, dims["user"], dims["ip"], dims["scope"]], frames)
    rows = lookup_join(base, events, ["unique_id"], "scope_name", hot=hot["event"])
    # scopes of one event share its user and address, so rows of a key differ by event or by scope
    rows = rows.withColumn("_spread", F.xxhash64("unique_id", "scope_name"))
    rows = _keyed(rows, dims, "_spread", hot)
    rows = lookup_join(rows, dims["scope"].select("scope_name", "scope_key"), ["scope_name"], "unique_id", hot=hot["scope"])
    return rows.select(
        surrogate_key("unique_id", "scope_name").alias("token_scope_key"),
        *_TIME,
        F.hour("timestamp").alias("hour_of_day"),
        "user_key", "ip_key", "scope_key", "scope_name", "scope_family", "product_bucket", "service", "is_readonly",
    )


def all_events(facts: dict[str, DataFrame]) -> DataFrame:
    """The five facts as one frame with their source; scans keep only the columns later used."""
    cols = ["unique_id", "timestamp", "event_date", "event_hour", "user_key", "ip_key", "app_id", *_GEO, "num_bytes"]
    parts = [f.select([c for c in cols if c in f.columns]).withColumn("source", F.lit(s)) for s, f in facts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
