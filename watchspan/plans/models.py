"""The whole model build, in order, from processed tables to report views."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from watchspan.functions.times import max_literal
from watchspan.operators import activity as A
from watchspan.operators import baseline as B
from watchspan.operators.cooccurrence import cooccurrence_daily
from watchspan.operators.drift import app_scopes, set_drift_daily, set_drift_items
from watchspan.operators.quality import CHECKS, dq_report, duplicates_daily, event_gaps
from watchspan.plans import reporting as R
from watchspan.plans.carry import carry_app_baseline, carry_dimension, carry_user_baseline
from watchspan.plans.dims import DIMENSIONS, calendar
from watchspan.plans.facts import all_events, fact, fact_scope
from watchspan.plans.staging import stage
from watchspan.schemas import APPS
from watchspan.sources.changes import BuildLog, Snapshots, Versions
from watchspan.sources.processed import read_processed, table_path
from watchspan.sources.warehouse import DAY, materialize, replace_listed_days, stored_days, write_whole


FACT_ORDER = ("token", "admin", "login", "drive", "saml")
DIMS = ("dim_user", "dim_ip_address", "dim_application", "dim_scope")


class Cut:
    """Cuts inputs to the days a build reads; None cuts nothing."""

    def __init__(self, days: list[date] | None):
        self.days = days

    def __call__(self, source: DataFrame) -> DataFrame:
        return source if self.days is None else source.filter(F.col(DAY).isin(self.days))

    def onward(self, source: DataFrame) -> DataFrame:
        return source.filter(F.col(DAY) >= F.lit(self.days[0])) if self.days else source


class Warehouse:
    """Builds and holds the models below one folder.

    A first or full build computes everything. A later build asks for each model which days of its inputs changed since the
    model was last built, and makes these days anew, whether they are new or hold rows that came late. Baselines, novelty and
    dimensions, which reach beyond a day, are carried on from states below `_state`.
    """

    def __init__(self, spark: SparkSession, root: str, processed: str, as_of=None, full_refresh: bool = False):
        self.spark, self.root, self.processed, self.full_refresh = spark, root, processed, full_refresh
        self.tables: dict[str, DataFrame] = {}
        self.log = BuildLog(spark, f"{root}/_built")
        self._as_of = as_of

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def view(self, name: str, df: DataFrame) -> DataFrame:
        self.tables[name] = materialize(df, name, "view")
        return df

    def table(self, name: str, df: DataFrame) -> DataFrame:
        self.tables[name] = materialize(df, name, "table", self.path(name))
        return self.tables[name]

    def _keep(self, name: str, schema: T.StructType) -> DataFrame:
        """The stored model with its own schema: an empty one has no file to tell it, and old files lack new columns."""
        return self.view(name, self.spark.read.schema(schema).parquet(self.path(name)))

    def _pending(self, name: str, inputs: list[str]) -> tuple[set[date] | None, Versions]:
        """Days to make anew, None for all; inputs are models, or processed tables as paths."""
        days, now = self.log.pending(name, {i: i if "/" in i else self.path(i) for i in inputs})
        return (None if self.full_refresh else days), now

    def by_day(self, name: str, inputs: list[str], build: Callable[[Cut], DataFrame], ahead: int = 0) -> DataFrame:
        """A model whose rows of a day depend on that day of its inputs, and on up to `ahead` days before it.

        `build` gets a function that cuts an input to the days needed (`cut.onward`: to the first of them and all later ones).
        """
        days, now = self._pending(name, inputs)
        if days is None:
            df = build(Cut(None))
            write_whole(df, self.path(name))
        else:
            made = {d + timedelta(days=i) for d in days for i in range(ahead + 1)}
            read = sorted({d - timedelta(days=i) for d in made for i in range(ahead + 1)})
            df = build(Cut(read))
            replace_listed_days(self.spark, self.path(name), df, made)
        self.log.record(name, now)
        return self._keep(name, df.schema)

    def processed_paths(self, *apps: str) -> list[str]:
        return [table_path(self.processed, a) for a in apps]

    def scopes_path(self) -> str:
        return table_path(self.processed, "token", "event_scopes")

    # --- the build ---

    def as_of(self) -> Column:
        """End of the report windows: given, or the newest event time, read from each source's newest day."""
        if self._as_of is None:
            tops = [self.tables[f"stg_{a}_events"] for a in APPS]
            tops = [self.spark.range(1).select(max_literal(t, "timestamp", DAY).cast("string").alias("t")).first()["t"] for t in tops]
            self._as_of = max((t for t in tops if t is not None), default=None)
        return F.lit(None if self._as_of is None else str(self._as_of)).cast("timestamp")

    def today(self) -> date | None:
        return self.spark.range(1).select(F.to_date(self.as_of()).alias("d")).first()["d"]

    def build(self) -> dict[str, DataFrame]:
        self.build_staging()
        self.build_dims()
        self.build_facts()
        self.build_aggregates()
        self.build_reports()
        return self.tables

    def build_staging(self) -> None:
        for app in APPS:
            self.view(f"stg_{app}_events", stage(read_processed(self.spark, self.processed, app), app))
        scopes = read_processed(self.spark, self.processed, "token", "event_scopes")
        self.view("stg_token_event_scopes", stage(scopes, "token_scopes"))

    def build_dims(self) -> None:
        stg = self._staged() | {"token_scopes": self.tables["stg_token_event_scopes"]}
        paths = self.processed_paths(*APPS)
        for name in DIMS:
            days, now = self._pending(name, [self.scopes_path()] if name == "dim_scope" else paths)
            dim = DIMENSIONS[name]
            if days is None or days:
                self.table(name, carry_dimension(self.spark, f"{self.root}/_state/{name}", dim, stg, days))
                self.log.record(name, now)
            else:
                self._keep(name, dim.build(stg).schema)
        days = [d for path in paths for d in stored_days(self.spark, path)]
        bounds = self.spark.range(1).select(*(F.lit(str(f(days)) if days else None).cast("date").alias(n) for f, n in ((min, "min_day"), (max, "max_day"))))
        self.table("dim_time", calendar(bounds))

    def _staged(self) -> dict[str, DataFrame]:
        return {a: self.tables[f"stg_{a}_events"] for a in APPS}

    def build_facts(self) -> None:
        stg = self._staged()
        names = {"user": "dim_user", "ip": "dim_ip_address", "application": "dim_application", "scope": "dim_scope"}
        dims = {k: self.tables[n] for k, n in names.items()}
        for app in FACT_ORDER:
            self.by_day(f"fact_{app}_event", self.processed_paths(app), lambda cut, app=app: fact(app, {app: cut(stg[app])}, dims))
        scopes = self.tables["stg_token_event_scopes"]
        # a scope row is never later than the row kept of its event
        self.by_day("fact_token_scope", [self.scopes_path(), *self.processed_paths("token")], lambda cut: fact_scope({"token": cut.onward(stg["token"])}, cut(scopes), dims))

    def build_aggregates(self) -> None:
        t = self.tables
        events = all_events({a: t[f"fact_{a}_event"] for a in FACT_ORDER})
        token, admin, scopes = t["fact_token_event"], t["fact_admin_event"], t["fact_token_scope"]
        today = F.to_date(self.as_of())
        sources = [f"fact_{a}_event" for a in FACT_ORDER]
        of_events: dict[str, Callable[[DataFrame], DataFrame]] = {
            "fact_user_activity_daily": A.user_activity_daily,
            "fact_app_activity_daily": A.app_activity_daily,
            "fact_ip_activity_daily": A.ip_activity_daily,
            "fact_geo_activity_daily": lambda df: A.geo_daily(df, t["dim_ip_address"]),
            "fact_event_volume_hourly": A.volume_hourly,
        }
        of_admin = {"fact_admin_actions_daily": A.admin_actions_daily, "fact_admin_action_breakdown_daily": A.admin_breakdown_daily}
        of_scopes = {"fact_scope_usage_daily": A.scope_usage_daily, "fact_scope_risk_daily": A.scope_risk_daily, "fact_scope_cooccurrence_daily": cooccurrence_daily}
        for models, source, inputs in ((of_events, events, sources), (of_admin, admin, ["fact_admin_event"]), (of_scopes, scopes, ["fact_token_scope"])):
            for name, aggregate in models.items():
                self.by_day(name, inputs, lambda cut, aggregate=aggregate, source=source: aggregate(cut(source)))
        self._app_baseline()
        self._user_baseline(events)
        for name, build in (("fact_app_scope_drift_daily", set_drift_daily), ("fact_app_scope_drift_scopes_daily", set_drift_items)):
            self.by_day(name, ["fact_token_scope", "fact_token_event"], lambda cut, build=build: build(app_scopes(cut(scopes), cut(token))), ahead=1)
        self.view("fact_geo_new_regions", A.new_regions(events, today))
        days = t["dim_time"].agg(F.min("date_day").alias("min_day"), F.max("date_day").alias("max_day"))
        self.view("dq_app_event_gaps", event_gaps(t["fact_app_activity_daily"], days, today))
        self.view("dq_duplicate_events_daily", duplicates_daily(events))

    def _state(self, name: str) -> Snapshots:
        return Snapshots(self.spark, f"{self.root}/_state/{name}")

    def _app_baseline(self) -> None:
        name, t = "fact_app_activity_baseline", self.tables
        days, now = self._pending(name, ["fact_app_activity_daily", "fact_token_event"])
        if days is None or days:
            since = min(days) if days else None
            carry_app_baseline(self.spark, self.path(name), self._state(name), t["fact_app_activity_daily"], t["fact_token_event"], since)
            self.log.record(name, now)
        self._keep(name, B.app_baseline(t["fact_app_activity_daily"], t["fact_token_event"]).schema)

    def _user_baseline(self, events: DataFrame) -> None:
        name, t, today = "fact_user_activity_baseline", self.tables, self.today()
        days, now = self._pending(name, ["fact_user_activity_daily", *(f"fact_{a}_event" for a in FACT_ORDER), "fact_token_scope"])
        items = self._state("user_items")
        parts = (t["fact_user_activity_daily"], events, t["fact_token_scope"], t["dim_ip_address"])
        if today is not None and (days is None or days or items.days()[-1:] != [today]):
            # without changed days only the novelty window moved
            since = None if days is None else min(days, default=date.max)
            carry_user_baseline(self.spark, self.path(name), self._state(name), items, *parts, today, since)
            self.log.record(name, now)
        elif days is None:
            write_whole(B.user_baseline(*parts, F.lit(None).cast("date")), self.path(name))
        self._keep(name, B.user_baseline(*parts, F.to_date(self.as_of())).schema)

    def build_reports(self) -> None:
        t = self.tables
        as_of = self.as_of()
        today = F.to_date(as_of)
        token = t["fact_token_event"]
        self.view("agg_token_top_users_48h", R.top_users(token, day="event_date"))
        self.view("agg_token_top_methods_48h", R.top_methods(token, day="event_date"))
        self.view("agg_token_top_apps_48h", R.top_apps(token, day="event_date"))
        self.view("agg_token_intensity_outliers_48h", R.intensity_outliers(token, day="event_date"))
        self.view("agg_event_volume_spikes", R.volume_spikes(t["fact_event_volume_hourly"], as_of))
        self.view("agg_high_risk_scopes_7d", R.high_risk_summary(t["fact_scope_risk_daily"], today))
        self.view("agg_high_risk_scope_names_7d", R.high_risk_scopes(t["fact_token_scope"], t["dim_scope"], today))
        self.view("agg_scope_pairs_high_risk_7d", R.high_risk_pairs(t["fact_scope_cooccurrence_daily"], t["dim_scope"], today))
        self.view("agg_admin_action_alerts_48h", R.admin_alerts(t["fact_admin_action_breakdown_daily"], today))
        self.view("agg_geo_recent_48h", R.geo_recent(t["fact_geo_activity_daily"], today))
        self.view("agg_dq_dupes_30d", R.dq_dupes(t["dq_duplicate_events_daily"], today))
        self.view("agg_dq_gaps_30d", R.dq_gaps(t["dq_app_event_gaps"], today))

    @staticmethod
    def checks_of(tables: dict[str, DataFrame]) -> DataFrame:
        """Every data-quality check over built models."""
        return dq_report({n: df for n, df in tables.items() if n in CHECKS})
