"""Dimension tables over the staged sources.

Rows are folded to distinct ones before the maxima are taken, so that what is sorted and shuffled grows
with the dimension and not with the events.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from watchspan.functions.keys import surrogate_key
from watchspan.functions.times import day_of_week
from watchspan.operators.dedup import fold_rows
from watchspan.schemas import APPS


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


class Dimension(NamedTuple):
    """A dimension as measures that can be merged: folding parts of the rows and then the parts gives the same as folding all rows."""

    keys: list[str]
    rows: Callable[..., DataFrame]  # (stg, by): rows with `by`, keys and measures
    folds: dict[str, Callable[[str], Column]]
    finish: Callable[[DataFrame], DataFrame]

    def fold(self, rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
        return rows.groupBy(*by, *self.keys).agg(*(f(c).alias(c) for c, f in self.folds.items()))

    def parts(self, stg: dict[str, DataFrame], by: tuple[str, ...] = ()) -> DataFrame:
        """The folded measures of each key, apart for each value of `by`."""
        return self.fold(self.rows(stg, by), by)

    def build(self, stg: dict[str, DataFrame]) -> DataFrame:
        return self.finish(self.parts(stg))


def _user_rows(stg: dict[str, DataFrame], by: tuple[str, ...] = ()) -> DataFrame:
    extra = {"drive": ["actor_is_collaborator_account"], "saml": ["orgunit_path"]}
    rows = _stack([stg[a].select(*by, "actor_profile_id", "actor_email", *extra.get(a, [])) for a in ("drive", "token", "admin", "saml", "login")])
    flag = F.coalesce("actor_is_collaborator_account", F.lit(False))
    return fold_rows(rows).withColumn("is_collaborator", flag).drop("actor_is_collaborator_account")


def asn_candidates(asn_list: Column, asn: Column) -> Column:
    none = F.array().cast("array<bigint>")
    return F.when(asn_list.isNotNull(), asn_list).when(asn.isNotNull(), F.array(asn)).otherwise(none)


def _ip_rows(stg: dict[str, DataFrame], by: tuple[str, ...] = (), keep_unknown: bool = False) -> DataFrame:
    cols = ["ip_address", "asn", "asn_list", "region_code", "subdivision_code"]
    rows = fold_rows(_stack([stg[a].select(*by, *cols) for a in APPS]).filter(F.col("ip_address").isNotNull()))
    spread = F.explode_outer if keep_unknown else F.explode
    one = rows.select(
        *by, "ip_address", "region_code", "subdivision_code", F.col("asn").alias("primary_asn"),
        spread(asn_candidates(F.col("asn_list"), F.col("asn"))).alias("candidate"),
    )
    unknown = (F.col("candidate") == 0) | (F.col("primary_asn") == 0) | F.col("primary_asn").isNull()
    return one.withColumns({"known_asn": F.when(F.col("candidate") != 0, F.col("candidate")), "has_unknown_asn": unknown}).drop("candidate")


def _application_rows(stg: dict[str, DataFrame], by: tuple[str, ...] = ()) -> DataFrame:
    token = stg["token"].select(
        *by, F.col("client_id").alias("app_id"), F.col("accessing_app_name").alias("app_name"), "client_type", "api_name"
    )
    others = [stg[a].select(*by, F.col("oauth_client_id").alias("app_id"), F.col("oauth_app_name").alias("app_name")) for a in ("admin", "drive")]
    return fold_rows(_stack([token, *others]).filter(F.col("app_id").isNotNull()))


def _scope_rows(stg: dict[str, DataFrame], by: tuple[str, ...] = ()) -> DataFrame:
    return fold_rows(stg["token_scopes"].select(*by, "scope_name", "scope_family", "product_bucket", "service", "is_readonly"))


def _keyed_by(name: str, *cols: str) -> Callable[[DataFrame], DataFrame]:
    return lambda df: df.select(surrogate_key(*cols).alias(name), "*")


def _finish_ip(df: DataFrame) -> DataFrame:
    asn = F.coalesce("known_asn", F.nullif("primary_asn", F.lit(0))).alias("asn")
    return df.select(surrogate_key("ip_address").alias("ip_key"), "ip_address", asn, "region_code", "subdivision_code", "has_unknown_asn")


_IP_FOLDS = {c: F.max for c in ("known_asn", "primary_asn", "region_code", "subdivision_code")} | {"has_unknown_asn": F.bool_or}
DIMENSIONS = {
    "dim_user": Dimension(
        ["actor_profile_id", "actor_email"], _user_rows, {"orgunit_path": F.max, "is_collaborator": F.bool_or},
        _keyed_by("user_key", "actor_profile_id", "actor_email"),
    ),
    "dim_ip_address": Dimension(["ip_address"], _ip_rows, _IP_FOLDS, _finish_ip),
    "dim_application": Dimension(["app_id"], _application_rows, {c: F.max for c in ("app_name", "client_type", "api_name")}, _keyed_by("app_key", "app_id")),
    "dim_scope": Dimension(
        ["scope_name"], _scope_rows, {c: F.max for c in ("scope_family", "product_bucket", "service")} | {"is_readonly": F.bool_or},
        _keyed_by("scope_key", "scope_name"),
    ),
}


def dim_user(stg: dict[str, DataFrame]) -> DataFrame:
    """One row per (profile, email)."""
    return DIMENSIONS["dim_user"].build(stg)


def dim_ip(stg: dict[str, DataFrame], keep_unknown: bool = False) -> DataFrame:
    """One row per address with its canonical network number.

    Addresses that never came with network information are left out, as the facts then carry no
    address key; `keep_unknown` keeps them.
    """
    dim = DIMENSIONS["dim_ip_address"]
    return dim.finish(dim.fold(_ip_rows(stg, (), keep_unknown)))


def dim_application(stg: dict[str, DataFrame]) -> DataFrame:
    return DIMENSIONS["dim_application"].build(stg)


def dim_scope(scopes: DataFrame) -> DataFrame:
    return DIMENSIONS["dim_scope"].build({"token_scopes": scopes})


def day_bounds(frames: list[DataFrame], ts: str = "timestamp") -> DataFrame:
    """First and last day over all frames, one row."""
    return _stack([f.select(ts) for f in frames]).agg(
        F.to_date(F.min(ts)).alias("min_day"), F.to_date(F.max(ts)).alias("max_day")
    )


def dim_time(stg: dict[str, DataFrame], ts: str = "timestamp") -> DataFrame:
    """One row per calendar day between the first and the last event."""
    return calendar(day_bounds(list(stg.values()), ts))


def calendar(bounds: DataFrame) -> DataFrame:
    """The days from min_day to max_day of a one-row frame, with their parts."""
    d = F.col("date_day")
    days = bounds.select(F.explode(F.sequence("min_day", "max_day")).alias("date_day"))
    return days.select(
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        day_of_week(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        day_of_week(d).isin(0, 6).alias("is_weekend"),
        F.trunc(d, "week").alias("week_start"),
        F.trunc(d, "month").alias("month_start"),
        F.trunc(d, "quarter").alias("quarter_start"),
        (d == F.trunc(d, "month")).alias("is_month_start"),
        (d == F.last_day(d)).alias("is_month_end"),
    ).orderBy(d)
