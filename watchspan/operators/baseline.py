"""Trailing baselines with z-scores, and first-seen novelty."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from watchspan.functions.keys import surrogate_key
from watchspan.functions.ratios import pct_change, z_score
from watchspan.operators.joins import lookup_join

SPANS = (14, 30)
NOVELTY_DAYS = 60


def baseline(
    daily: DataFrame,
    key: str,
    day: str,
    measures: dict[str, tuple[str, str]],
    spans: tuple[int, ...] = SPANS,
    calendar: bool = False,
) -> DataFrame:
    """Mean and population deviation of the preceding rows, with z-score and relative change.

    `measures` maps a column to the (plural, singular) names used in the outputs. Frames count the
    entity's rows; `calendar=True` counts days instead. The current row is never part of its frame.
    """
    order = F.datediff(F.col(day), F.lit("1970-01-01").cast("date")) if calendar else F.col(day)
    ordered = Window.partitionBy(key).orderBy(order)
    stats, scores = {}, {}
    for span in spans:
        frame = ordered.rangeBetween(-span, -1) if calendar else ordered.rowsBetween(-span, -1)
        for col, (plural, singular) in measures.items():
            mean, std = f"mean_{plural}_{span}d", f"std_{plural}_{span}d"
            stats[mean] = F.avg(col).over(frame)
            stats[std] = F.stddev_pop(col).over(frame)
            scores[f"{singular}_z_score_{span}d"] = z_score(F.col(col), F.col(mean), F.col(std))
            scores[f"{singular}_pct_change_{span}d"] = pct_change(F.col(col), F.col(mean))
    return daily.withColumns(stats).withColumns(scores)


MEASURES = {"total_events": ("events", "event"), "token_total_bytes": ("token_bytes", "token_bytes")}


def app_baseline(app_daily: DataFrame, token_events: DataFrame, since: Column | None = None, emit_from: Column | None = None, **kw) -> DataFrame:
    """Per application and day: totals against the application's own recent days.

    `since` limits the days read and `emit_from` the days returned.
    """
    if since is not None:
        app_daily, token_events = (f.filter(F.col("event_date") >= since) for f in (app_daily, token_events))
    volume = (
        token_events.filter(F.col("app_id").isNotNull())
        .groupBy("app_id", "event_date")
        .agg(F.sum(F.coalesce("num_bytes", F.lit(0))).alias("token_total_bytes"))
    )
    daily = app_daily.select("app_id", "event_date", "total_events", "distinct_users").join(
        volume, ["app_id", "event_date"], "left"
    )
    daily = daily.withColumn("token_total_bytes", F.coalesce("token_total_bytes", F.lit(0)))
    rows = baseline(daily, "app_id", "event_date", MEASURES, **kw)
    rows = rows.select(surrogate_key("app_id", "event_date").alias("app_baseline_day_key"), "*")
    return rows if emit_from is None else rows.filter(F.col("event_date") >= emit_from)


def first_days(df: DataFrame, entity: list[str], item: str, day: str, since: Column) -> DataFrame:
    """First day of each (entity, item) among the days from `since` on."""
    known = df.filter(F.col(item).isNotNull() & (F.col(day) >= since))
    for e in entity:
        known = known.filter(F.col(e).isNotNull())
    return known.groupBy(*entity, item).agg(F.min(day).alias(day))


def novelty(df: DataFrame, entity: str, item: str, day: str, as_of: Column, days: int = NOVELTY_DAYS, name: str = "new_items") -> DataFrame:
    """Items an entity used for the first time within the last `days`, counted on their first day."""
    seen = first_days(df, [entity], item, day, F.date_sub(as_of, days))
    # one row per (entity, item) is left, so a plain count is the distinct count
    return seen.groupBy(entity, day).agg(F.count(F.lit(1)).alias(name))


_KINDS = {
    # kind: (daily distinct count, novelty count)
    "app": ("all_source_distinct_apps", "new_apps_count"),
    "scope": ("token_distinct_scopes", "new_scopes_count"),
    "asn": ("all_source_distinct_asns", "new_asns_count"),
}


def item_days(events: DataFrame, scopes: DataFrame, dim_ip: DataFrame) -> DataFrame:
    """(user_key, kind, item, event_date, by_token): the days on which a user used an application, a scope or a network, once each."""
    days = ["user_key", "event_date"]
    known = F.col("user_key").isNotNull()
    events, scopes = events.filter(known), scopes.filter(known)
    networks = dim_ip.filter(F.col("asn").isNotNull()).select("ip_key", "asn")
    with_asn = lookup_join(events.select(*days, "ip_key", "unique_id"), networks, ["ip_key"], "unique_id")
    used = reduce(
        DataFrame.unionByName,
        [
            events.filter(F.col("app_id").isNotNull()).select(
                *days, F.lit("app").alias("kind"), F.col("app_id").cast("string").alias("item"),
                (F.col("source") == "token").alias("by_token"),
            ),
            scopes.filter(F.col("scope_key").isNotNull()).select(
                *days, F.lit("scope").alias("kind"), F.col("scope_key").alias("item"), F.lit(True).alias("by_token")
            ),
            with_asn.filter(F.col("asn").isNotNull()).select(
                *days, F.lit("asn").alias("kind"), F.col("asn").cast("string").alias("item"), F.lit(False).alias("by_token")
            ),
        ],
    )
    return used.groupBy("user_key", "kind", "item", "event_date").agg(F.max("by_token").alias("by_token"))


def breadth_counts() -> list[Column]:
    """How many applications, scopes and networks a group of item days holds."""
    counts = [F.count_if(F.col("kind") == kind).alias(distinct) for kind, (distinct, _) in _KINDS.items()]
    return [*counts, F.count_if((F.col("kind") == "app") & F.col("by_token")).alias("token_distinct_apps")]


def token_volume(events: DataFrame, by: list[str]) -> DataFrame:
    return events.filter(F.col("source") == "token").groupBy(*by).agg(F.sum(F.coalesce("num_bytes", F.lit(0))).alias("token_total_bytes"))


# --- states that carry baselines and novelty from one build to the next ---


def recent_state(rows: DataFrame, key: str, day: str, measures: list[str], before: Column, most: int = max(SPANS)) -> DataFrame:
    """(key, recent): the last `most` rows of each entity before a day, the newest first. What a frame of `most` rows can reach."""
    entry = F.struct(F.col(day).alias("day"), *measures)
    kept = rows.filter((F.col(day) < before) & F.col(key).isNotNull()).groupBy(key).agg(F.collect_list(entry).alias("_all"))
    return kept.select(key, F.slice(F.sort_array("_all", asc=False), 1, most).alias("recent"))


def recent_rows(state: DataFrame, key: str, day: str) -> DataFrame:
    """The rows a state holds."""
    return state.select(key, F.inline("recent")).withColumnRenamed("day", day)


def advance_items(state: DataFrame | None, fresh: DataFrame, first: Column, since: Column) -> DataFrame:
    """(user_key, kind, item, days): the days of the novelty window on which a user used an item, in order.

    `state` is that of the last build, `fresh` holds the item days from `since` on, `first` is the window's first day. Days
    that left the window go, days from `since` on are taken from `fresh` only.
    """
    days = fresh.filter((F.col("event_date") >= since) & (F.col("event_date") >= first)).select("user_key", "kind", "item", "event_date")
    if state is not None:
        old = state.select("user_key", "kind", "item", F.explode("days").alias("event_date"))
        days = days.unionByName(old.filter((F.col("event_date") < since) & (F.col("event_date") >= first)))
    return days.groupBy("user_key", "kind", "item").agg(F.sort_array(F.collect_set("event_date")).alias("days"))


def debut_counts(state: DataFrame, novelty_days: int = NOVELTY_DAYS) -> DataFrame:
    """(user_key, event_date, new_..._count): items counted on the first day of the window on which their user used them."""
    counts = [F.count_if(F.col("kind") == kind).alias(f"{new}_{novelty_days}d") for kind, (_, new) in _KINDS.items()]
    return state.groupBy("user_key", F.get("days", F.lit(0)).alias("event_date")).agg(*counts)


def moved_debuts(old: DataFrame, new: DataFrame) -> DataFrame:
    """The (user_key, event_date) whose counts of new items differ between two states' counts."""
    keys, counts = ["user_key", "event_date"], [c for c in new.columns if c.startswith("new_")]
    left = old.select(*keys, F.struct(*counts).alias("_old"))
    right = new.select(*keys, F.struct(*counts).alias("_new"))
    return left.join(right, keys, "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new"))).select(*keys)


def user_baseline(
    user_daily: DataFrame,
    events: DataFrame,
    scopes: DataFrame,
    dim_ip: DataFrame,
    as_of: Column,
    novelty_days: int = NOVELTY_DAYS,
    since: Column | None = None,
    emit_from: Column | None = None,
    **kw,
) -> DataFrame:
    """Per user and day: totals, breadth of apps, scopes and networks, novelty, and baselines.

    `events` are the events of all sources (source, user_key, event_date, app_id, ip_key, num_bytes).
    Apps, scopes and networks are stacked as (user, day, kind, item) and folded once, so that breadth
    and novelty of all three come from one shuffle instead of a join per measure.
    """
    days = ["user_key", "event_date"]
    known = F.col("user_key").isNotNull()
    user_daily, events, scopes = (f.filter(known) for f in (user_daily, events, scopes))
    if since is not None:
        # novelty must see its whole window, whatever is read for the rest
        reach = F.least(since, F.date_sub(as_of, novelty_days))
        user_daily = user_daily.filter(F.col("event_date") >= since)
        events, scopes = (f.filter(F.col("event_date") >= reach) for f in (events, scopes))

    per_item = item_days(events, scopes, dim_ip)
    recent = F.col("event_date") >= F.date_sub(as_of, novelty_days)
    debut = F.min(F.when(recent, F.col("event_date"))).over(Window.partitionBy("user_key", "kind", "item"))
    per_item = per_item.withColumn("is_new", recent & (F.col("event_date") == debut))

    breadth = breadth_counts()
    for kind, (_, new) in _KINDS.items():
        breadth.append(F.count_if((F.col("kind") == kind) & F.col("is_new")).alias(f"{new}_{novelty_days}d"))
    breadth_daily = per_item.groupBy(*days).agg(*breadth)
    volume = token_volume(events, days)
    daily = user_daily.select(*days, "total_events").join(volume, days, "left").join(breadth_daily, days, "left")
    measures = [c for c in (*volume.columns, *breadth_daily.columns) if c not in days]
    daily = daily.withColumns({c: F.coalesce(c, F.lit(0)) for c in measures})
    rows = baseline(daily, "user_key", "event_date", MEASURES, **kw)
    rows = rows.select(surrogate_key(*days).alias("user_baseline_day_key"), "*")
    return rows if emit_from is None else rows.filter(F.col("event_date") >= emit_from)
