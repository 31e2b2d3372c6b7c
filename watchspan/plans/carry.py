"""Models carried on from one build to the next from small states, without reading their history again.

- A baseline looks back over an entity's last rows, however long ago they were. Its state is those rows as of a day.
- Novelty slides: as the window moves, an item's first day in it leaves and a later day takes its place. Its state is the
  days of the window on which each user used each item.
- A dimension is folded from parts: per day, per month, and over all months.

All take changed days of any age, and equal a full build on the same data.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from watchspan.functions.keys import surrogate_key
from watchspan.operators import baseline as B
from watchspan.plans.dims import Dimension
from watchspan.sources.changes import Snapshots
from watchspan.sources.warehouse import DAY, load, replace_listed_days, staged, stored_days, unstage, write_whole

MEASURES = list(B.MEASURES)


def _day(value: date):
    return F.lit(str(value)).cast("date")


def carry_baseline(
    spark: SparkSession, path: str, states: Snapshots, key: str, day_key: str, fresh: DataFrame, since: date | None,
    patch: DataFrame | None = None, patched: set[date] | None = None,
) -> None:
    """Write the days from `since` on of a stored baseline; all days for None, or where nothing is stored.

    `fresh` holds the entities' daily rows from `since` on. What their frames reach further back comes from the newest state as
    of `since` or earlier and the stored rows between the two, so each entity has its last rows at hand, whatever their
    age. `patch` has rows of earlier days, `patched`, to be replaced along with them.
    """
    stored = None if since is None else load(spark, path)
    fresh = staged(fresh)
    only = [key, DAY, *MEASURES]
    if stored is None:
        states.drop_after(None)
        past = None
        rows = fresh
    else:
        states.drop_after(since)
        found = states.at_most(since)
        past = stored.filter(F.col(DAY) < _day(since)).select(*only)
        if found is not None:
            past = past.filter(F.col(DAY) >= _day(found[0])).unionByName(B.recent_rows(found[1], key, DAY).select(*only))
        rows = past.unionByName(fresh, allowMissingColumns=True).select(*fresh.columns)
    out = B.baseline(rows, key, DAY, B.MEASURES)
    out = out.select(surrogate_key(key, DAY).alias(day_key), "*")
    days = {r[0] for r in fresh.select(DAY).distinct().collect()}  # one value per calendar day
    if stored is None:
        write_whole(out, path)
    else:
        out = out.filter(F.col(DAY) >= _day(since))
        if patch is not None:
            out = out.unionByName(patch)
        replace_listed_days(spark, path, out, days | {d for d in stored_days(spark, path) if d >= since} | (patched or set()))
    newest = max(days, default=None)
    if newest is not None:
        seen = fresh.select(*only) if past is None else past.unionByName(fresh.select(*only))
        states.save(B.recent_state(seen, key, DAY, MEASURES, _day(newest)), newest)
    unstage(fresh)


def app_daily_rows(app_daily: DataFrame, token_events: DataFrame) -> DataFrame:
    """Daily rows of the application baseline."""
    volume = token_events.filter(F.col("app_id").isNotNull()).withColumn("source", F.lit("token"))
    daily = app_daily.select("app_id", DAY, "total_events", "distinct_users").join(B.token_volume(volume, ["app_id", DAY]), ["app_id", DAY], "left")
    return daily.withColumn("token_total_bytes", F.coalesce("token_total_bytes", F.lit(0)))


def carry_app_baseline(
    spark: SparkSession, path: str, states: Snapshots, app_daily: DataFrame, token_events: DataFrame, since: date | None
) -> None:
    """The application baseline from `since` on; earlier days of the inputs are not read."""
    if since is not None and load(spark, path) is not None:
        app_daily, token_events = (f.filter(F.col(DAY) >= _day(since)) for f in (app_daily, token_events))
    else:
        since = None
    carry_baseline(spark, path, states, "app_id", "app_baseline_day_key", app_daily_rows(app_daily, token_events), since)


def carry_user_baseline(
    spark: SparkSession, path: str, states: Snapshots, items: Snapshots, user_daily: DataFrame, events: DataFrame, scopes: DataFrame,
    dim_ip: DataFrame, as_of: date, since: date | None, novelty_days: int = B.NOVELTY_DAYS,
) -> None:
    """The user baseline as of a day: days from `since` on are made anew, earlier ones only where a count of new items moved.

    The inputs are read from `since` on. An `as_of` before that of the stored items makes the whole model anew.
    """
    days = ["user_key", DAY]
    known = F.col("user_key").isNotNull()
    user_daily, events, scopes = (f.filter(known) for f in (user_daily, events, scopes))
    first = as_of - timedelta(days=novelty_days)
    held = items.at_most(as_of)
    if since is None or held is None or items.days()[-1] > as_of or load(spark, path) is None:
        since, held = None, None
        items.drop_after(None)
    if since is not None:
        user_daily, events, scopes = (f.filter(F.col(DAY) >= _day(since)) for f in (user_daily, events, scopes))

    used = staged(B.item_days(events, scopes, dim_ip))
    old = None if held is None else held[1]
    state = staged(B.advance_items(old, used, _day(first), _day(since or date.min)))
    counts = B.debut_counts(state, novelty_days)
    new = [c for c in counts.columns if c not in days]
    daily = user_daily.select(*days, "total_events").join(B.token_volume(events, days), days, "left")
    daily = daily.join(used.groupBy(*days).agg(*B.breadth_counts()), days, "left").join(counts, days, "left")
    fresh = daily.withColumns({c: F.coalesce(c, F.lit(0)) for c in daily.columns if c not in (*days, "total_events")})

    patch, touched = None, set()
    if since is not None:
        moved = B.moved_debuts(B.debut_counts(old, novelty_days), counts).filter(F.col(DAY) < _day(since))
        touched = {r[0] for r in moved.select(DAY).distinct().collect()}
        kept = load(spark, path).filter(F.col(DAY).isin(sorted(touched))).drop(*new)
        patch = kept.join(counts, days, "left").withColumns({c: F.coalesce(c, F.lit(0)) for c in new}) if touched else None
    carry_baseline(spark, path, states, "user_key", "user_baseline_day_key", fresh, since, patch, touched)
    items.save(state, as_of)
    unstage(used)
    unstage(state)


def carry_dimension(spark: SparkSession, root: str, dim: Dimension, stg: dict[str, DataFrame], days: set[date] | None) -> DataFrame:
    """A dimension after the given days changed (None: all). Only these days of the sources and their months' parts are read.

    Below `root`, `days` holds the folded measures of each day and `months` those of each month; the dimension is the fold of
    all months. A day's parts are replaced as a whole, so rows that disappeared from it no longer count.
    """
    daily, monthly = f"{root}/days", f"{root}/months"
    schema = dim.parts(stg, (DAY,)).schema
    rest = [c for c in schema.names if c != DAY]
    month = F.to_date(F.trunc(DAY, "month")).alias(DAY)
    if days is None:
        write_whole(dim.parts(stg, (DAY,)), daily)
        write_whole(dim.fold(load(spark, daily, schema).select(month, *rest), (DAY,)), monthly)
    elif days:
        of_days = {a: f.filter(F.col(DAY).isin(sorted(days))) for a, f in stg.items()}
        replace_listed_days(spark, daily, dim.parts(of_days, (DAY,)), days)
        firsts = {d.replace(day=1) for d in days}
        within = reduce(Column.__or__, (F.col(DAY).between(_day(d), F.last_day(_day(d))) for d in sorted(firsts)))
        parts = load(spark, daily, schema).filter(within).select(month, *rest)
        replace_listed_days(spark, monthly, dim.fold(parts, (DAY,)), firsts)
    return dim.finish(dim.fold(load(spark, monthly, schema).drop(DAY)))
