"""Lookup of a table that is unique on its key, whatever its size and however uneven the keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def planned_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a frame; None where it cannot be asked."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def broadcast_limit(df: DataFrame) -> int:
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").lower()
    for unit, factor in (("gb", 1 << 30), ("mb", 1 << 20), ("kb", 1 << 10), ("g", 1 << 30), ("m", 1 << 20), ("k", 1 << 10), ("b", 1)):
        if text.endswith(unit):
            return int(float(text[: -len(unit)]) * factor)
    return int(text)


def fits_broadcast(df: DataFrame) -> bool:
    size = planned_bytes(df)
    return size is not None and size <= broadcast_limit(df)


HOT_SHARE = 0.001


def heavy_hashes(frames: list[tuple[DataFrame, dict[str, list[str]]]], share: float = HOT_SHARE) -> dict[str, list[int]]:
    """Hashes of the key values that hold at least `share` of the non-null rows, for many keys in one pass.

    Each frame comes with its keys by name, a key being a list of columns. A sketch of frequent hashes, at most 10 / share per
    key and merged over tasks, gives at most 1 / share candidates each; these few numbers reach the driver.
    """
    most = round(1 / share)
    hashes = []
    for df, keys in frames:
        whole = {name: reduce(Column.__and__, (F.col(c).isNotNull() for c in cols)) for name, cols in keys.items()}
        hashes.append(df.select(*(F.when(whole[name], F.xxhash64(*cols)).alias(name) for name, cols in keys.items())))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), hashes)
    found = rows.agg(*(f for n in rows.columns for f in (F.expr(f"approx_top_k({n}, {most}, {10 * most})").alias(n), F.count(n).alias(f"{n}_rows")))).first()
    listed = {n: [r for r in found[n] or [] if r["item"] is not None] for n in rows.columns}  # null counts as an item of the sketch
    return {n: [r["item"] for r in listed[n] if r["count"] >= share * found[f"{n}_rows"]] for n in rows.columns}


def lookup_join(
    facts: DataFrame, table: DataFrame, on: list[str], spread_by: str, count_on: DataFrame | None = None, hot: list[int] | None = None
) -> DataFrame:
    """Left join to a table unique on `on`; null keys never match.

    A table within the broadcast limit is joined as it is and Catalyst broadcasts it. A larger one goes
    through `salted_lookup`. `hot` are the hashes of its hot keys from `heavy_hashes`; without them hot keys are counted on
    `count_on`: of a chain of lookups, the frame before the chain, so that counting does not repeat the joins.
    """
    if fits_broadcast(table):
        return facts.join(table, on, "left")
    if hot is not None:
        return _spread_join(facts, table, on, spread_by, F.xxhash64(*on).isin(hot) if hot else F.lit(False))
    return salted_lookup(facts, table, on, spread_by, facts if count_on is None else count_on)


def salted_lookup(
    facts: DataFrame,
    table: DataFrame,
    on: list[str],
    spread_by: str,
    count_on: DataFrame,
    hot_share: float = 0.001,
    salts: int = 256,
    one_in: int = 64,
) -> DataFrame:
    """Shuffled left join in which no single key fills a task.

    Keys with at least `hot_share` of the rows, at most 1 / hot_share of them and so safe to broadcast,
    are spread over `salts` tasks by the hash of `spread_by`, a column that varies inside a key; their
    table rows are repeated once per salt. Rows with a null key are spread as well.

    Which keys count as hot changes the balance only, never the rows, so they are looked for in every
    `one_in`-th row. The choice is by hash of the row: both sides must see the same hot keys, also when
    a lost task is run again.
    """
    no_null = F.lit(True)
    for c in on:
        no_null = no_null & F.col(c).isNotNull()
    picked = F.pmod(F.xxhash64(*on, spread_by), F.lit(one_in)) == 0
    counts = count_on.filter(no_null & picked).groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg((F.sum("_n") * F.lit(hot_share)).alias("_least"))
    hot = counts.filter(F.col("_n") >= total.scalar()).select(*on, F.lit(True).alias("_hot"))
    hot = F.broadcast(hot)

    marked = facts.join(hot, on, "left"), table.join(hot, on, "left")
    return _spread_join(*marked, on, spread_by, F.coalesce(F.col("_hot"), F.lit(False)), salts)


def _spread_join(facts: DataFrame, table: DataFrame, on: list[str], spread_by: str, is_hot: Column, salts: int = 256) -> DataFrame:
    """Left join with hot keys dealt out by salts; `is_hot` tells the same of a key on both sides."""
    no_null = reduce(Column.__and__, (F.col(c).isNotNull() for c in on))
    spread = F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    left = facts.withColumn("_salt", F.when(is_hot | ~no_null, spread).otherwise(0))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = table.withColumn("_salt", F.explode(copies))
    if "_hot" in table.columns:
        left, right = left.drop("_hot"), right.drop("_hot")
    return left.join(right, [*on, "_salt"], "left").drop("_salt")


def with_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `df` whose keys occur in `other`; a null key equals a null key."""
    return _by_keys(df, other, keys, "left_semi")


def without_keys(df: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `df` whose keys do not occur in `other`; a null key equals a null key."""
    return _by_keys(df, other, keys, "left_anti")


def _by_keys(df: DataFrame, other: DataFrame, keys: list[str], how: str) -> DataFrame:
    named = other.select(*(F.col(k).alias(f"_other_{i}") for i, k in enumerate(keys)))
    same = [F.col(k).eqNullSafe(F.col(f"_other_{i}")) for i, k in enumerate(keys)]
    return df.join(named, same, how)
