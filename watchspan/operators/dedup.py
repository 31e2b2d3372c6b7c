"""Duplicate removal by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql import types as T


def _default_tie(df: DataFrame, used: list[str]) -> list[Column]:
    """A fixed order among rows that agree on keys and time: a hash of what else they hold."""
    rest = [f.name for f in df.schema.fields if f.name not in used and not _has_map(f.dataType)]
    return [F.xxhash64(*rest)] if rest else [F.lit(0)]


def _has_map(dtype: T.DataType) -> bool:
    return "map<" in dtype.simpleString() or "variant" in dtype.simpleString()


def dedup_latest(df: DataFrame, keys: list[str], ts: str | None = "timestamp", tie: list[Column | str] | None = None) -> DataFrame:
    """Keep the latest row of each key; null is a key value like any other.

    `row_number() = 1` lets Spark cut every key to one row per task before the shuffle
    (WindowGroupLimit), so a key with very many copies does not end up in one task.
    """
    newest = [F.col(ts).desc_nulls_last()] if ts else []
    order = newest + list(tie if tie is not None else _default_tie(df, [*keys, ts]))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def dedup_any(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep any one row of each key."""
    return df.dropDuplicates(keys)


def fold_rows(df: DataFrame) -> DataFrame:
    """Distinct rows that stay distinct in the plan.

    Below a maximum Catalyst drops a plain distinct as redundant. Of text a maximum is a sort aggregate,
    so it should see the few distinct rows a hash aggregate leaves of a task's input, not all of them.
    """
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 0).drop("_n")


def dedup_report(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows before and after removal, in one pass."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("rows_removed"),
    )
