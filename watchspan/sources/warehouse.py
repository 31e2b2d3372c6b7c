"""Day-partitioned Parquet tables: create, merge, replace, materialise.

Plain Parquet has no row-level merge, so a change rewrites the day partitions it touches, through
Spark's dynamic partition overwrite: new files are staged and moved in only after the job succeeded.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from watchspan.operators.dedup import dedup_latest
from watchspan.operators.joins import with_keys, without_keys
from watchspan.session import ensure_checkpoint_dir

DAY = "event_date"


def load(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at a path, or None when there is none yet."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, partition_by: list[str] | None = None) -> None:
    """Create an empty catalog table with the schema unless it exists."""
    if spark.catalog.tableExists(name):
        return
    writer = spark.createDataFrame([], schema).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def write_days(df: DataFrame, path: str, day: str = DAY) -> None:
    """Replace the days that occur in `df`; a table without days is replaced as a whole."""
    writer = df.write.mode("overwrite").option("compression", "snappy")
    if day in df.columns:
        df = df.hint("rebalance", day)
        writer = df.write.mode("overwrite").option("compression", "snappy")
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(day)
    writer.parquet(path)


def stored_days(spark: SparkSession, path: str, day: str = DAY) -> list[date]:
    """The days a partitioned table holds, from its file listing; no file is opened."""
    try:
        files = spark.read.format("binaryFile").load(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    # a table that was written without rows has no day folder
    return sorted(_days(files.select("path", day), day)) if day in files.columns else []


def _days(df: DataFrame, day: str) -> set[date]:
    # one value per calendar day
    return {r[0] for r in df.select(day).distinct().collect()}


def _drop_days(spark: SparkSession, path: str, days: set[date], day: str) -> None:
    """Remove the directories of days that no longer have rows."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for d in sorted(days, key=str):
        folder = hadoop(f"{path}/{day}={d}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def merge_days(
    spark: SparkSession, path: str, updates: DataFrame, keys: list[str], newest: str | None = None,
    keep_newest: bool = False, day: str = DAY, indexed: bool = False, moves: bool = True,
) -> None:
    """Merge on unique keys: update every column of matching rows, insert the rest. Null keys match null keys.

    Of updates with the same key the one latest in `newest` counts. With `keep_newest` a stored row
    that is later than its update stays, so the order of arrival does not matter.

    A key may move to another day, so the days that hold a matching key are looked up first; these and the days of the
    updates are rewritten, all others stay as they are. The lookup reads the key columns of all stored days, or, with
    `indexed`, the touched buckets of an index of keys that is kept beside the table (`key_index.KeyIndex`).

    `moves=False` says that a key never leaves its day, so that only the days of the updates are looked at.

    Days are replaced by one job and emptied days removed after it. If that is cut short, a key that moved may be in its new
    and in its old day; the same merge, run again, finds both days and repairs it.
    """
    if keep_newest and newest is None:
        raise ValueError("keep_newest needs the column to compare")
    from watchspan.sources.key_index import KeyIndex

    old = load(spark, path, updates.schema)
    fresh = staged(dedup_latest(updates, keys, newest))
    index = KeyIndex(spark, path, keys) if indexed else None
    if index is not None and old is not None and not index.exists():
        index.add(old, day)
    if old is None:
        if index is not None:
            index.add(fresh, day)
        write_days(fresh, path, day)
        unstage(fresh)
        return
    if index is not None:
        touched = _days(fresh, day) | index.days_of(fresh)
        index.add(fresh, day)
    elif not moves:
        touched = _days(fresh, day)
    else:
        touched = _days(fresh.select(day).union(with_keys(old.select(*keys, day), fresh, keys).select(day)), day)
    there = old.filter(F.col(day).isin(sorted(touched)))
    if keep_newest:
        merged = dedup_latest(there.unionByName(fresh), keys, newest)
    else:
        merged = without_keys(there, fresh, keys).unionByName(fresh)
    replace_listed_days(spark, path, merged, touched, day)
    unstage(fresh)


def write_whole(df: DataFrame, path: str, day: str = DAY) -> None:
    """Replace a whole table, stored by day."""
    df.hint("rebalance", day).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(day).parquet(path)


def staged(df: DataFrame) -> DataFrame:
    """A copy of the rows in the shared checkpoint folder, read back: it does not change while the tables it was made from do.

    Cached blocks would not do: those of a lost executor are computed again, from files that may be replaced by then.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Remove a staged copy that nothing reads any more."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def replace_listed_days(spark: SparkSession, path: str, df: DataFrame, days: set[date], day: str = DAY) -> None:
    """Replace exactly the given days with the rows of `df` of these days; a day without rows disappears."""
    if not days:
        return
    fresh = staged(df.filter(F.col(day).isin(sorted(days))))
    filled = _days(fresh, day)
    if filled or load(spark, path) is None:
        write_days(fresh, path, day)
    _drop_days(spark, path, days - filled, day)
    unstage(fresh)


def replace_days(spark: SparkSession, path: str, df: DataFrame, since: date | None, day: str = DAY) -> None:
    """Replace all days from `since` on with the rows of `df`.

    For aggregates whose key contains the day: every day in range is computed anew, so this equals a
    merge on the key, needs no read of the old rows, and leaves no outdated group behind.
    """
    if since is None or load(spark, path) is None:
        write_days(df, path, day)
        return
    fresh = staged(df)
    stale = {d for d in stored_days(spark, path, day) if d >= since} - _days(fresh, day)
    write_days(fresh, path, day)
    _drop_days(spark, path, stale, day)
    unstage(fresh)


def materialize(df: DataFrame, name: str, kind: str, path: str | None = None, key: list[str] | None = None) -> DataFrame:
    """Keep a model as a view, a table, or a table merged on a key."""
    spark = df.sparkSession
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if path is None:
        raise ValueError("a stored model needs a path")
    if kind == "table":
        df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    elif kind == "incremental":
        merge_days(spark, path, df, key)
    else:
        raise ValueError(f"unknown kind {kind!r}")
    # the model's own schema: an empty table has no footer to read it from, and an old footer lacks new columns
    stored = spark.read.schema(df.schema).parquet(path)
    stored.createOrReplaceTempView(name)
    return stored
