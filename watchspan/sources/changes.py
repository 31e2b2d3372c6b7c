"""What a model was built from: versions of day partitions, so that a build does the changed days and no others.

The version of a day is a hash of its files' names, sizes and times, taken from the file listing; no file is opened. Whoever
replaces a day writes new files, so late rows, reprocessed days and dropped days all show, however old they are.
A model's record is written after its rows. A build that stops in between is done again, with the same result.
"""

from __future__ import annotations

from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from watchspan.sources.warehouse import DAY, load

BUILT = "input string, event_date date, version bigint, model string"
Versions = dict[tuple[str, date], int]


def day_versions(spark: SparkSession, path: str, day: str = DAY) -> dict[date, int]:
    """Version of each day of a partitioned table; one entry per calendar day reaches the driver."""
    try:
        files = spark.read.format("binaryFile").load(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    if day not in files.columns:  # a table that was written without rows has no day folder
        return {}
    name = F.element_at(F.split("path", "/"), -1)
    rows = files.groupBy(day).agg(F.bit_xor(F.xxhash64(name, "length", "modificationTime")).alias("version"))
    return {r[day]: r["version"] for r in rows.collect() if r[day] is not None}


class BuildLog:
    """For each model, the versions of its inputs' days that it was last built from."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _built(self, model: str) -> Versions | None:
        log = load(self.spark, self.path, self.spark.createDataFrame([], BUILT).schema)
        rows = [] if log is None else log.filter(F.col("model") == model).select("input", "event_date", "version").collect()
        return {(r["input"], r["event_date"]): r["version"] for r in rows if r["event_date"]} if rows else None

    def pending(self, model: str, inputs: dict[str, str]) -> tuple[set[date] | None, Versions]:
        """The days on which an input differs from what the model was built from, None if it never was; and the inputs' versions now.

        Take it before the inputs are read: what changes afterwards is then pending again.
        """
        now = {(name, day): v for name, path in inputs.items() for day, v in day_versions(self.spark, path).items()}
        before = self._built(model)
        if before is None:
            return None, now
        return {day for name, day in before.keys() | now.keys() if before.get((name, day)) != now.get((name, day))}, now

    def record(self, model: str, versions: Versions) -> None:
        """Replace the model's record. One row without a day says that it was built at all."""
        rows: list[tuple] = [("", None, None, model)]
        rows += [(name, day, v, model) for (name, day), v in sorted(versions.items())]
        df: DataFrame = self.spark.createDataFrame([(a, None if b is None else str(b), c, d) for a, b, c, d in rows], "input string, event_date string, version bigint, model string")
        df = df.withColumn("event_date", F.col("event_date").cast("date"))
        df.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model").parquet(self.path)


class Snapshots:
    """Copies of a state as of certain days. A copy counts once its write has ended; a newer copy of a day replaces the older."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 8):
        self.spark, self.path, self.keep = spark, path, keep
        self._root = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _folders(self) -> list[tuple[date, int, str]]:
        if not self._files.exists(self._root):
            return []
        found = []
        for status in self._files.listStatus(self._root):
            name = status.getPath().getName()
            day, _, turn = name.removeprefix("as_of=").partition(".")
            if self._files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                found.append((date.fromisoformat(day), int(turn), f"{self.path}/{name}"))
        return sorted(found)

    def days(self) -> list[date]:
        return sorted({day for day, _, _ in self._folders()})

    def at_most(self, day: date) -> tuple[date, DataFrame] | None:
        """The newest copy as of `day` or earlier."""
        found = [x for x in self._folders() if x[0] <= day]
        return (found[-1][0], self.spark.read.parquet(found[-1][2])) if found else None

    def save(self, df: DataFrame, day: date) -> None:
        folders = self._folders()
        turn = 1 + max((t for _, t, _ in folders), default=0)
        df.write.parquet(f"{self.path}/as_of={day}.{turn}")
        self._delete([path for d, _, path in folders if d == day])
        newest = self.days()[-self.keep :]
        self._delete([path for d, _, path in self._folders() if d not in newest])

    def drop_after(self, day: date | None) -> None:
        """Remove copies that hold days from `day` on; all of them for None."""
        self._delete([path for d, _, path in self._folders() if day is None or d > day])

    def _delete(self, paths: list[str]) -> None:
        for path in paths:
            self._files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(path), True)
