"""Structured Streaming twins of the batch ingestion: source, late data, dedup, counts, merge sink."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from watchspan.operators.dedup import dedup_latest
from watchspan.operators.normalize import normalize
from watchspan.schemas import RAW_ACTIVITY
from watchspan.sources.raw import parse_lines, split_errors
from watchspan.sources.warehouse import load, merge_days, staged, unstage

LATENESS = "3 minutes"


def stream_raw(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Activities from newly landed JSON files; the checkpoint takes the place of a fetch cursor.

    For files without bad lines, which come as null rows; `stream_lines` with `letter_sink` keeps those as dead letters.
    """
    reader = spark.readStream.schema(RAW_ACTIVITY)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def stream_lines(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same files as text, for parsing that keeps bad lines (`letter_sink`)."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def with_lateness(df: DataFrame, ts: str = "timestamp", lateness: str = LATENESS) -> DataFrame:
    """Watermark in place of the batch overlap."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)


def dedup_stream(df: DataFrame, keys: list[str] = ["unique_id"]) -> DataFrame:
    """Keep the first row of a key within the watermark; state is dropped behind it."""
    return df.dropDuplicatesWithinWatermark(keys)


def stream_volume(df: DataFrame, source: str = "source", ts: str = "timestamp", window: str = "1 hour") -> DataFrame:
    """Events per source and hour."""
    return (
        df.groupBy(F.window(ts, window).alias("w"), F.col(source).alias("source"))
        .agg(F.count(F.lit(1)).alias("total_events"))
        .select("source", F.col("w.start").alias("event_hour"), "total_events")
    )


def run_available(df: DataFrame, checkpoint: str, mode: str, sink: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process what is there now and stop; a rerun on the same checkpoint continues after it."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    query = writer.foreachBatch(sink).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def merge_sink(path: str, keys: list[str], newest: str = "timestamp") -> Callable[[DataFrame, int], None]:
    """Merge each micro-batch into a day-partitioned table, keeping the latest row of a key.

    An index of keys tells the days that may hold them, so a batch reads its own days and those of earlier copies only.
    A late older copy does not replace a newer stored row, and running a batch twice leaves the same
    table, so a restart after a failure is safe.
    """

    def write(batch: DataFrame, _: int) -> None:
        rows = batch.withColumn("event_date", F.to_date(F.col(newest)))
        merge_days(batch.sparkSession, path, rows, keys, newest, keep_newest=True, indexed=True)

    return write


class BatchLedger:
    """Ids of the micro-batches whose sinks were all written; one file per batch, folded from time to time.

    Ids of a stream only grow, and all before the largest stored one are done, so folding keeps that one.
    """

    def __init__(self, spark: SparkSession, path: str, fold_at: int = 64):
        self.spark, self.path, self.fold_at = spark, path, fold_at

    def _rows(self) -> DataFrame | None:
        return load(self.spark, self.path, self.spark.createDataFrame([], "batch bigint").schema)

    def last(self) -> int:
        rows = self._rows()
        top = None if rows is None else rows.agg(F.max("batch").alias("b")).first()["b"]
        return -1 if top is None else top

    def add(self, batch: int) -> None:
        self.spark.createDataFrame([(batch,)], "batch bigint").coalesce(1).write.mode("append").parquet(self.path)
        files = self._rows().inputFiles()
        if len(files) >= self.fold_at:
            self.spark.createDataFrame([(self.last(),)], "batch bigint").coalesce(1).write.mode("append").parquet(self.path)
            for name in files:
                old = self.spark._jvm.org.apache.hadoop.fs.Path(name)
                old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, False)


def letter_sink(app: str, table: str, letters: str, ledger: str) -> Callable[[DataFrame, int], None]:
    """Parse each micro-batch of lines once: usable activities are merged into the table, dead letters kept with their error.

    A batch that comes again is skipped if the ledger has it. If it stopped halfway, the merge gives the same table again and its
    dead letters replace those it had written, in a folder of the batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        done = BatchLedger(batch.sparkSession, ledger)
        if batch_id <= done.last():
            return
        parsed = staged(parse_lines(batch))
        good, bad = split_errors(parsed)
        merge_sink(table, ["unique_id"])(normalize(good, app), batch_id)
        if not bad.isEmpty():
            bad.write.mode("overwrite").parquet(f"{letters}/batch={batch_id}")
        done.add(batch_id)
        unstage(parsed)

    return write


def hourly_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Store updated hourly counts by day: a batch rewrites the days whose hours it updates; days behind the watermark are closed.

    The number of files follows the days, not the batches. An update holds an hour's whole count, so a batch that comes again,
    or a count that was stored already, changes nothing.
    """

    def write(batch: DataFrame, _: int) -> None:
        rows = batch.withColumn("event_date", F.to_date("event_hour"))
        merge_days(batch.sparkSession, path, rows, ["source", "event_hour"], "total_events", keep_newest=True, moves=False)

    return write


def latest_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Store the updated rows of each micro-batch in its own directory, so a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest stored row of each key."""
    return dedup_latest(spark.read.parquet(path), keys, "batch").drop("batch")
