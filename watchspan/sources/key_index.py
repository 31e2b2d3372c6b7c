"""Which days of a stored table may hold a key, so that a merge need not look through all of them.

Below `<table>/../_keys_<table>` every key has entries (hash, day), bucketed by the hash, and every bucket a bitmap of the hashes it
has seen. A merge tests its keys on the bitmaps of their buckets and reads the entries of those buckets only in which one may
be known. Entries are only ever added, before the rows are written: an entry that is too many makes a day be looked
at in vain, one too few cannot be.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from watchspan.sources.warehouse import DAY, load, staged, stored_days, unstage

BUCKETS, SEGMENTS = 64, 256  # hash buckets, and pieces of 32,768 bits of a bucket's bitmap
_SEGMENT_BITS = 1 << 15
_ENTRY = "hash bigint, event_date date, bucket int"
_BITMAP = "segment bigint, bitmap binary, bucket int"


class KeyIndex:
    def __init__(self, spark: SparkSession, table: str, keys: list[str], buckets: int = BUCKETS, segments: int = SEGMENTS):
        """`buckets` and `segments` belong to the stored index; beyond some 10^8 keys more segments keep the bitmaps telling."""
        self.spark, self.table, self.keys, self.buckets, self.segments = spark, table, keys, buckets, segments
        folder, _, name = table.rstrip("/").rpartition("/")
        self.path = f"{folder}/_keys_{name}"

    def _load(self, kind: str, schema: str) -> DataFrame | None:
        return load(self.spark, f"{self.path}/{kind}", self.spark.createDataFrame([], schema).schema)

    def _hashed(self, rows: DataFrame, *more: str) -> DataFrame:
        """Distinct hashes with their bucket and bit; a null key is a key like any other."""
        known = [F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in self.keys]
        rows = rows.select(F.xxhash64(*known).alias("hash"), *more).distinct()
        bit = F.pmod(F.shiftrightunsigned("hash", 16), F.lit(self.segments * _SEGMENT_BITS)) + 1
        return rows.withColumn("bucket", F.pmod("hash", F.lit(self.buckets)).cast("int")).withColumn("bit", bit)

    def exists(self) -> bool:
        return self._load("entries", _ENTRY) is not None

    def add(self, rows: DataFrame, day: str = DAY) -> None:
        """Entries of the rows' keys and days."""
        hashed = self._hashed(rows.withColumnRenamed(day, DAY), DAY)
        bits = hashed.groupBy("bucket", F.bitmap_bucket_number("bit").alias("segment")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap"))
        self._append(bits, "bitmaps")
        self._append(hashed.drop("bit"), "entries")

    def _append(self, df: DataFrame, kind: str) -> None:
        df.hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(f"{self.path}/{kind}")

    def candidates(self, rows: DataFrame) -> DataFrame:
        """Hashes of the rows' keys that the bitmaps of their buckets know."""
        hashed = self._hashed(rows)
        touched = _numbers(hashed, "bucket")
        bitmaps = self._load("bitmaps", _BITMAP).filter(F.col("bucket").isin(touched)).groupBy("bucket", "segment").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        hashed = hashed.withColumn("segment", F.bitmap_bucket_number("bit")).withColumn("at", F.bitmap_bit_position("bit"))
        found = hashed.join(bitmaps, ["bucket", "segment"])
        return found.filter(_bit(F.col("bitmap"), F.col("at"))).select("hash", "bucket")

    def days_of(self, rows: DataFrame) -> set[date]:
        """Days that may hold one of the rows' keys; entries are read in buckets with a candidate only."""
        found = self.candidates(rows)
        touched = _numbers(found, "bucket")  # at most one number per bucket
        if not touched:
            return set()
        entries = self.entries(touched).join(found.select("hash"), "hash", "left_semi")
        return {r[0] for r in entries.select(DAY).distinct().collect()}

    def entries(self, touched: list[int]) -> DataFrame:
        return self._load("entries", _ENTRY).filter(F.col("bucket").isin(touched))

    def compact(self) -> None:
        """Rewrite entries without repeats, and one bitmap row per segment; entries of days that are gone go too."""
        there = stored_days(self.spark, self.table)
        entries = staged(self._load("entries", _ENTRY).filter(F.col(DAY).isin(there)).distinct())
        bitmaps = staged(self._load("bitmaps", _BITMAP).groupBy("bucket", "segment").agg(F.bitmap_or_agg("bitmap").alias("bitmap")))
        for df, kind in ((bitmaps, "bitmaps"), (entries, "entries")):
            df.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(f"{self.path}/{kind}")
            unstage(df)


def _bit(bitmap: Column, at: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), at.bitwiseAND(F.lit(7)))) % 2 == 1


def _numbers(df: DataFrame, col: str) -> list[int]:
    return sorted(r[0] for r in df.select(col).distinct().collect())
