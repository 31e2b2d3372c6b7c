"""Raw activity logs: scan, parse with dead letters, landing sink."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from watchspan.functions.times import parse_ts
from watchspan.schemas import CORRUPT, RAW_ACTIVITY, RAW_ACTIVITY_CHECKED


def app_path(path: str, app: str | None) -> str:
    return f"{path}/app={app}" if app else path


def between_days(df: DataFrame, start: date | str | None, end: date | str | None) -> DataFrame:
    """Closed day range on the partition column; prunes directories before any file is opened."""
    if start is not None:
        df = df.filter(F.col("event_date") >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.filter(F.col("event_date") <= F.lit(str(end)).cast("date"))
    return df


def read_raw(
    spark: SparkSession,
    path: str,
    app: str | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """Scan JSON lines (plain or gzip). Unparsable lines come as null rows; use read_lines to keep them."""
    partitions = [T.StructField("event_date", T.DateType())]
    schema = T.StructType(RAW_ACTIVITY.fields + partitions) if (start or end) else RAW_ACTIVITY
    df = spark.read.schema(schema).json(app_path(path, app))
    return between_days(df, start, end)


def read_lines(
    spark: SparkSession,
    path: str,
    app: str | None = None,
    start: date | str | None = None,
    end: date | str | None = None,
) -> DataFrame:
    """The same files as text, one `value` per activity, for parsing that keeps bad lines."""
    return between_days(spark.read.text(app_path(path, app)), start, end)


# Rules in order; the first that holds names the error. A missing array fulfils its rules.
_RULES = [
    ("activity is null or activity._corrupt_record is not null", "not an activity: malformed JSON or a field of the wrong type"),
    ("coalesce(activity.id.time, '') = ''", "missing activity timestamp"),
    ("try_to_timestamp(activity.id.time) is null", "invalid activity timestamp"),
    ("activity.actor is null", "missing actor"),
    ("exists(activity.events, e -> e.name is null or e.type is null)", "event without name or type"),
    ("exists(activity.events, e -> coalesce(exists(e.parameters, p -> p.name is null), false))", "parameter without name"),
    ("exists(activity.resourceDetails, d -> d.id is null)", "resource without id"),
    ("exists(activity.resourceDetails, d -> coalesce(exists(d.appliedLabels, l -> l.id is null), false))", "label without id"),
]


def activity_error() -> Column:
    """Why the parsed `activity` is unusable; null when it is fine."""
    cases = " ".join(f"when {rule} then '{text}'" for rule, text in _RULES)
    return F.expr(f"case {cases} end")


def parse_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Columns raw, activity, error. Blank lines are skipped."""
    parsed = F.from_json(
        F.col(col), RAW_ACTIVITY_CHECKED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    # The generator keeps later filters from being pushed below the parse, which would parse every line twice.
    once = lines.filter(F.trim(F.col(col)) != "").select(
        F.col(col).alias("raw"), F.explode(F.array(parsed)).alias("activity")
    )
    return once.withColumn("error", activity_error())


def misplaced_errors(parsed: DataFrame, start: date | str | None, end: date | str | None) -> DataFrame:
    """Parsed rows with an error also where the activity's own day is outside the days [start, end] that were read."""
    day = F.to_date(parse_ts(F.col("activity.id.time")))
    outside = F.lit(False)
    if start is not None:
        outside |= day < F.lit(str(start)).cast("date")
    if end is not None:
        outside |= day > F.lit(str(end)).cast("date")
    wrong = F.when(outside, F.lit("activity of a day outside the days read"))
    return parsed.withColumn("error", F.coalesce("error", wrong))


def split_errors(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable activities, dead letters as error and raw). No bad line stops the job."""
    good = parsed.filter(F.col("error").isNull()).select("activity.*").drop(CORRUPT)
    bad = parsed.filter(F.col("error").isNotNull()).select("error", "raw")
    return good, bad


def is_valid(parsed: DataFrame) -> DataFrame:
    """Only the parsed rows that fulfil every rule."""
    return parsed.filter(F.col("error").isNull())


def land_raw(df: DataFrame, path: str, app: str, compress: bool = False, level: int = 5) -> None:
    """Append activities as JSON lines, by day, and by day and hour for the busiest application."""
    ts = parse_ts(F.col("id.time"))
    out = df.withColumns({"event_date": F.to_date(ts)})
    parts = ["event_date"]
    if app == "token":
        out = out.withColumn("event_hour", F.date_format(ts, "HH"))
        parts.append("event_hour")
    # few large files per partition: AQE splits a busy one and joins small ones
    writer = out.hint("rebalance", *parts).write.mode("append").partitionBy(*parts)
    if compress:
        writer = writer.option("compression", "gzip").option("zlib.compress.level", _ZLIB_LEVELS[level])
    writer.json(app_path(path, app))


# Hadoop's names of the gzip levels.
_ZLIB_LEVELS = {
    1: "BEST_SPEED", 2: "TWO", 3: "THREE", 4: "FOUR", 5: "FIVE", 6: "SIX", 7: "SEVEN", 8: "EIGHT", 9: "BEST_COMPRESSION",
}


def read_raw_any(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """Activities from mixed JSON shapes: a batch `{"items": [...]}`, an array, or one object.

    `lines` parses every line on its own. `document` reads each file as one JSON text, for
    pretty-printed files. `auto` first looks which files have an unreadable line; those are read whole, the others
    by line. The driver gets names of files only, which it lists anyway, and each scan opens its own files.
    """
    if layout == "auto":
        name = F.col("_metadata.file_path")
        unreadable = (F.trim("value") != "") & F.try_parse_json("value").isNull()
        lines = spark.read.text(path)
        by_file = lines.select(name.alias("file"), unreadable.alias("bad")).groupBy("file").agg(F.bool_or("bad").alias("whole"))
        files = {True: [], False: []}
        for r in by_file.collect():
            files[r["whole"]].append(r["file"])
        texts = [spark.read.text(paths, wholetext=whole) for whole, paths in files.items() if paths]
        text = reduce(DataFrame.unionByName, [t.select("value") for t in texts]) if texts else lines.select("value").limit(0)
    else:
        text = spark.read.text(path, wholetext=layout == "document")
    return activities_of(text)


def activities_of(text: DataFrame, col: str = "value") -> DataFrame:
    """Unpack JSON texts of any of the three shapes into activities; unusable ones are skipped."""
    batch = F.from_json(F.col(col), T.StructType([T.StructField("items", T.ArrayType(RAW_ACTIVITY))]))["items"]
    plain = F.from_json(F.col(col), T.ArrayType(RAW_ACTIVITY))
    is_array = F.startswith(F.ltrim(F.col(col)), F.lit("["))
    listed = text.select(F.explode(F.when(is_array, plain).otherwise(F.coalesce(batch, plain))).alias("activity"))
    ok = F.col("activity.id.time").isNotNull() & F.col("activity.events").isNotNull()
    return listed.filter(ok).select("activity.*")
