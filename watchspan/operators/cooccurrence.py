"""How often two items occur in the same event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from watchspan.functions.keys import surrogate_key

TASK_ROWS = 500_000


def tasks_for(spark: SparkSession, rows: int) -> int | None:
    """Tasks of at most about `TASK_ROWS` rows, for more rows than one for each core would hold; None for fewer, which AQE may join."""
    if rows <= TASK_ROWS * spark.sparkContext.defaultParallelism:
        return None
    # Spark raises smaller numbers to that of the session before a join
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


def _dealt(df: DataFrame, tasks: int | None, *by: str) -> DataFrame:
    return df.repartition(*by) if tasks is None else df.repartition(tasks, *by)


def cooccurrence_daily(
    df: DataFrame,
    id_col: str = "unique_id",
    item: str = "scope_name",
    day: str = "event_date",
    who: str = "user_key",
    tile: int = 256,
    since: Column | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Per day and item pair (a < b): joint rows, distinct events, distinct users.

    Day and user are those of the smaller item's row; `since` leaves out earlier days before anything is paired. The pair counts are the result itself, so the
    work is kept close to its size:
    - repeated rows of an event are first folded into one row with a multiplicity, so an event with
      very many rows shrinks to its distinct items;
    - an event with more than `tile` distinct items is cut into item tiles and each pair of tiles is
      joined in a task of its own, so no task pairs up a whole large event;
    - pairs are summed inside the joining task; only per-user partial counts are shuffled;
    - folding and joining are dealt to `tasks_for` the rows, so that a task's memory does not grow with the table. Rows that
      come in as many partitions by `id_col` are not shuffled again for the folding. `rows` saves counting those of `df`.
    """
    tasks = tasks_for(df.sparkSession, df.count() if rows is None else rows)
    id_, a, b = "_id", "_a", "_b"
    folded = _dealt(
        df.select(F.col(id_col).alias(id_), F.col(item).alias("_item"), F.col(day).alias("_day"), F.col(who).alias("_who"))
        .filter(F.col(id_).isNotNull() & F.col("_item").isNotNull())
        .groupBy(id_, "_item", "_day", "_who")
        .agg(F.count(F.lit(1)).alias("_n")),
        tasks, id_,
    )
    in_event = Window.partitionBy(id_)
    sized = folded.withColumn("_tiles", F.ceil(F.count(F.lit(1)).over(in_event) / F.lit(tile)).cast("int"))
    # an event counts once per pair and day, also when its rows name several users
    named = sized if since is None else sized.filter(F.col("_day") >= since)
    first = F.row_number().over(Window.partitionBy(id_, "_item", "_day").orderBy(F.col("_who").asc_nulls_last()))
    left = named.select(
        id_, F.col("_item").alias(a), "_day", "_who", "_n", "_tiles", (first == 1).cast("bigint").alias("_event")
    )
    right = sized.groupBy(id_, F.col("_item").alias(b)).agg(F.sum("_n").alias("_m"), F.max("_tiles").alias("_tiles"))

    every = F.sequence(F.lit(0), F.col("_tiles") - 1)
    left = left.select("*", _tile_of(a).alias("_i"), F.explode(every).alias("_j")).drop("_tiles")
    right = right.select("*", F.explode(every).alias("_i"), _tile_of(b).alias("_j")).drop("_tiles")

    left, right = (_dealt(side, tasks, id_, "_i", "_j") for side in (left, right))
    pairs = left.join(right, [id_, "_i", "_j"]).filter(F.col(a) < F.col(b))
    per_user = pairs.groupBy("_day", a, b, "_who").agg(
        F.sum(F.col("_n") * F.col("_m")).alias("_rows"), F.sum("_event").alias("_events")
    )
    counted = per_user.groupBy(F.col("_day").alias("event_date"), F.col(a).alias("scope_a"), F.col(b).alias("scope_b")).agg(
        F.sum("_rows").alias("cooccurrence_count"),
        F.sum("_events").alias("distinct_events"),
        F.count("_who").alias("distinct_users"),
    )
    return counted.select(surrogate_key("scope_a", "scope_b", "event_date").alias("scope_pair_day_key"), "*")


def _tile_of(col: str):
    return F.when(F.col("_tiles") > 1, F.pmod(F.xxhash64(col), F.col("_tiles"))).otherwise(0).cast("int")
