"""A global row number that never passes all rows through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from watchspan.session import ensure_checkpoint_dir

_OFFSET_BITS = 33  # monotonically_increasing_id: partition above, position inside the partition below


def global_rank(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Number rows 1..n in the given order, which must be unique for a repeatable result.

    The range-partitioned sort is written once to the checkpoint folder, which fixes partitions and
    positions. A rank is then the position plus the number of rows in earlier partitions; only those
    counts, one per partition, are gathered and broadcast.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = df.orderBy(*order).checkpoint().withColumn("_id", F.monotonically_increasing_id())
    placed = placed.withColumns(
        {
            "_part": F.shiftright("_id", _OFFSET_BITS),
            "_pos": F.col("_id").bitwiseAND(F.lit((1 << _OFFSET_BITS) - 1)),
        }
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    ranked = placed.join(F.broadcast(starts), "_part")
    return ranked.select(*df.columns, (F.col("_start") + F.col("_pos") + 1).alias(name))
