"""MD5 surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the marker a null key column hashes as.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: str | Column) -> Column:
    """md5 of the dash-joined text of the key columns; null is a key value of its own."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))
