"""Run a registered query and its SQL side by side and compare rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    return v


def compare(spark_df, con, sql: str) -> dict:
    """Row counts, column names and types, and the rows either side lacks."""
    cols = sorted(spark_df.columns)
    got = Counter(tuple(_plain(v) for v in r) for r in spark_df.select(*(f"`{c}`" for c in cols)).collect())
    res = con.execute(sql)
    types = {d[0]: str(d[1]) for d in res.description}
    order = [[d[0] for d in res.description].index(c) if c in types else None for c in cols]
    if None in order or len(types) != len(cols):
        return {"ok": False, "columns": (cols, sorted(types))}
    want = Counter(tuple(_plain(r[i]) for i in order) for r in res.fetchall())
    names = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}
    typed = {c: (t, types[c]) for c, t in spark_df.dtypes if names.get(t) != types[c]}
    missing, extra = want - got, got - want
    return {
        "ok": not missing and not extra and not typed,
        "rows": sum(got.values()),
        "types": typed,
        "missing": list(missing)[:2],
        "extra": list(extra)[:2],
        "n_missing": sum(missing.values()),
        "n_extra": sum(extra.values()),
    }
