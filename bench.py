"""Bench of the headline queries: one JSON line with seconds per query.

Runs at $BENCH_SF_DIR on local[$BENCH_CPUS]. Each query runs once to warm up and is then timed in full,
plan building included, with all its rows computed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from watchspan.plans import driver_views as V  # noqa: E402
from watchspan.plans.driver_queries import all_queries  # noqa: E402
from watchspan.plans.ingest import processed_frames  # noqa: E402
from watchspan.schemas import APPS  # noqa: E402
from watchspan.session import local_session  # noqa: E402
from watchspan.sources.raw import parse_lines, split_errors  # noqa: E402

HEADLINE = [
    "user_activity_daily", "app_activity_daily", "ip_activity_daily", "geo_activity_daily", "event_volume_hourly",
    "scope_usage_daily", "scope_risk_daily", "scope_cooccurrence", "high_risk_pairs",
    "app_baseline", "user_baseline", "scope_drift_daily", "event_gaps",
    "dim_user", "dim_ip", "fact_token", "fact_token_scope", "incremental_upsert", "latest_rows",
    "volume_spikes", "top_apps", "top_users", "top_methods", "top_user", "top_method",
]


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8)
    queries = all_queries()
    seconds = {}
    for name in HEADLINE:
        drain(queries[name](spark, sf_dir))
        seconds[name] = timed(lambda: drain(queries[name](spark, sf_dir)))

    # parse, flatten, deduplicate and store as Parquet, from JSON files of all five applications
    raw = tempfile.mkdtemp(prefix="watchspan-bench-")
    rows = 0
    for app in APPS:
        lines = V.raw_lines(spark, sf_dir, app).select("value").repartition(int(cpus) if cpus.isdigit() else 8)
        lines.write.text(f"{raw}/raw/{app}")
        rows += spark.read.text(f"{raw}/raw/{app}").count()

    def store(turn: int) -> None:
        for app in APPS:
            good, _ = split_errors(parse_lines(spark.read.text(f"{raw}/raw/{app}")))
            for kind, df in processed_frames(good, app).items():
                df.write.mode("overwrite").parquet(f"{raw}/out{turn}/{app}/{kind}")

    store(0)
    seconds["ingest_all_apps"] = timed(lambda: store(1))
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "ingest_rows": rows,
                "ingest_rows_per_sec": round(rows / seconds["ingest_all_apps"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
