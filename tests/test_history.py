"""States, versions and the index of keys that later builds and merges rely on."""

import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from watchspan.operators.joins import heavy_hashes
from watchspan.operators.quality import check_not_null, check_table, check_unique
from watchspan.plans import driver_views as V
from watchspan.plans import carry, models
from watchspan.plans.models import Warehouse
from watchspan.schemas import APPS
from watchspan.sources import control as C
from watchspan.sources.changes import BuildLog, Snapshots, day_versions
from watchspan.sources.key_index import KeyIndex
from watchspan.sources.processed import table_path, write_daily
from watchspan.sources.warehouse import load, merge_days, replace_listed_days, staged, write_days
from watchspan.streaming import activity_stream as S

DAY0 = date(2024, 1, 1)


def day_rows(spark, *rows):
    """(key, day number, value)"""
    data = [(k, DAY0 + timedelta(days=d), v) for k, d, v in rows]
    return spark.createDataFrame(data, "k string, event_date date, v int").withColumn("timestamp", F.col("event_date").cast("timestamp"))


def scans(df):
    """For each file scan of the plan, what it filters partitions by; None where the table has none."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    return [re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", x).group(1) for x in lines if "FileScan" in x and "event_date#" in x]


def test_versions_and_pending_days(spark, tmp_path):
    path, log = str(tmp_path / "t"), BuildLog(spark, str(tmp_path / "_built"))
    write_days(day_rows(spark, ("a", 0, 1), ("b", 1, 1), ("c", 2, 1)), path)
    days, now = log.pending("m", {"t": path})
    assert days is None and {d for _, d in now} == {DAY0 + timedelta(days=i) for i in range(3)}
    log.record("m", now)
    assert log.pending("m", {"t": path})[0] == set()
    assert log.pending("other", {"t": path})[0] is None
    replace_listed_days(spark, path, day_rows(spark, ("b", 1, 9)), {DAY0 + timedelta(days=1), DAY0 + timedelta(days=2)})
    days, now = log.pending("m", {"t": path})
    assert days == {DAY0 + timedelta(days=1), DAY0 + timedelta(days=2)}
    log.record("m", now)
    assert log.pending("m", {"t": path, "new": str(tmp_path / "none")})[0] == set()
    assert len(day_versions(spark, path)) == 2 and day_versions(spark, str(tmp_path / "none")) == {}


def test_a_model_built_from_nothing_is_known(spark, tmp_path):
    log = BuildLog(spark, str(tmp_path / "_built"))
    log.record("m", {})
    assert log.pending("m", {"t": str(tmp_path / "none")})[0] == set()


def test_snapshots(spark, tmp_path):
    states = Snapshots(spark, str(tmp_path / "s"), keep=2)
    assert states.days() == [] and states.at_most(DAY0) is None
    for d, v in ((0, 1), (2, 2), (2, 3), (4, 4)):
        states.save(spark.range(v, v + 1), DAY0 + timedelta(days=d))
    assert states.days() == [DAY0 + timedelta(days=2), DAY0 + timedelta(days=4)]
    day, df = states.at_most(DAY0 + timedelta(days=3))
    assert day == DAY0 + timedelta(days=2) and df.first().id == 3
    states.drop_after(DAY0 + timedelta(days=2))
    assert states.days() == [DAY0 + timedelta(days=2)]
    states.drop_after(None)
    assert states.days() == []


def test_index_of_keys_reads_touched_buckets_and_days(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(f"k{i}", i % 20, i) for i in range(200)] + [(None, 3, -1)]
    merge_days(spark, path, day_rows(spark, *rows), ["k"], indexed=True)
    index = KeyIndex(spark, path, ["k"])
    one = day_rows(spark, ("k47", 0, 0))
    assert index.days_of(one) == {DAY0 + timedelta(days=7)}
    assert index.days_of(day_rows(spark, ("unknown", 0, 0))) == set()
    assert index.days_of(day_rows(spark, (None, 0, 0))) == {DAY0 + timedelta(days=3)}
    touched = sorted({r.bucket for r in index.candidates(one).collect()})
    plan = index.entries(touched)._jdf.queryExecution().executedPlan().toString()
    assert len(touched) == 1 and f"bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]

    before = {p: [f.name for f in p.iterdir()] for p in (tmp_path / "t").iterdir() if p.is_dir()}
    merge_days(spark, path, day_rows(spark, ("k47", 15, 100), ("new", 15, 1), (None, 4, 5)), ["k"], indexed=True)
    after = {p: [f.name for f in p.iterdir()] for p in (tmp_path / "t").iterdir() if p.is_dir()}
    changed = sorted(int(p.name[-2:]) - 1 for p in before if before[p] != after[p])
    assert changed == [3, 4, 7, 15]
    got = {r.k: (r.event_date, r.v) for r in load(spark, path).collect()}
    assert len(got) == 202 and got["k47"] == (DAY0 + timedelta(days=15), 100) and got[None] == (DAY0 + timedelta(days=4), 5)
    index.compact()
    assert index.days_of(one) == {DAY0 + timedelta(days=7), DAY0 + timedelta(days=15)}


def test_index_is_made_for_a_table_without_one(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_days(spark, path, day_rows(spark, ("a", 0, 1), ("b", 5, 1)), ["k"])
    merge_days(spark, path, day_rows(spark, ("a", 3, 2)), ["k"], indexed=True)
    assert {(r.k, r.v) for r in load(spark, path).collect()} == {("a", 2), ("b", 1)}


def test_one_pass_checks_equal_single_ones(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 1, None), (None, 2, "x"), (None, 2, "x"), ("b", 3, "y")], "p string, q int, r string")
    for table in (df, df.limit(0)):
        want = check_not_null(table, ["p", "q"], "m").unionByName(check_unique(table, ["p"], "m")).unionByName(check_unique(table, ["q", "r"], "m"))
        got = check_table(table, ["p", "q"], ["p", ["q", "r"]], "m")
        assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    plan = check_table(df.repartition(3), ["p"], ["q"], "m")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION") == 1


def test_heavy_hashes_of_many_keys(spark):
    df = spark.range(10_000).selectExpr("case when id % 3 = 0 then 'hot' else 'k' || id end as a", "case when id % 2 = 0 then id % 4 end as b")
    found = heavy_hashes([(df, {"one": ["a"], "both": ["a", "b"]}), (df.filter("false"), {"none": ["a"]})], share=0.01)
    hot = spark.range(1).select(F.xxhash64(F.lit("hot")).alias("h")).first().h
    assert found["one"] == [hot] and found["none"] == []
    pairs = {spark.range(1).select(F.xxhash64(F.lit("hot"), F.lit(b).cast("bigint")).alias("h")).first().h for b in (0, 2)}
    assert set(found["both"]) == pairs


@pytest.fixture
def processed(spark, sf_dir, tmp_path):
    """Processed events of one week; a step stores them without every fifth, the next one all and with a day that lost its rows."""
    frames = {a: V.processed(spark, sf_dir, a).filter("timestamp >= '2024-01-08' and timestamp < '2024-01-15'").cache() for a in APPS}

    def store(part):
        for app, df in frames.items():
            keep = "crc32(cast(unique_id as binary)) % 5 <> 0" if part == 0 else "true"
            write_daily(df.filter(keep), table_path(str(tmp_path / "processed"), app))

    return store


def test_second_build_of_dimensions_and_facts_reads_changed_days_only(spark, processed, tmp_path, monkeypatch):
    def build(full=False):
        house = Warehouse(spark, str(tmp_path / ("full" if full else "models")), str(tmp_path / "processed"))
        house.build_staging()
        house.build_dims()
        house.build_facts()
        return house.tables

    processed(0)
    build()
    plans = []

    def kept(spark_, path, df, days, *rest):
        if days:
            plans.append((path, scans(df)))
        replace_listed_days(spark_, path, df, days, *rest)

    monkeypatch.setattr(carry, "replace_listed_days", kept)
    monkeypatch.setattr(models, "replace_listed_days", kept)
    # one day comes with late rows, another one loses all its rows
    late = spark.read.parquet(table_path(str(tmp_path / "processed"), "saml")).filter("event_date = '2024-01-10'").drop("event_date")
    late = staged(late.unionByName(late.withColumns({"unique_id": F.concat("unique_id", F.lit("x")), "actor_email": F.lit("late@example.com")})))
    write_daily(late, table_path(str(tmp_path / "processed"), "saml"))
    replace_listed_days(spark, table_path(str(tmp_path / "processed"), "saml"), late.withColumn("event_date", F.to_date("timestamp")).limit(0), {date(2024, 1, 12)})
    step = build()
    assert {p.rsplit("/", 2)[-1] for p, _ in plans} >= {"days", "months", "fact_saml_event"}
    for path, filters in plans:
        assert filters and all("event_date" in f for f in filters), path
    assert not any("fact_token_event" in p for p, _ in plans)
    full = build(full=True)
    for name in ("dim_user", "dim_ip_address", "dim_application", "dim_scope", "dim_time", "fact_saml_event"):
        cols = sorted(full[name].columns)
        assert sorted(map(str, step[name].select(cols).collect())) == sorted(map(str, full[name].select(cols).collect())), name
    assert step["dim_user"].filter("actor_email = 'late@example.com'").count() > 0


def test_control_log_keeps_rows_appended_while_it_is_folded(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "control")
    for i in range(3):
        C.update_control(spark, path, "token", "processor", datetime(2024, 1, 1 + i), updated_at=datetime(2024, 1, 1 + i))
    append = C._append

    def with_another(spark_, path_, rows):
        append(spark_, path_, rows)
        append(spark_, path_, [("saml", "loader", datetime(2024, 2, 1), None, None, None, "success", datetime(2024, 2, 1))])

    monkeypatch.setattr(C, "_append", with_another)
    C.compact_control(spark, path)
    monkeypatch.undo()
    assert {(r.app, str(r.cursor)[:10]) for r in C.read_control(spark, path).collect()} == {("token", "2024-01-03"), ("saml", "2024-02-01")}
    C.compact_control(spark, path)
    assert len(list((tmp_path / "control").glob("*.parquet"))) == 1


def test_ledger_is_folded(spark, tmp_path):
    ledger = S.BatchLedger(spark, str(tmp_path / "ledger"), fold_at=3)
    assert ledger.last() == -1
    for i in range(7):
        ledger.add(i)
    assert ledger.last() == 6 and len(list((tmp_path / "ledger").glob("*.parquet"))) < 4


def test_a_batch_cut_short_is_stored_once(spark, sf_dir, tmp_path):
    lines = V.raw_lines(spark, sf_dir, "drive", broken=True).select("value")
    paths = [str(tmp_path / n) for n in ("events", "letters", "ledger")]
    sink = S.letter_sink("drive", *paths)
    # both sinks were written, the ledger was not
    sink(lines, 0)
    for f in (tmp_path / "ledger").iterdir():
        f.unlink()
    sink(lines, 0)
    n = lines.count()
    assert spark.read.parquet(paths[0]).count() + spark.read.parquet(paths[1]).count() == n
