"""Deduplication, lookups, ranks, windows of work, and the analytics on tiny rows."""

from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from watchspan.operators import baseline as B
from watchspan.operators import cooccurrence
from watchspan.operators import incremental as I
from watchspan.operators.activity import scope_risk_daily
from watchspan.operators.cooccurrence import cooccurrence_daily
from watchspan.operators.dedup import dedup_any, dedup_latest, dedup_report
from watchspan.operators.drift import set_drift_daily, set_drift_items
from watchspan.operators.joins import lookup_join, salted_lookup
from watchspan.operators.overlap import estimate_overlap, estimate_overlap_total
from watchspan.operators.quality import check_not_null, check_unique, event_gaps
from watchspan.operators.rank import global_rank
from watchspan.plans import dims as D
from watchspan.plans import reporting as R

few = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
DAY0 = date(2024, 1, 1)


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


# --- deduplication ---


def test_dedup_latest_treats_null_as_a_key_and_breaks_ties_the_same_way(spark):
    ts = [datetime(2024, 1, 1), datetime(2024, 1, 2)]
    df = spark.createDataFrame(
        [("a", None, ts[0], 1), ("a", None, ts[1], 2), ("a", "x", ts[0], 3), (None, "x", ts[0], 4), (None, "x", None, 5)],
        "k string, b string, timestamp timestamp, v int",
    )
    assert rows_of(dedup_latest(df, ["k", "b"]), "v") == [(2,), (3,), (4,)]
    tied = spark.createDataFrame([("a", ts[0], i) for i in range(50)], "k string, timestamp timestamp, v int")
    kept = {dedup_latest(tied.repartition(n), ["k"]).first().v for n in (1, 3, 7)}
    assert len(kept) == 1


def test_dedup_cuts_hot_keys_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.timestamp_seconds("id").alias("timestamp"), "id")
    assert "WindowGroupLimit" in dedup_latest(df, ["k"])._jdf.queryExecution().executedPlan().toString()


@few
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 9)), max_size=12))
def test_dedup_is_idempotent(spark, data):
    df = spark.createDataFrame([(k, DAY0 + timedelta(days=t), v) for k, t, v in data], "k int, timestamp date, v int")
    once = dedup_latest(df, ["k"])
    assert rows_of(once, "*") == rows_of(dedup_latest(once, ["k"]), "*")
    assert dedup_any(df, ["k"]).count() == once.count() == len({k for k, _, _ in data})
    report = dedup_report(df, ["k"]).first()
    assert (report.rows_before, report.rows_removed) == (len(data), len(data) - once.count())


# --- lookups and ranks ---


def test_lookup_of_a_large_table_with_hot_and_null_keys(spark):
    facts = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 5).when(F.col("id") % 3 == 1, None).otherwise(F.col("id") % 100).cast("int").alias("k")
    )
    table = spark.range(90).select(F.col("id").cast("int").alias("k"), F.concat(F.lit("n"), "id").alias("v"))
    plain = facts.join(table, "k", "left")
    salted = salted_lookup(facts, table, ["k"], "id", facts, salts=8, one_in=1)
    assert rows_of(salted, "id", "k", "v") == rows_of(plain, "id", "k", "v")
    unseen = salted_lookup(facts, table, ["k"], "id", facts.limit(0), salts=8)
    assert rows_of(unseen, "id", "k", "v") == rows_of(plain, "id", "k", "v")


def test_lookup_checks_the_size(spark):
    facts = spark.range(10).select(F.col("id").alias("k"), "id")
    table = spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
        assert "_salt" in lookup_join(facts, table, ["k"], "id")._jdf.queryExecution().analyzed().toString()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        assert "_salt" not in lookup_join(facts, table, ["k"], "id")._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_global_rank(spark):
    df = spark.range(500).withColumn("x", F.col("id") % 7)
    got = global_rank(df, [F.desc("x"), F.asc("id")], "rank").orderBy("rank").collect()
    want = sorted(((r % 7, r) for r in range(500)), key=lambda p: (-p[0], p[1]))
    assert [(r.x, r.id) for r in got] == want and [r["rank"] for r in got] == list(range(1, 501))
    assert global_rank(df.limit(0), [F.asc("id")], "rank").count() == 0


# --- co-occurrence, drift, gaps ---

basket = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 2), st.integers(0, 2)), max_size=20)


@few
@given(basket, st.sampled_from([1, 2, 256]))
def test_cooccurrence_equals_pairing_by_hand(spark, data, tile):
    rows = [(e, f"s{i}", DAY0 + timedelta(days=d), None if u == 2 else u) for e, i, d, u in data]
    df = spark.createDataFrame(rows, "unique_id int, scope_name string, event_date date, user_key int")
    want = {}
    for e1, s1, d1, u1 in rows:
        for e2, s2, _, _ in rows:
            if e1 == e2 and s1 < s2:
                n, events, users = want.setdefault((d1, s1, s2), [0, set(), set()])
                want[(d1, s1, s2)][0] = n + 1
                events.add(e1)
                if u1 is not None:
                    users.add(u1)
    got = {
        (r.event_date, r.scope_a, r.scope_b): (r.cooccurrence_count, r.distinct_events, r.distinct_users)
        for r in cooccurrence_daily(df, tile=tile).collect()
    }
    assert got == {k: (n, len(e), len(u)) for k, (n, e, u) in want.items()}


def test_cooccurrence_deals_more_rows_to_more_tasks(spark, monkeypatch):
    rows = spark.range(600).selectExpr("id % 150 as unique_id", "'s' || id % 7 as scope_name", "date'2024-01-01' as event_date", "id % 9 as user_key")
    plain = cooccurrence_daily(rows)
    monkeypatch.setattr(cooccurrence, "TASK_ROWS", 20)
    dealt = cooccurrence_daily(rows)
    assert cooccurrence.tasks_for(spark, 80) is None and cooccurrence.tasks_for(spark, 600) == 30 and cooccurrence.tasks_for(spark, 6000) == 300
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "_id" in plan and plan.count(", 30), REPARTITION_BY_NUM") >= 3
    assert sorted(dealt.collect()) == sorted(plain.collect())


@few
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 3), st.integers(0, 4)), max_size=15))
def test_drift_balances(spark, data):
    df = spark.createDataFrame(
        [(f"a{a}", f"s{s}", DAY0 + timedelta(days=d)) for a, s, d in data], "app_id string, scope_key string, event_date date"
    )
    sets = {}
    for a, s, d in data:
        sets.setdefault((f"a{a}", d), set()).add(s)
    rows = set_drift_daily(df).collect()
    for r in rows:
        d = (r.event_date - DAY0).days
        now, before = sets.get((r.app_id, d), set()), sets.get((r.app_id, d - 1), set())
        assert (r.total_scopes, r.prior_day_scopes) == (len(now), len(before))
        assert (r.new_scopes_count, r.removed_scopes_count) == (len(now - before), len(before - now))
        assert r.total_scopes == r.prior_day_scopes + r.net_scope_change
    assert set_drift_items(df).count() == sum(r.new_scopes_count + r.removed_scopes_count for r in rows)


def test_drift_from_a_day_on_knows_the_day_before(spark):
    df = spark.createDataFrame([("a", "s", DAY0 + timedelta(days=d)) for d in range(4)], "app_id string, scope_key string, event_date date")
    full = set_drift_daily(df).filter(F.col("event_date") >= "2024-01-03")
    tail = set_drift_daily(df, since=F.lit("2024-01-03").cast("date"))
    assert rows_of(full, "*") == rows_of(tail, "*")
    assert tail.agg(F.sum("new_scopes_count")).first()[0] == 0


def test_gaps_count_zero_days_and_end_at_the_calendar(spark):
    daily = spark.createDataFrame(
        [("a", DAY0, 3), ("a", DAY0 + timedelta(days=1), 0), ("b", DAY0 + timedelta(days=2), 1), (None, DAY0, 1)],
        "app_id string, event_date date, total_events bigint",
    )
    bounds = spark.createDataFrame([(DAY0, DAY0 + timedelta(days=2))], "min_day date, max_day date")
    got = rows_of(event_gaps(daily, bounds, F.lit("2024-01-03").cast("date")), "app_id", "event_date", "total_events")
    by_app = {}
    for app, day, n in got:
        assert n == 0
        by_app.setdefault(app, []).append((day - DAY0).days)
    assert by_app == {"a": [1, 2], "b": [0, 1], None: [0, 1, 2]}
    assert event_gaps(daily, bounds, F.lit("2024-06-01").cast("date")).count() == 0


# --- baselines ---


def test_baseline_excludes_the_current_row(spark):
    daily = spark.createDataFrame([("a", DAY0 + timedelta(days=3 * d), v) for d, v in enumerate((10, 10, 14, 0))], "k string, day date, total int")
    rows = B.baseline(daily, "k", "day", {"total": ("totals", "total")}, (2,)).orderBy("day").collect()
    assert [r.mean_totals_2d for r in rows] == [None, 10.0, 10.0, 12.0]
    assert [r.std_totals_2d for r in rows] == [None, 0.0, 0.0, 2.0]
    assert [r.total_z_score_2d for r in rows] == [None, None, None, -6.0]
    assert [r.total_pct_change_2d for r in rows] == [None, 0.0, 0.4, -1.0]
    by_days = B.baseline(daily, "k", "day", {"total": ("totals", "total")}, (2,), calendar=True)
    assert by_days.filter(F.col("mean_totals_2d").isNotNull()).count() == 0


def test_novelty_counts_first_days_inside_the_window(spark):
    df = spark.createDataFrame(
        [("u", "x", DAY0), ("u", "x", date(2024, 3, 1)), ("u", "y", date(2024, 3, 1)), ("u", None, date(2024, 3, 1)), (None, "z", date(2024, 3, 1))],
        "u string, i string, d date",
    )
    assert rows_of(B.novelty(df, "u", "i", "d", F.lit("2024-03-02").cast("date"), 60), "*") == [("u", date(2024, 3, 1), 2)]
    assert rows_of(B.novelty(df, "u", "i", "d", F.lit("2024-02-29").cast("date"), 60), "*") == [
        ("u", DAY0, 1), ("u", date(2024, 3, 1), 1),
    ]


# --- dimensions and reports ---


def stg(spark, **frames):
    from watchspan.plans.staging import stage
    from watchspan.schemas import APPS, EVENT_SCHEMAS

    out = {}
    for app in APPS:
        schema = EVENT_SCHEMAS[app]
        rows = [tuple(r.get(n) for n in schema.names) for r in frames.get(app, [])]
        out[app] = stage(spark.createDataFrame(rows, schema), app)
    return out


def test_dim_ip_candidates(spark):
    t = datetime(2024, 1, 1)
    frames = stg(
        spark,
        token=[
            {"timestamp": t, "ip_address": "list", "asn": 0, "asn_list": [0, 9]},
            {"timestamp": t, "ip_address": "single", "asn": 5},
            {"timestamp": t, "ip_address": "zero", "asn": 0, "asn_list": [0]},
            {"timestamp": t, "ip_address": "none"},
            {"timestamp": t, "ip_address": None, "asn": 3},
        ],
        login=[{"timestamp": t, "ip_address": "single", "asn": 7, "asn_list": [7], "region_code": "US"}],
    )
    got = {r.ip_address: (r.asn, r.has_unknown_asn, r.region_code) for r in D.dim_ip(frames).collect()}
    assert got == {"list": (9, True, None), "single": (7, False, "US"), "zero": (None, True, None)}
    assert "none" in {r.ip_address for r in D.dim_ip(frames, keep_unknown=True).collect()}


def test_dim_user_keeps_null_parts_but_facts_never_match_them(spark):
    from watchspan.plans.facts import fact

    t = datetime(2024, 1, 1)
    frames = stg(
        spark,
        saml=[{"timestamp": t, "actor_email": "a", "actor_profile_id": "p", "orgunit_path": "/x"}],
        drive=[{"timestamp": t, "actor_email": "a", "actor_profile_id": "p", "actor_is_collaborator_account": True}],
        login=[{"timestamp": t, "unique_id": "1", "actor_email": None, "actor_profile_id": "p"}, {"timestamp": t, "unique_id": "2", "actor_email": "a", "actor_profile_id": "p"}],
    )
    users = D.dim_user(frames)
    assert rows_of(users, "actor_email", "orgunit_path", "is_collaborator") == [("a", "/x", True), (None, None, False)]
    dims = {"user": users, "ip": D.dim_ip(frames), "application": D.dim_application(frames)}
    keyed = {r.unique_id: r.user_key is not None for r in fact("login", frames, dims).collect()}
    assert keyed == {"1": False, "2": True}


def test_top_reports(spark):
    t = datetime(2024, 1, 10)
    rows = [("a", "p", t, 5, "m1"), ("a", "p", t, None, None), ("b", "q", t - timedelta(hours=48), 50, "m2"), ("c", "r", t - timedelta(hours=49), 1, "m1")]
    df = spark.createDataFrame(rows, "actor_email string, actor_profile_id string, timestamp timestamp, num_bytes bigint, method_name string")
    users = R.top_users(df).orderBy("rank_by_events").collect()
    assert [(r.actor_email, r.event_count, r.total_bytes) for r in users] == [("a", 2, 5), ("b", 1, 50)]
    assert rows_of(R.top_methods(df), "method_name", "rank_by_bytes") == [("m1", 2), ("m2", 1)]
    assert R.top_users(df.limit(0), limit=1).count() == 0
    assert R.last_hours(df).count() == 3


def test_spikes_need_spread(spark):
    t = datetime(2024, 1, 10)
    hours = [("s", t - timedelta(hours=h), 100 if h == 1 else 10, 10) for h in range(30)] + [("flat", t - timedelta(hours=h), 5, 5) for h in range(5)]
    df = spark.createDataFrame(hours, "source string, event_hour timestamp, total_events bigint, distinct_events bigint").withColumn("event_date", F.to_date("event_hour"))
    got = R.volume_spikes(df, F.lit(str(t)).cast("timestamp")).collect()
    assert [(r.source, r.total_events) for r in got] == [("s", 100)] and got[0].z_score > 3


def test_high_risk_of_missing_bucket_and_service(spark):
    df = spark.createDataFrame(
        [(DAY0, "e1", "u", None, None), (DAY0, "e1", "u", "DRIVE", None), (DAY0, "e2", None, "OTHER", "gmail")],
        "event_date date, unique_id string, user_key string, product_bucket string, service string",
    )
    r = scope_risk_daily(df).first()
    assert (r.total_scope_usages, r.distinct_events, r.distinct_users, r.high_risk_scope_usages, r.high_risk_events) == (3, 2, 1, 2, 2)


# --- windows of work and cursors ---


def test_time_windows_leave_out_a_short_rest(spark):
    got = rows_of(I.time_windows(spark, "2024-01-01 00:00:00", "2024-01-01 12:00:00.5", 6), "idx", "window_start", "window_end")
    assert [(i, s.hour, e.hour) for i, s, e in got] == [(0, 0, 6), (1, 6, 12)]
    assert I.time_windows(spark, "2024-01-02 00:00:00", "2024-01-01 00:00:00").count() == 0


def test_date_batches(spark):
    got = rows_of(I.date_batches(spark, "2024-01-01", "2024-01-05", 2), "*")
    assert [(s.day, e.day) for s, e in got] == [(1, 2), (3, 4), (5, 5)]
    assert I.date_batches(spark, "2024-01-05", "2024-01-01", 2).count() == 0


def test_date_window(spark):
    def days(last):
        start, end = I.date_window(F.lit("2024-01-05 00:01").cast("timestamp"), F.lit("2024-01-09 10:00").cast("timestamp"), last)
        return tuple(d.day for d in spark.range(1).select(start, end).first())

    assert days(None) == (4, 9)
    assert days(F.lit("2024-01-07 10:00").cast("timestamp")) == (4, 7)
    assert days(F.lit("2024-02-07 10:00").cast("timestamp")) == (4, 9)


def test_window_hours(spark):
    df = spark.createDataFrame([(a,) for a in ("admin", "login", "saml", "drive", "token")], "app string")
    assert [r[0] for r in df.select(I.window_hours(F.col("app"))).collect()] == [24, 48, 48, 48, 6]


def test_replace_tail_bounds(spark):
    ts = [datetime(2024, 1, d) for d in (1, 2, 3)]
    old = spark.createDataFrame([(t, "old") for t in ts], "timestamp timestamp, v string")
    new = spark.createDataFrame([(t, "new") for t in ts], "timestamp timestamp, v string")
    assert [r.v for r in I.replace_tail(old, new, "timestamp", ts[1]).orderBy("timestamp").collect()] == ["old", "old", "new"]
    first = I.replace_tail(old.limit(0), new, "timestamp", ts[0], first_run=True)
    assert first.count() == 3
    assert I.next_cursor(old, new.limit(0)) == ts[2] and I.next_cursor(old.limit(0)) is None


@few
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), max_size=10), st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), max_size=10))
def test_upsert_replaces_inserts_and_is_idempotent(spark, old, new):
    schema = "k int, v int, timestamp date"

    def frame(data):
        return spark.createDataFrame([(k, v, DAY0 + timedelta(days=v)) for k, v in data], schema)

    target = dedup_latest(frame(old), ["k"])
    once = I.upsert(target, frame(new), ["k"], "timestamp")
    want = {k: v for k, v in sorted(old)} | {k: v for k, v in sorted(new)}
    assert {r.k: r.v for r in once.collect()} == want and once.count() == len(want)
    assert rows_of(I.upsert(once, frame(new), ["k"], "timestamp"), "*") == rows_of(once, "*")


def test_upsert_follows_the_columns_of_the_updates(spark):
    target = spark.createDataFrame([(1, "gone")], "k int, dropped string")
    updates = spark.createDataFrame([(2, "new")], "k int, added string")
    assert rows_of(I.upsert(target, updates, ["k"]), "k", "added") == [(1, None), (2, "new")]


# --- lateness and checks ---


def test_overlap_estimate(spark):
    t = datetime(2024, 1, 1)
    rows = [("a", t, t + timedelta(hours=6), t + timedelta(minutes=m), t + timedelta(hours=5)) for m in (1, 2, 4)]
    rows += [("a", t, t + timedelta(hours=6), None, None), ("b", t, t, None, None), ("c", t, t + timedelta(hours=1), t - timedelta(minutes=5), t)]
    df = spark.createDataFrame(rows, "app string, start timestamp, end timestamp, earliest_event_time timestamp, latest_event_time timestamp")
    got = {r.app: r for r in estimate_overlap(df).collect()}
    a = got["a"]
    assert (a.files_considered, a.runs_used, a.head_gap_p, a.head_gap_mean, a.tail_gap_max) == (4, 3, 3.8, 2.333, 60.0)
    assert [got[x].recommended_overlap_minutes for x in "abc"] == [5, 0, 1]
    assert estimate_overlap(df, cap=3).filter("app = 'a'").first().recommended_overlap_minutes == 3
    early = {r.app: r.head_gap_max for r in estimate_overlap(df, mode="early").collect()}
    assert (early["a"], early["c"]) == (0.0, 5.0)
    total = estimate_overlap_total(estimate_overlap(df)).first()
    assert (total.apps_considered, total.apps_with_runs, total.total_runs_used, total.recommended_max_minutes) == (3, 2, 4, 5)
    assert total.total_duration_minutes == 305.0


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, None), (None, "b")], "k int, v string")
    assert rows_of(check_not_null(df, ["k", "v"], "m"), "column_name", "violations") == [("k", 2), ("v", 2)]
    assert check_unique(df, ["k"], "m").first().violations == 1


@pytest.mark.parametrize("cut", [3, 8, 14])
def test_carried_on_drift_equals_the_full_build(spark, cut):
    data = [(f"a{d % 2}", f"s{(d * 7 + i) % 5}", DAY0 + timedelta(days=d)) for d in range(16) for i in range(d % 3 + 1)]
    df = spark.createDataFrame(data, "app_id string, scope_key string, event_date date")
    bound = F.lit(str(DAY0 + timedelta(days=cut))).cast("date")
    full = set_drift_daily(df)
    old = set_drift_daily(df.filter(F.col("event_date") <= bound)).filter(F.col("event_date") < F.date_sub(bound, 1))
    new = set_drift_daily(df, since=F.date_sub(bound, 1))
    assert rows_of(old.unionByName(new), "*") == rows_of(full, "*")
