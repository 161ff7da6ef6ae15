"""Golden edge rows (FIXTURES.md section 3): hand-made inputs with hand-computed answers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tests.fixtures import ACCOUNT_SCHEMA, APP_SCHEMA, D, TS, daily_rows, frames, session
from workpulse.operators.apps import app_productivity
from workpulse.operators.cohorts import retention_cohorts
from workpulse.operators.daily import daily_user_metrics
from workpulse.operators.engagement import add_active_days_l7d, add_engagement
from workpulse.operators.enrich import enrich_sessions
from workpulse.operators.metrics import engagement_distribution
from workpulse.operators.quality import dedupe_sessions, duplicate_sessions
from workpulse.operators.ranks import add_productivity_ranks
from workpulse.operators.trends import add_trends
from workpulse.operators.user_activity import user_activity_metrics


def enrich(spark, sessions, **kw):
    f = frames(spark, sessions, **kw)
    return enrich_sessions(f["sessions"], f["users"], f["accounts"], f["apps"], f["projects"])


def by_id(df, key="session_id"):
    return {r[key]: r for r in df.collect()}


def test_01_lag_is_row_based_and_avg_spans_more_than_a_week(spark):
    days = [D(2025, 8, 1) + dt.timedelta(days=2 * i) for i in range(10)]
    df = daily_rows(spark, [(d, "U", "A", float(i + 1)) for i, d in enumerate(days)])
    out = {r["date"]: r for r in add_trends(df).collect()}
    assert out[days[7]]["total_hours_last_week"] == 1.0  # 7th earlier row, 14 days back
    assert out[days[6]]["total_hours_last_week"] is None
    # rows 4..10 (values 4..10) span 12 days: average 7.0
    assert out[days[9]]["total_hours_7d_avg"] == 7.0
    assert out[days[9]]["total_hours_30d_avg"] == 5.5


def test_02_l7d_window_is_seven_calendar_days(spark):
    d = D(2025, 8, 20)
    df = daily_rows(spark, [(d - dt.timedelta(days=7), "U", "A", 1.0),
                            (d - dt.timedelta(days=6), "U", "A", 1.0), (d, "U", "A", 1.0)])
    out = {r["date"]: r["active_days_l7d"] for r in add_active_days_l7d(df).collect()}
    assert out[d] == 2


def test_03_history_before_cutoff_feeds_l7d_not_lag_or_avg(spark):
    as_of = D(2025, 9, 30)
    cutoff = as_of - dt.timedelta(days=10)
    days = [cutoff - dt.timedelta(days=3)] + [cutoff + dt.timedelta(days=i) for i in range(1, 10)]
    rows = [session(f"S{i}", day=d, minutes=300.0 if i == 0 else 60.0) for i, d in enumerate(days)]
    daily = daily_user_metrics(enrich(spark, rows))
    out = {r["date"]: r for r in user_activity_metrics(daily, as_of, 10).collect()}
    first = cutoff + dt.timedelta(days=1)
    assert min(out) == first and len(out) == 9
    assert out[first]["active_days_l7d"] == 2  # counts the day before the cutoff
    assert out[first]["total_hours_7d_avg"] == 1.0  # but the average does not see it
    assert out[cutoff + dt.timedelta(days=8)]["total_hours_last_week"] == 1.0
    assert out[cutoff + dt.timedelta(days=7)]["total_hours_last_week"] is None


def test_04_user_in_two_accounts(spark):
    d = D(2025, 8, 4)
    df = daily_rows(spark, [(d, "U", "A", 1.0), (d, "U", "B", 2.0)])
    l7d = [r["active_days_l7d"] for r in add_active_days_l7d(df).collect()]
    assert l7d == [1, 1]
    cohorts = retention_cohorts(df).collect()
    assert sorted((r["account_id"], r["cohort_size"]) for r in cohorts) == [("A", 1), ("B", 1)]


def test_05_null_user_is_inactive(spark):
    d = D(2025, 8, 4)
    df = daily_rows(spark, [(d, None, "A", 1.0), (d - dt.timedelta(days=1), None, "A", 1.0)])
    out = add_engagement(add_active_days_l7d(df)).collect()
    assert {r["active_days_l7d"] for r in out} == {0}
    assert {r["engagement_tier"] for r in out} == {"Inactive"}


def test_06_day_with_only_invalid_sessions(spark):
    rows = [session("S1", minutes=0.5), session("S2", minutes=600.0)]
    r = daily_user_metrics(enrich(spark, rows)).collect()[0]
    assert (r["total_sessions"], r["valid_sessions"], r["total_hours"]) == (2, 0, 0.0)
    assert (r["idle_ratio_pct"], r["productivity_pct"]) == (0.0, 0.0)
    assert r["avg_activity_pct"] is None
    assert (r["is_active_day"], r["is_high_idle_day"]) == (0, 0)


def test_07_duration_bounds(spark):
    rows = [session(f"S{i}", minutes=m) for i, m in enumerate([0.99, 1.0, 480.0, 480.01, None])]
    out = by_id(enrich(spark, rows))
    assert [out[f"S{i}"]["is_valid_session"] for i in range(5)] == [0, 1, 1, 0, 0]
    assert [out[f"S{i}"]["is_too_short"] for i in range(5)] == [1, 0, 0, 0, 0]
    assert [out[f"S{i}"]["is_too_long"] for i in range(5)] == [0, 0, 0, 1, 0]
    assert out["S4"]["end_timestamp"] is None


def test_08_exact_half_up_hours(spark):
    out = by_id(enrich(spark, [session("S1", minutes=0.30), session("S2", minutes=22.57,
                                                                    activity=50.0)]))
    assert out["S1"]["duration_hours"] == 0.01  # 0.005 exactly, rounded up
    assert out["S2"]["duration_hours"] == 0.38
    assert out["S2"]["end_timestamp"] == TS(2025, 8, 4, 9, 22, 34)  # 22.57 min = 22 min 34.2 s


def test_09_high_idle_boundary(spark):
    out = by_id(enrich(spark, [session("S1", activity=70.0), session("S2", activity=70.01)]))
    assert (out["S1"]["is_high_idle"], out["S2"]["is_high_idle"]) == (1, 0)
    assert out["S1"]["idle_ratio_pct"] == 30.0


def test_10_late_arrival(spark):
    d = D(2025, 8, 4)
    rows = [session("S1", day=d, start=TS(2025, 8, 5, 9, 0)),
            session("S2", day=d, start=TS(2025, 8, 3, 23, 0))]
    out = by_id(enrich(spark, rows))
    assert (out["S1"]["is_late_arrival"], out["S1"]["is_valid_session"]) == (1, 0)
    assert (out["S2"]["is_late_arrival"], out["S2"]["is_valid_session"]) == (0, 1)


def test_11_weekend_and_week_start(spark):
    sat, sun, mon = D(2025, 8, 2), D(2025, 8, 3), D(2025, 8, 4)
    out = by_id(enrich(spark, [session("S1", day=sat), session("S2", day=sun), session("S3", day=mon)]))
    assert [out[s]["is_weekend"] for s in ("S1", "S2", "S3")] == [1, 1, 0]
    from workpulse.functions.dates import week_start
    weeks = spark.createDataFrame([(sat,), (sun,), (mon,)], "d date").select(week_start("d").alias("w"))
    assert [r["w"] for r in weeks.collect()] == [D(2025, 7, 28), D(2025, 7, 28), mon]


def test_12_unmatched_dimensions_keep_the_row(spark):
    rows = [session("S1", user="USR0999", app="APP777", project="PRJ404"), session("S2", project=None)]
    out = by_id(enrich(spark, rows))
    assert len(out) == 2
    r = out["S1"]
    assert (r["email"], r["app_name"], r["project_name"]) == (None, None, None)
    assert out["S2"]["project_name"] is None and out["S2"]["email"] == "a@x.com"


def test_13_null_class_counts_in_total_only(spark):
    rows = [session("S1", minutes=60.0, app="APP099"), session("S2", minutes=30.0)]
    r = daily_user_metrics(enrich(spark, rows)).collect()[0]
    assert r["total_hours"] == 1.5
    assert (r["productive_hours"], r["neutral_hours"], r["unproductive_hours"]) == (0.5, 0.0, 0.0)
    assert r["productivity_pct"] == 33.33


def test_14_lone_user_in_account_day(spark):
    r = add_productivity_ranks(daily_rows(spark, [(D(2025, 8, 4), "U", "A", 2.0)])).collect()[0]
    assert (r["productivity_percentile"], r["productivity_rank"], r["performance_tier"]) == (
        0.0, 1, "Below Average")


def test_15_ties_share_rank_and_percentile(spark):
    d = D(2025, 8, 4)
    df = daily_rows(spark, [(d, "U1", "A", 5.0), (d, "U2", "A", 5.0), (d, "U3", "A", 1.0),
                            (d, "U4", "A", 9.0)])
    out = {r["user_id"]: r for r in add_productivity_ranks(df).collect()}
    assert (out["U4"]["productivity_rank"], out["U1"]["productivity_rank"],
            out["U2"]["productivity_rank"], out["U3"]["productivity_rank"]) == (1, 2, 2, 4)
    assert out["U1"]["productivity_percentile"] == out["U2"]["productivity_percentile"] == 0.333
    assert out["U4"]["performance_tier"] == "Top Performer"
    assert out["U1"]["performance_tier"] == "Average"
    assert out["U3"]["performance_tier"] == "Below Average"


def test_16_zero_hours_account_day_share_is_null(spark):
    enriched = spark.createDataFrame(
        [(D(2025, 8, 4), "ACC001", "T", "APP001", "VS", "Dev", "productive", "U", 0.0, 0.2, 1)],
        "date date, account_id string, company_name string, app_id string, app_name string, "
        "app_category string, productivity_classification string, user_id string, "
        "duration_hours double, duration_minutes double, is_valid_session int")
    r = app_productivity(enriched, "2025-08-10", 90).collect()[0]
    assert r["pct_of_total_time"] is None and r["total_hours"] == 0.0


def test_17_cohort_weeks_gap_and_cut(spark):
    start = D(2025, 8, 4)  # a Monday
    df = daily_rows(spark, [(start + dt.timedelta(weeks=w), "U", "A", 1.0) for w in (0, 1, 3, 13)])
    out = {r["weeks_since_cohort"]: r for r in retention_cohorts(df).collect()}
    assert sorted(out) == [0, 1, 3]
    assert out[0]["retention_pct"] == 100.0 and out[0]["retention_drop_pct"] is None
    assert out[3]["retention_drop_pct"] == 0.0  # against week 1, not week 2


def test_18_null_last_name_gives_null_full_name(spark):
    rows = [session("S1", user="USR0002")]
    out = user_activity_metrics(daily_user_metrics(enrich(spark, rows)), "2025-08-10", 90).collect()
    assert out[0]["full_name"] is None


def test_19_zero_hours_at_lag_gives_null_change(spark):
    days = [D(2025, 8, 1) + dt.timedelta(days=i) for i in range(8)]
    df = daily_rows(spark, [(d, "U", "A", 0.0 if i == 0 else 2.0) for i, d in enumerate(days)])
    out = {r["date"]: r for r in add_trends(df).collect()}
    assert out[days[7]]["total_hours_last_week"] == 0.0
    assert out[days[7]]["wow_change_pct"] is None


def test_20_duplicates_count_twice_until_deduped(spark):
    rows = [session("S1"), session("S1"), session("S2")]
    f = frames(spark, rows)
    r = daily_user_metrics(enrich(spark, rows)).collect()[0]
    assert r["total_sessions"] == 3
    assert [(x["session_id"], x["copies"]) for x in duplicate_sessions(f["sessions"]).collect()] == [("S1", 2)]
    deduped = dedupe_sessions(f["sessions"])
    assert deduped.count() == 2 and deduped.columns == f["sessions"].columns


def test_21_user_without_sessions(spark):
    rows = [session("S1", user="USR0001"), session("S2", user="USR0003", account="ACC002")]
    f = frames(spark, rows)
    d = daily_user_metrics(enrich(spark, rows))
    assert {r["user_id"] for r in d.collect()} == {"USR0001", "USR0003"}
    dist = {r["engagement_tier"]: r for r in engagement_distribution(d, f["users"], "2025-08-05").collect()}
    assert dist["Inactive"]["users"] == 2 and dist["Low Activity"]["users"] == 2
    assert dist["Inactive"]["pct_users"] == 50.0


def test_unused_schemas_are_valid(spark):
    assert spark.createDataFrame([], ACCOUNT_SCHEMA).count() == 0
    assert spark.createDataFrame([], APP_SCHEMA).count() == 0


def test_day_with_hours_but_no_activity_values(spark):
    rows = [session("S1", minutes=60.0, activity=None)]
    r = daily_user_metrics(enrich(spark, rows)).collect()[0]
    assert r["total_hours"] == 1.0 and r["productivity_pct"] == 100.0
    assert r["idle_ratio_pct"] is None and r["avg_activity_pct"] is None
    assert r["is_high_idle_day"] == 0


def test_end_timestamp_ignores_session_time_zone(spark):
    from workpulse.functions.dates import end_timestamp
    df = spark.createDataFrame([("2024-03-10 01:59:59.5", 1.0)], "ts string, m double").select(
        F.to_timestamp_ntz("ts").alias("ts"), "m")
    saved = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")  # DST gap 02:00-03:00
        out = df.select(end_timestamp("ts", "m").alias("e")).collect()[0]["e"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", saved)
    assert out == TS(2024, 3, 10, 2, 0, 59)
