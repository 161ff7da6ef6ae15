"""Invariants on the given test tables, and the value-histogram ranks against Spark's own
RANK/PERCENT_RANK window functions (brute force)."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from workpulse.operators.apps import app_productivity
from workpulse.operators.cohorts import retention_cohorts
from workpulse.operators.engagement import add_active_days_l7d
from workpulse.operators.ranks import add_productivity_ranks
from workpulse.operators.user_activity import user_activity_metrics
from workpulse.plans.catalog import AS_OF, daily, enriched
from workpulse.sources import testdata

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def small_daily(spark):
    return daily(spark, SMALL).cache()


# FIXTURES.md section 2: sessions, users, with project, too short, too long, late, valid,
# activity exactly 70.00, weekend
FIXTURE_COUNTS = {
    "0.001": (1_000, 15, 702, 10, 0, 11, 979, 0, 267),
    "0.01": (10_000, 150, 6_987, 178, 1, 104, 9_717, 1, 2_632),
    "0.1": (100_000, 1_500, 70_064, 1_904, 5, 1_031, 97_082, 10, 26_576),
}


@pytest.mark.parametrize("sf", sorted(FIXTURE_COUNTS))
def test_fixture_counts(spark, sf):
    e = enriched(spark, f"/root/testdata/sf{sf}")
    r = e.agg(
        F.count(F.lit(1)), F.countDistinct("user_id"), F.count("project_id"),
        F.sum("is_too_short"), F.sum("is_too_long"), F.sum("is_late_arrival"),
        F.sum("is_valid_session"),
        F.sum(F.when(F.col("activity_percentage") == 70.0, 1).otherwise(0)),
        F.sum("is_weekend"),
    ).collect()[0]
    assert tuple(r) == FIXTURE_COUNTS[sf]


def test_enrich_keeps_row_count(spark):
    assert enriched(spark, SMALL).count() == testdata.read(spark, SMALL, "events").count()


def test_class_hours_add_up(small_daily):
    bad = small_daily.filter(
        F.round(F.col("productive_hours") + F.col("neutral_hours") + F.col("unproductive_hours")
                - F.col("total_hours"), 6) != 0)
    assert bad.count() == 0


def test_l7d_bounds(small_daily):
    r = add_active_days_l7d(small_daily).agg(F.min("active_days_l7d"), F.max("active_days_l7d")).collect()[0]
    assert 0 <= r[0] and r[1] <= 7


def test_week0_retention_is_100(small_daily):
    rows = retention_cohorts(small_daily).filter("weeks_since_cohort = 0").collect()
    assert rows and all(r["retention_pct"] == 100.0 for r in rows)


def test_time_shares_sum_to_100(spark):
    apps = app_productivity(enriched(spark, SMALL), AS_OF, 90)
    sums = apps.groupBy("account_id", "date").agg(F.sum("pct_of_total_time").alias("s"), F.count("*").alias("n"))
    assert sums.filter(F.abs(F.col("s") - 100) > F.col("n") * 0.005 + 1e-9).count() == 0


def test_histogram_ranks_match_window_functions(small_daily):
    ours = add_productivity_ranks(small_daily)
    w = Window.partitionBy("account_id", "date")
    brute = small_daily.select(
        "date", "user_id", "account_id",
        F.round(F.percent_rank().over(w.orderBy("productive_hours")), 3).alias("pp"),
        F.rank().over(w.orderBy(F.desc("productive_hours"))).cast("bigint").alias("pr"),
        F.percent_rank().over(w.orderBy("productive_hours")).alias("raw"),
    ).withColumn("tier", F.when(F.col("raw") >= 0.9, "Top Performer").when(F.col("raw") >= 0.7, "Above Average")
                 .when(F.col("raw") >= 0.3, "Average").otherwise("Below Average"))
    a = {(r[0], r[1], r[2]): (r[3], r[4], r[5]) for r in ours.select(
        "date", "user_id", "account_id", "productivity_percentile", "productivity_rank",
        "performance_tier").collect()}
    b = {(r[0], r[1], r[2]): (r[3], r[4], r[5]) for r in brute.select(
        "date", "user_id", "account_id", "pp", "pr", "tier").collect()}
    assert a == b


def test_result_independent_of_partitioning(spark, small_daily):
    base = user_activity_metrics(small_daily, AS_OF, 90)
    shuffled = user_activity_metrics(small_daily.repartition(7, "date"), AS_OF, 90)
    assert sorted(map(tuple, base.collect())) == sorted(map(tuple, shuffled.collect()))
