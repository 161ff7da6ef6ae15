"""Weekly retention cohorts.

A cohort is the (account, first active week) of a user in that account; a user active in two
accounts is a member of two cohorts. Weeks start on Monday. For each cohort and week number
0..12 the table gives how many members were active, as a share of the cohort, and the change
against the previous week number present (weeks nobody was active are absent, so the change
may span a gap).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workpulse.functions.dates import week_start, weeks_between
from workpulse.functions.rounding import round_units, to_double

# Week numbers kept after the cohort week.
MAX_WEEKS = 12


def weekly_activity(daily: DataFrame) -> DataFrame:
    """Distinct (user_id, account_id, activity_week) with an active day."""
    return (
        daily.filter(F.col("is_active_day") == 1)
        .select("user_id", "account_id", week_start("date").alias("activity_week"))
        .distinct()
    )


def user_cohorts(daily: DataFrame) -> DataFrame:
    """(user_id, account_id, cohort_week): the week of the first active day.

    Grouped on (user, account) with a partial MIN, so a user with a very long history
    contributes one partial row per map task.
    """
    return (
        daily.filter(F.col("is_active_day") == 1)
        .groupBy("user_id", "account_id")
        .agg(week_start(F.min("date")).alias("cohort_week"))
    )


def cohort_activity(daily: DataFrame) -> DataFrame:
    """(cohort_week, account_id, user_id, activity_week, weeks_since_cohort), one row per
    member-week. The cohort week is the minimum activity week of the member, taken over the
    member's own weeks (a window partitioned by user and account, one row per active week), so no
    join between cohorts and activity is needed."""
    member = Window.partitionBy("user_id", "account_id")
    # A NULL user or account never matches a cohort (SQL equality), so such rows are dropped.
    keyed = daily.filter(F.col("user_id").isNotNull() & F.col("account_id").isNotNull())
    return (
        weekly_activity(keyed)
        .withColumn("cohort_week", F.min("activity_week").over(member))
        .select("cohort_week", "account_id", "user_id", "activity_week",
                weeks_between("activity_week", "cohort_week").alias("weeks_since_cohort"))
    )


def cohort_sizes(daily: DataFrame) -> DataFrame:
    """(cohort_week, account_id, cohort_size): members active in week 0, i.e. all members."""
    return (
        cohort_activity(daily).filter(F.col("weeks_since_cohort") == 0)
        .groupBy("cohort_week", "account_id")
        .agg(F.count(F.lit(1)).alias("cohort_size"))
    )


def retention_cohorts(daily: DataFrame, max_weeks: int = MAX_WEEKS) -> DataFrame:
    """(cohort_week, account_id, weeks_since_cohort, retained_users, cohort_size, retention_pct,
    retention_drop_pct) for weeks 0..``max_weeks``.

    Member-weeks are unique, so a plain count per cell is the distinct member count and the
    count aggregates map-side. The cohort size is the week-0 cell of the same cohort, read with a
    window over the cohort's cells (at most ``max_weeks + 1`` rows), which replaces a join.
    Percentages are exact: ``retained*100/size`` and the change is taken on the unrounded values
    before rounding to 2 places.
    """
    cells = (
        cohort_activity(daily).filter(F.col("weeks_since_cohort") <= max_weeks)
        .groupBy("cohort_week", "account_id", "weeks_since_cohort")
        .agg(F.count(F.lit(1)).alias("retained_users"))
    )
    cohort = Window.partitionBy("cohort_week", "account_id")
    size = F.max(F.when(F.col("weeks_since_cohort") == 0, F.col("retained_users"))).over(cohort)
    prev = F.lag("retained_users").over(cohort.orderBy("weeks_since_cohort"))
    return (
        cells.withColumns({"cohort_size": size, "_prev": prev})
        .select(
            "cohort_week", "account_id", "weeks_since_cohort", "retained_users", "cohort_size",
            to_double(round_units(F.col("retained_users") * 10_000, "cohort_size"))
            .alias("retention_pct"),
            to_double(round_units((F.col("retained_users") - F.col("_prev")) * 10_000, "cohort_size"))
            .alias("retention_drop_pct"),
        )
    )
