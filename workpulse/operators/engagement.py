"""Trailing seven-calendar-day activity (L7D) and engagement tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from workpulse.functions.dates import day_number
from workpulse.functions.flags import flag, tier

# Length of the trailing activity window in calendar days.
L7D_DAYS = 7

# Engagement tiers by active days in the last seven (first match wins).
ENGAGEMENT_BANDS = [(5, "Highly Active"), (3, "Moderately Active"), (1, "Low Activity")]
ENGAGEMENT_DEFAULT = "Inactive"


def add_active_days_l7d(daily: DataFrame, days: int = L7D_DAYS) -> DataFrame:
    """Add ``active_days_l7d``: distinct dates in ``[date-(days-1), date]`` on which the *user*
    (any account) has an active day.

    Calendar-based, unlike the row-based trends: the first row of each (user, date), taken with
    the day's active rows first, carries the day's activity, and a RANGE frame over the day number
    sums them. A NULL user or date matches nothing, so it gets 0. Every window here is partitioned
    by ``user_id`` alone, so they share one exchange with the trend windows that follow.
    """
    by_user = Window.partitionBy("user_id")
    in_date_order = by_user.orderBy(F.col("date"), F.desc("is_active_day"))
    trailing = by_user.orderBy(day_number("date")).rangeBetween(-(days - 1), Window.currentRow)
    first_of_day = ~F.lag("date").over(in_date_order).eqNullSafe(F.col("date"))
    unmatched = F.col("user_id").isNull() | F.col("date").isNull()
    l7d = F.when(unmatched, F.lit(0).cast("bigint")).otherwise(F.sum("_day_active").over(trailing))
    return (daily.withColumn("_day_active", flag(first_of_day & (F.col("is_active_day") == 1)))
            .withColumn("active_days_l7d", l7d)
            .drop("_day_active"))


def engagement_tier(active_days: Column) -> Column:
    return tier(active_days, ENGAGEMENT_BANDS, ENGAGEMENT_DEFAULT)


def add_engagement(daily_with_l7d: DataFrame) -> DataFrame:
    """Add ``engagement_tier`` and ``is_active_l7d`` from ``active_days_l7d``."""
    l7d = F.col("active_days_l7d")
    return daily_with_l7d.withColumns({"engagement_tier": engagement_tier(l7d),
                                       "is_active_l7d": flag(l7d > 0)})
