"""Per-user trends over the user-day series.

"Last week" and the 7/30-day averages count *rows* (days with sessions), not calendar days:
LAG 7 is the 7th earlier row and a 7-row average may span more than a week. Rows of one user
are ordered by date, then account (a user with two accounts has two rows on a date).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workpulse.functions.rounding import round_units, to_double, units

# Rows back for last week, rows of the short and long averages.
LAG_ROWS = 7
SHORT_ROWS = 7
LONG_ROWS = 30


def user_series() -> Window:
    return Window.partitionBy("user_id").orderBy("date", "account_id")


def add_trends(daily: DataFrame, value: str = "total_hours") -> DataFrame:
    """Add ``total_hours_last_week``, ``wow_change_pct``, ``total_hours_7d_avg``,
    ``total_hours_30d_avg``.

    The change is NULL unless last week's value is positive. One window spec, partitioned by
    user: a user's partition holds one row per active day, bounded by the calendar, so a very
    active user does not grow it.
    """
    w = user_series()
    v = units(value)
    short = w.rowsBetween(-(SHORT_ROWS - 1), Window.currentRow)
    long = w.rowsBetween(-(LONG_ROWS - 1), Window.currentRow)
    lag = F.col("_lag")
    return (
        daily.withColumns({
            "_lag": F.lag(v, LAG_ROWS).over(w),
            "_s7": F.sum(v).over(short), "_n7": F.count(v).over(short),
            "_s30": F.sum(v).over(long), "_n30": F.count(v).over(long),
        })
        .withColumns({
            f"{value}_last_week": to_double(lag),
            "wow_change_pct": to_double(round_units((v - lag) * 10_000, lag)),
            f"{value}_7d_avg": to_double(round_units("_s7", "_n7")),
            f"{value}_30d_avg": to_double(round_units("_s30", "_n30")),
        })
        .drop("_lag", "_s7", "_n7", "_s30", "_n30")
    )
