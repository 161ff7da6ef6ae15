"""The published user-activity table: user-days with trends, ranks, L7D and tiers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.operators.engagement import L7D_DAYS, add_active_days_l7d, add_engagement
from workpulse.operators.ranks import add_productivity_ranks
from workpulse.operators.trends import add_trends

# Default lookback of the published daily-grain analytics tables.
LOOKBACK_DAYS = 90

USER_ACTIVITY_COLUMNS = [
    "date", "user_id", "email", "full_name", "role", "department", "account_id", "company_name",
    "industry", "subscription_tier", "total_sessions", "valid_sessions", "unique_apps_used",
    "total_hours", "productive_hours", "neutral_hours", "unproductive_hours", "active_hours",
    "idle_hours", "total_keystrokes", "total_clicks", "avg_activity_pct", "idle_ratio_pct",
    "productivity_pct", "is_active_day", "is_high_idle_day", "total_hours_last_week",
    "wow_change_pct", "total_hours_7d_avg", "total_hours_30d_avg", "productivity_percentile",
    "productivity_rank", "active_days_l7d", "engagement_tier", "performance_tier", "is_active_l7d",
]


def as_of_date(as_of: str | dt.date | None) -> F.Column:
    """The reporting date: a literal, or today's date in UTC, whatever the session's zone, when None."""
    now = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    return F.to_date(now) if as_of is None else F.lit(str(as_of)).cast("date")


def lookback_start(as_of: str | dt.date | None, lookback_days: int) -> F.Column:
    return F.date_sub(as_of_date(as_of), lookback_days)


def user_activity_metrics(
    daily: DataFrame, as_of: str | dt.date | None = None, lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """User-days on or after ``as_of - lookback_days`` with trend, rank and engagement columns.

    Order of work matters: L7D looks back into days before the cutoff, so it is computed first on
    the daily table (restricted to the six days before the cutoff onwards, which is all it can
    reach); then rows before the cutoff are dropped; then the trend windows run on the kept rows
    only, and the ranks compare the kept users of an account-day. Every window keyed by user is
    partitioned by ``user_id`` alone, so they share one exchange.

    The rank histogram counts the same user-days, before their windows. With a daily input computed in the
    same plan both branches share its last exchange, so that the sessions are read once.
    """
    cutoff = lookback_start(as_of, lookback_days)
    used = [c for c in daily.columns if c in (*USER_ACTIVITY_COLUMNS, "first_name", "last_name")]
    reach = daily.select(*used).filter(F.col("date") >= F.date_sub(cutoff, L7D_DAYS - 1))
    with_l7d = add_engagement(add_active_days_l7d(reach))
    kept = with_l7d.filter(F.col("date") >= cutoff)
    trended = add_trends(kept)
    ranked = add_productivity_ranks(trended, counted=reach)
    return ranked.withColumn(
        "full_name", F.concat(F.col("first_name"), F.lit(" "), F.col("last_name"))
    ).select(*USER_ACTIVITY_COLUMNS)
