"""Application productivity: account-day-application usage, share of time and rankings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workpulse.functions.rounding import round_units, to_double, units
from workpulse.operators.user_activity import LOOKBACK_DAYS, lookback_start

APP_KEYS = [
    "date", "account_id", "company_name", "app_id", "app_name", "app_category",
    "productivity_classification",
]


def app_productivity(
    enriched: DataFrame, as_of: str | dt.date | None = None, lookback_days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Valid sessions since ``as_of - lookback_days`` per (date, account, application):
    ``session_count``, ``unique_users``, ``total_hours`` (sum of rounded session hours),
    ``avg_session_minutes`` (1 place), ``pct_of_total_time`` (of the account-day's hours,
    2 places, NULL when the account-day has no hours), ``rank_in_classification`` and
    ``overall_rank`` (ROW_NUMBER by hours descending; ties broken by ``app_id``).

    The group-by aggregates partially before its shuffle. The windows then see one row per
    application used in an account-day, bounded by the application catalog, and both share one
    partitioning on (account_id, date).
    """
    v = enriched.filter(
        (F.col("is_valid_session") == 1) & (F.col("date") >= lookback_start(as_of, lookback_days))
    )
    agg = v.groupBy(*APP_KEYS).agg(
        F.count(F.lit(1)).alias("session_count"),
        F.count_distinct("user_id").alias("unique_users"),
        F.sum(units("duration_hours")).alias("_h"),
        F.sum(units("duration_minutes")).alias("_m"),
    )
    account_day = Window.partitionBy("account_id", "date")
    by_hours = [F.desc("_h"), F.asc("app_id")]
    return (
        agg.withColumns({
            "_ad": F.sum("_h").over(account_day),
            "overall_rank": F.row_number().over(account_day.orderBy(*by_hours)),
            "rank_in_classification": F.row_number().over(
                Window.partitionBy("account_id", "date", "productivity_classification")
                .orderBy(*by_hours)),
        })
        .select(
            *APP_KEYS, "session_count", "unique_users",
            to_double("_h").alias("total_hours"),
            to_double(round_units("_m", F.col("session_count") * 10), 1).alias("avg_session_minutes"),
            to_double(round_units(F.col("_h") * 10_000, "_ad")).alias("pct_of_total_time"),
            F.col("rank_in_classification").cast("bigint").alias("rank_in_classification"),
            F.col("overall_rank").cast("bigint").alias("overall_rank"),
        )
    )
