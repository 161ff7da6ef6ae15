"""Daily rollup: one row per (date, user, account) with its user/account attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from workpulse.functions.flags import flag
from workpulse.functions.rounding import ratio_above, round_units, to_double, units

DAILY_KEYS = [
    "date", "user_id", "email", "first_name", "last_name", "role", "department",
    "account_id", "company_name", "industry", "subscription_tier",
]

# Idle share of the day's valid hours above which the day is high-idle.
HIGH_IDLE_DAY = 0.30


def _valid_sum(value: Column, extra: Column | None = None) -> Column:
    cond = F.col("is_valid_session") == 1
    if extra is not None:
        cond = cond & extra
    return F.sum(F.when(cond, value).otherwise(0))


def daily_user_metrics(enriched: DataFrame) -> DataFrame:
    """Aggregate enriched sessions to user-days.

    Counts cover every session; hours, keystrokes, clicks and the activity average cover valid
    sessions only. Hours are sums of the already-rounded session hours (kept as integer
    hundredths, so the sums are exact); the average and the ratios are rounded half up.
    A day with no valid session has total 0, ratios 0, NULL average and both day flags 0.

    The grouping is a hash aggregate with map-side partial aggregation, so one very active user
    or account does not concentrate raw sessions in one task: only partial sums are shuffled. The two
    distinct counts are sizes of sets in the same pass (bounded by the applications and projects of
    one user-day); two COUNT DISTINCT would send every session three times through an Expand.
    """
    valid = F.col("is_valid_session") == 1
    klass = F.col("productivity_classification")
    h = units("duration_hours")
    act = units("activity_percentage")
    agg = enriched.groupBy(*DAILY_KEYS).agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.sum("is_valid_session").cast("bigint").alias("valid_sessions"),
        F.size(F.collect_set("app_id")).cast("bigint").alias("unique_apps_used"),
        F.size(F.collect_set("project_id")).cast("bigint").alias("unique_projects"),
        _valid_sum(h).alias("_total"),
        _valid_sum(h, klass == "productive").alias("_productive"),
        _valid_sum(h, klass == "neutral").alias("_neutral"),
        _valid_sum(h, klass == "unproductive").alias("_unproductive"),
        _valid_sum(units("active_hours")).alias("_active"),
        _valid_sum(units("idle_hours")).alias("_idle"),
        _valid_sum(F.col("keyboard_strokes")).cast("bigint").alias("total_keystrokes"),
        _valid_sum(F.col("mouse_clicks")).cast("bigint").alias("total_clicks"),
        F.sum(F.when(valid, act)).alias("_act_sum"),
        F.count(F.when(valid, act)).alias("_act_n"),
    )
    total = F.col("_total")
    # a share of the day's hours; 0 for a day without hours (NULL stays NULL otherwise)
    pct = lambda part: F.when(total > 0, to_double(round_units(F.col(part) * 10_000, total))).otherwise(0.0)
    return agg.select(
        *DAILY_KEYS,
        "total_sessions", "valid_sessions", "unique_apps_used", "unique_projects",
        to_double(total).alias("total_hours"),
        to_double("_productive").alias("productive_hours"),
        to_double("_neutral").alias("neutral_hours"),
        to_double("_unproductive").alias("unproductive_hours"),
        to_double("_active").alias("active_hours"),
        to_double("_idle").alias("idle_hours"),
        "total_keystrokes", "total_clicks",
        to_double(round_units("_act_sum", "_act_n")).alias("avg_activity_pct"),
        pct("_idle").alias("idle_ratio_pct"),
        pct("_productive").alias("productivity_pct"),
        flag(total > 0).alias("is_active_day"),
        flag((total > 0) & ratio_above("_idle", total, HIGH_IDLE_DAY)).alias("is_high_idle_day"),
    )
