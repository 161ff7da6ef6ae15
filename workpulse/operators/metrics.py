"""The headline metrics named by the reference without a formula.

Definitions (thresholds and periods are parameters; defaults below):

* active users L7D: distinct users with an active day in ``[as_of-6, as_of]``, per account and
  overall (a user of two accounts counts once overall).
* engagement distribution: every user of the user dimension gets the tier of its active days in
  ``[as_of-6, as_of]`` (a user without activity is Inactive); users and share per tier.
* weekly retention rate: retention cells pooled over cohorts and accounts; for week number k only
  cohorts whose week k has started by ``as_of`` count.
* account churn risk: of the users ever active in an account up to ``as_of``, the share with no
  active day in the account in ``[as_of-6, as_of]``; High from 50 %, Medium from 25 %, else Low.
* average productive hours per user: per account and week (or month), productive hours over
  users with a daily row in the period.
* utilization: per account, hours worked in ``[start, end]`` over capacity, where capacity is
  each user's weekly capacity / 5 per weekday (Mon-Fri) of the period.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workpulse.functions.dates import week_start
from workpulse.functions.flags import flag
from workpulse.functions.rounding import idiv, ratio_at_least, round_units, to_double, units
from workpulse.operators.engagement import L7D_DAYS, engagement_tier
from workpulse.operators.user_activity import as_of_date

# Churn-risk bands: share of ever-active users without activity in the last 7 days
# (first match wins).
CHURN_BANDS = [(0.50, "High"), (0.25, "Medium")]
CHURN_DEFAULT = "Low"


def _l7d_window(daily: DataFrame, as_of, days: int = L7D_DAYS) -> DataFrame:
    end = as_of_date(as_of)
    return daily.filter((F.col("is_active_day") == 1) & (F.col("date") <= end)
                        & (F.col("date") >= F.date_sub(end, days - 1)))


def active_users_l7d(daily: DataFrame, as_of=None) -> DataFrame:
    """(scope, account_id, active_users): scope 'account' per account, 'all' once overall."""
    return (
        _l7d_window(daily, as_of).rollup("account_id")
        .agg(F.count_distinct("user_id").alias("active_users"),
             F.grouping("account_id").alias("_g"))
        .select(F.when(F.col("_g") == 1, "all").otherwise("account").alias("scope"),
                "account_id", "active_users")
    )


def engagement_distribution(daily: DataFrame, users: DataFrame, as_of=None) -> DataFrame:
    """(engagement_tier, users, pct_users) over all users of the user dimension.

    The per-user count is a partially aggregated group-by; the final window runs over the
    (at most four) tier rows only.
    """
    days = (_l7d_window(daily, as_of).filter(F.col("user_id").isNotNull())
            .groupBy("user_id").agg(F.count_distinct("date").alias("_days")))
    everyone = users.filter(F.col("user_id").isNotNull()).select("user_id").distinct()
    tiers = (
        everyone.join(days, "user_id", "left")
        .groupBy(engagement_tier(F.coalesce(F.col("_days"), F.lit(0))).alias("engagement_tier"))
        .agg(F.count(F.lit(1)).alias("users"))
    )
    total = F.sum("users").over(Window.partitionBy())
    return tiers.withColumn("pct_users", to_double(round_units(F.col("users") * 10_000, total)))


def weekly_retention_rate(retention: DataFrame, as_of=None, max_weeks: int = 12) -> DataFrame:
    """(weeks_since_cohort, cohorts, cohort_users, retained_users, retention_rate_pct).

    One pass over the cells: a cohort's week-0 cell adds its size to the denominators of the week
    numbers it has reached (at most ``max_weeks + 1``), every cell its users to its own numerator.
    """
    end = as_of_date(as_of)
    week, size = F.col("weeks_since_cohort"), F.col("cohort_size")
    reached = F.least(F.lit(max_weeks), idiv(F.datediff(end, F.col("cohort_week")), 7)).cast("int")
    started = F.date_add(F.col("cohort_week"), week * 7) <= end
    part = lambda w, cohorts, users, kept: F.struct(
        w.cast("int").alias("week"), cohorts.alias("cohorts"), users.cast("bigint").alias("users"), kept.cast("bigint").alias("kept"))
    none = F.lit(0)
    denominators = F.when(
        (week == 0) & (reached >= 0),
        F.transform(F.sequence(none, reached), lambda w: part(w, F.lit(1), size, none)),
    )
    own = F.when(started & (week <= max_weeks), F.array(part(week, none, none, F.col("retained_users"))))
    nothing = F.filter(F.array(part(none, none, none, none)), lambda _: F.lit(False))
    return (
        retention.select(F.inline(F.concat(F.coalesce(denominators, nothing), F.coalesce(own, nothing))))
        .groupBy(F.col("week").alias("weeks_since_cohort"))
        .agg(F.sum("cohorts").cast("bigint").alias("cohorts"), F.sum("users").alias("cohort_users"),
             F.sum("kept").alias("retained_users"))
        .filter(F.col("cohorts") > 0)
        .withColumn("retention_rate_pct",
                    to_double(round_units(F.col("retained_users") * 10_000, "cohort_users")))
    )


def account_churn_risk(daily: DataFrame, as_of=None, days: int = L7D_DAYS) -> DataFrame:
    """(account_id, ever_active_users, inactive_l7d_users, churn_pct, churn_risk)."""
    end = as_of_date(as_of)
    last = (daily.filter((F.col("is_active_day") == 1) & (F.col("date") <= end)
                         & F.col("user_id").isNotNull())
            .groupBy("account_id", "user_id").agg(F.max("date").alias("_last")))
    per_account = last.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("ever_active_users"),
        F.sum(flag(F.col("_last") < F.date_sub(end, days - 1))).cast("bigint")
        .alias("inactive_l7d_users"),
    )
    inactive, ever = F.col("inactive_l7d_users"), F.col("ever_active_users")
    risk = None
    for threshold, label in CHURN_BANDS:
        cond = ratio_at_least(inactive, ever, threshold)
        risk = F.when(cond, label) if risk is None else risk.when(cond, label)
    return per_account.select(
        "account_id", "ever_active_users", "inactive_l7d_users",
        to_double(round_units(inactive * 10_000, ever)).alias("churn_pct"),
        risk.otherwise(CHURN_DEFAULT).alias("churn_risk"),
    )


def avg_productive_hours(daily: DataFrame, period: str = "week") -> DataFrame:
    """(account_id, period_start, users, productive_hours, avg_productive_hours)."""
    start = week_start("date") if period == "week" else F.trunc("date", period)
    return (
        daily.groupBy("account_id", start.alias("period_start"))
        .agg(F.count_distinct("user_id").alias("users"),
             F.sum(units("productive_hours")).alias("_p"))
        .select("account_id", "period_start", "users",
                to_double("_p").alias("productive_hours"),
                to_double(round_units("_p", "users")).alias("avg_productive_hours"))
    )


def weekdays_between(start: dt.date, end: dt.date) -> int:
    """Monday-Friday dates in ``[start, end]`` (parameter arithmetic, no data involved)."""
    if end < start:
        return 0
    full_weeks, rest = divmod((end - start).days + 1, 7)
    extra = sum(1 for i in range(rest) if (start + dt.timedelta(days=i)).weekday() < 5)
    return full_weeks * 5 + extra


def utilization_rate(daily: DataFrame, users: DataFrame, start: str, end: str) -> DataFrame:
    """(account_id, users, capacity_hours, used_hours, utilization_pct) for ``[start, end]``."""
    days = weekdays_between(dt.date.fromisoformat(start), dt.date.fromisoformat(end))
    capacity = (users.filter(F.col("account_id").isNotNull()).groupBy("account_id")
                .agg(F.count(F.lit(1)).alias("users"),
                     F.sum(F.col("weekly_capacity_hours").cast("bigint") * (days * 20)).alias("_cap")))
    used = (daily.filter(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
            .groupBy("account_id").agg(F.sum(units("total_hours")).alias("_used")))
    joined = capacity.join(used, "account_id", "left").withColumn(
        "_used", F.coalesce("_used", F.lit(0).cast("bigint")))
    return joined.select(
        "account_id", "users",
        to_double("_cap").alias("capacity_hours"),
        to_double("_used").alias("used_hours"),
        to_double(round_units(F.col("_used") * 10_000, "_cap")).alias("utilization_pct"),
    )
