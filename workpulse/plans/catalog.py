"""Registered queries: each takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the whole
test tables, built with the library operators on the adapter's model tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from workpulse.functions.apps import with_web_flag
from workpulse.operators.allocation import project_allocation
from workpulse.operators.apps import app_productivity
from workpulse.operators.cohorts import cohort_sizes, retention_cohorts, user_cohorts, weekly_activity
from workpulse.operators.daily import daily_user_metrics
from workpulse.operators.distinct import active_users_by_day, productive_hours_by_period, user_bitmaps
from workpulse.operators.engagement import add_active_days_l7d, add_engagement
from workpulse.operators.enrich import enrich_sessions, session_flags, session_measures
from workpulse.operators.metrics import (
    account_churn_risk,
    active_users_l7d,
    avg_productive_hours,
    engagement_distribution,
    utilization_rate,
    weekly_retention_rate,
)
from workpulse.operators.quality import (
    dedupe_sessions,
    duplicate_sessions,
    layer_summary,
    session_quality,
    staging_summary,
)
from workpulse.operators.ranks import add_productivity_ranks
from workpulse.operators.trends import add_trends
from workpulse.operators.user_activity import user_activity_metrics
from workpulse.plans.layers import build_layers, land_raw
from workpulse.session import shared_folder
from workpulse.sources import testdata
from workpulse.sources.csv import RAW_FILES, table_inventory
from workpulse.sources.schemas import RAW_SCHEMAS
from workpulse.sources.sinks import refresh_table, write_csv
from workpulse.sources.versions import read_in_order, read_published, refresh

AS_OF = "2024-01-30"
LOOKBACK_DAYS = 90
# a cutoff inside the event range: rows before it go, and the 7-day windows look back across it
SHORT_LOOKBACK_DAYS = 14
# Reporting period of the utilization query (a parameter of ``utilization_rate``): the range of the
# given events, where late arrivals of the first day are dated 2023-12-31.
PERIOD = ("2023-12-31", "2024-01-30")

# region (5 rows) and the application catalog (5 rows) have a fixed size here.
BOUNDED_DIMS = ("accounts", "apps")

Query = Callable[[SparkSession, str], DataFrame]


def enriched(spark: SparkSession, sf_dir: str, odd: bool = False) -> DataFrame:
    """All 38 columns; account and user attributes come with the sessions, from one customer scan."""
    base = testdata.odd_sessions if odd else testdata.sessions
    return enrich_sessions(
        base(spark, sf_dir, attributes=True), None, testdata.accounts(spark, sf_dir), testdata.apps(spark),
        testdata.projects(spark, sf_dir), broadcast=BOUNDED_DIMS)


def daily(spark: SparkSession, sf_dir: str, odd: bool = False) -> DataFrame:
    """The user-days read no project attribute, so that dimension is not joined."""
    base = testdata.odd_sessions if odd else testdata.sessions
    return daily_user_metrics(enrich_sessions(
        base(spark, sf_dir, attributes=True), None, testdata.accounts(spark, sf_dir), testdata.apps(spark),
        broadcast=BOUNDED_DIMS))


# The session-level operators need no dimension: they run on the events alone.
def _session_flags(spark, sf_dir):
    return session_flags(testdata.bare_sessions(spark, sf_dir)).select(
        "session_id", "date", "is_late_arrival", "is_too_short", "is_too_long",
        "is_valid_session", "is_high_idle", "is_weekend")


def _session_end_time(spark, sf_dir):
    return session_measures(testdata.bare_sessions(spark, sf_dir)).select(
        "session_id", "start_timestamp", "duration_minutes", "end_timestamp")


def _session_measures(spark, sf_dir):
    return session_measures(testdata.bare_sessions(spark, sf_dir)).select(
        "session_id", "duration_hours", "active_hours", "idle_hours", "idle_ratio_pct")


def _session_quality(spark, sf_dir):
    return session_quality(session_flags(testdata.bare_sessions(spark, sf_dir)))


def _pick(builder, *cols):
    key = ("date", "user_id", "account_id")
    return lambda spark, sf_dir: builder(daily(spark, sf_dir)).select(*key, *cols)


def _ranks(d):
    return add_productivity_ranks(d.select("date", "user_id", "account_id", "productive_hours"))


def _l7d(d):
    return add_engagement(add_active_days_l7d(d))


def _user_activity(lookback_days):
    return lambda spark, sf_dir: user_activity_metrics(daily(spark, sf_dir), AS_OF, lookback_days)


def _apps(spark, sf_dir, lookback_days=LOOKBACK_DAYS):
    e = enrich_sessions(
        testdata.sessions(spark, sf_dir), None, testdata.accounts(spark, sf_dir), testdata.apps(spark),
        broadcast=BOUNDED_DIMS)
    return app_productivity(e, AS_OF, lookback_days)


def _apps_pick(*cols):
    key = ("date", "account_id", "app_id")
    return lambda spark, sf_dir: _apps(spark, sf_dir).select(*key, *cols)


def _allocation(spark, sf_dir):
    return project_allocation(enrich_sessions(
        testdata.sessions(spark, sf_dir), projects=testdata.projects(spark, sf_dir)))


def _on_daily(op):
    return lambda spark, sf_dir: op(daily(spark, sf_dir))


def _retention_orders(spark, sf_dir):
    return retention_cohorts(testdata.order_activity(spark, sf_dir))


def _engagement_distribution(spark, sf_dir):
    return engagement_distribution(daily(spark, sf_dir), testdata.users(spark, sf_dir), AS_OF)


def _utilization(spark, sf_dir, period=PERIOD):
    return utilization_rate(daily(spark, sf_dir), testdata.users(spark, sf_dir), *period)


def _analytics_summary(spark, sf_dir):
    d = daily(spark, sf_dir)
    return layer_summary({
        "analytics_user_activity_metrics": (user_activity_metrics(d, AS_OF, LOOKBACK_DAYS), None),
        "analytics_app_productivity": (_apps(spark, sf_dir), None),
        "analytics_retention_cohorts": (retention_cohorts(d), None),
    })


def _raw_inventory(spark, sf_dir):
    # an account is added to a session by a join on the customers' key: counting needs the events only
    tables = testdata.model(spark, sf_dir)
    tables["sessions"] = testdata.bare_sessions(spark, sf_dir)
    return table_inventory(tables)


def _web_apps(spark, sf_dir):
    """The web flag over a name column of the given tables that has both kinds."""
    names = testdata.projects(spark, sf_dir).select(
        F.col("project_id").alias("app_id"),
        F.when(F.col("project_id") % 5 == 0, F.concat(F.lit("Google "), "project_name"))
        .when(F.col("project_id") % 5 == 1, F.lit("Figma"))
        .when(F.col("project_id") % 5 == 2, F.lit(None).cast("string"))
        .otherwise(F.col("project_name")).alias("app_name"))
    return with_web_flag(names)


def _new_folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _csv_round_trip(spark, sf_dir):
    """Load and commit: the six raw tables as CSV, loaded by the names in their headers, committed, read back, counted.

    Every second file has its columns in the reverse order, and each has one that isn't declared.
    """
    folder = _new_folder(spark, "csv-round-trip")
    tables = {
        "raw_fact_activity_sessions": testdata.sessions(spark, sf_dir), "raw_dim_users": testdata.users(spark, sf_dir),
        "raw_dim_accounts": testdata.accounts(spark, sf_dir), "raw_dim_projects": testdata.projects(spark, sf_dir),
        "raw_dim_applications": testdata.used_apps(spark, sf_dir), "raw_dim_tasks": testdata.tasks(spark, sf_dir),
    }
    for number, (name, df) in enumerate(tables.items()):
        kept = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
                else F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_SCHEMAS[name].fields]
        kept.insert(1, F.lit("not declared").alias("remark"))
        write_csv(df.select(*(kept[::-1] if number % 2 else kept)), f"{folder}/raw/{RAW_FILES[name]}")
    published, _, counts = land_raw(spark, f"{folder}/raw", f"{folder}/published")
    sums = {
        "raw_fact_activity_sessions": F.sum(F.round(F.col("duration_minutes") * 100).cast("bigint")),
        "raw_dim_users": F.sum(F.length("email")), "raw_dim_accounts": F.sum(F.length("company_name")),
        "raw_dim_projects": F.sum("budgeted_hours"), "raw_dim_applications": F.sum(F.length("productivity_classification")),
        "raw_dim_tasks": F.sum("estimated_hours"),
    }
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count"), sums[name].cast("bigint").alias("checksum"))
        .select(F.lit(name).alias("table_name"), "row_count", "checksum")
        for name, df in sorted(published.items())
    ]
    return reduce(DataFrame.unionByName, parts).join(
        F.broadcast(counts.select("table_name", F.col("rows").alias("rows_written"), "malformed")), "table_name")


def _rebuild_counts(spark, sf_dir):
    """The full rebuild; its layer counts were observed while the tables were written and come from their commits."""
    return build_layers(spark, testdata.model(spark, sf_dir), _new_folder(spark, "rebuild"), AS_OF, LOOKBACK_DAYS,
                        broadcast_dims=BOUNDED_DIMS)


def _retention_published(spark, sf_dir):
    """The retention table as its files follow each other: ``position`` must be its place in the published order."""
    path = _new_folder(spark, "retention")
    refresh_table(retention_cohorts(testdata.order_activity(spark, sf_dir)), path, "analytics_retention_cohorts")
    return read_in_order(spark, path).select("position", "cohort_week", "account_id", "weeks_since_cohort", "retained_users")


def _stored_bitmaps(spark, sf_dir):
    """The users' bitmaps of every day, made once and committed as a table."""
    path = _new_folder(spark, "bitmaps")
    refresh(user_bitmaps(daily(spark, sf_dir)), path)
    return read_published(spark, path)


def _productive_hours_by_period(spark, sf_dir):
    stored = _stored_bitmaps(spark, sf_dir)
    parts = [productive_hours_by_period(stored, p).withColumn("period", F.lit(p)) for p in ("week", "month")]
    return reduce(DataFrame.unionByName, parts)


def _published_lookups(spark, sf_dir):
    """One user, one account and one day looked up in the committed session table, each by its key alone."""
    path = _new_folder(spark, "lookups")
    refresh_table(enriched(spark, sf_dir), path, "staging_enriched_sessions", histogram_of=testdata.sessions(spark, sf_dir))
    table = read_published(spark, path)
    parts = []
    for key in ("user_id", "account_id", "date"):
        low = table.agg(F.max(key).alias("_key"))
        found = table.join(F.broadcast(low), table[key] == F.col("_key"))
        parts.append(found.agg(
            F.lit(key).alias("looked_up"), F.count(F.lit(1)).alias("sessions"),
            F.sum(F.round(F.col("duration_minutes") * 100).cast("bigint")).alias("minute_hundredths"),
            F.countDistinct("user_id").alias("users")))
    return reduce(DataFrame.unionByName, parts)


QUERIES: dict[str, Query] = {
    "enriched_sessions": enriched,
    "session_flags": _session_flags,
    "session_end_time": _session_end_time,
    "session_measures": _session_measures,
    "daily_user_metrics": daily,
    "hours_lag7": _pick(add_trends, "total_hours", "total_hours_last_week"),
    "hours_wow_change": _pick(add_trends, "total_hours", "wow_change_pct"),
    "hours_rolling_7": _pick(add_trends, "total_hours", "total_hours_7d_avg"),
    "hours_rolling_30": _pick(add_trends, "total_hours", "total_hours_30d_avg"),
    "active_days_l7d": _pick(_l7d, "is_active_day", "active_days_l7d"),
    "engagement_tier": _pick(_l7d, "active_days_l7d", "engagement_tier"),
    "is_active_l7d": _pick(_l7d, "is_active_l7d"),
    "productivity_percentile": _pick(_ranks, "productive_hours", "productivity_percentile"),
    "productivity_rank": _pick(_ranks, "productive_hours", "productivity_rank"),
    "performance_tier": _pick(_ranks, "productive_hours", "performance_tier"),
    "user_activity_metrics": _user_activity(LOOKBACK_DAYS),
    "user_activity_short": _user_activity(SHORT_LOOKBACK_DAYS),
    "app_productivity": _apps,
    "app_productivity_short": lambda spark, sf_dir: _apps(spark, sf_dir, SHORT_LOOKBACK_DAYS),
    "app_time_share": _apps_pick("total_hours", "pct_of_total_time"),
    "app_rank_in_class": _apps_pick("productivity_classification", "total_hours",
                                    "rank_in_classification"),
    "app_overall_rank": _apps_pick("total_hours", "overall_rank"),
    "user_cohorts": _on_daily(user_cohorts),
    "weekly_activity": _on_daily(weekly_activity),
    "cohort_sizes": _on_daily(cohort_sizes),
    "retention_cohorts": _on_daily(retention_cohorts),
    "retention_orders": _retention_orders,
    "active_users_l7d": lambda spark, sf_dir: active_users_l7d(daily(spark, sf_dir), AS_OF),
    "engagement_distribution": _engagement_distribution,
    "weekly_retention_rate": lambda spark, sf_dir: weekly_retention_rate(
        retention_cohorts(daily(spark, sf_dir)), AS_OF),
    "retention_rate_orders": lambda spark, sf_dir: weekly_retention_rate(
        retention_cohorts(testdata.order_activity(spark, sf_dir)), AS_OF),
    "account_churn_risk": lambda spark, sf_dir: account_churn_risk(daily(spark, sf_dir), AS_OF),
    "avg_productive_hours": _on_daily(avg_productive_hours),
    "utilization_rate": _utilization,
    "project_allocation": _allocation,
    "layer_summary": lambda spark, sf_dir: staging_summary(daily(spark, sf_dir)),
    "analytics_summary": _analytics_summary,
    "session_quality": _session_quality,
    "enriched_odd_sessions": lambda spark, sf_dir: enriched(spark, sf_dir, odd=True),
    "daily_odd_sessions": lambda spark, sf_dir: daily(spark, sf_dir, odd=True),
    "web_apps": _web_apps,
    "csv_round_trip": _csv_round_trip,
    "rebuild_counts": _rebuild_counts,
    "retention_published": _retention_published,
    "published_lookups": _published_lookups,
    "active_users_by_day": lambda spark, sf_dir: active_users_by_day(_stored_bitmaps(spark, sf_dir)),
    "productive_hours_by_period": _productive_hours_by_period,
    "duplicate_sessions": lambda spark, sf_dir: duplicate_sessions(
        testdata.sessions_with_copies(spark, sf_dir, bare=True)),
    # the account is added to the rows that stay
    "dedupe_sessions": lambda spark, sf_dir: testdata.with_account(
        dedupe_sessions(testdata.sessions_with_copies(spark, sf_dir, bare=True)), spark, sf_dir),
    "raw_inventory": _raw_inventory,
}
FLAGSHIP = "user_activity_metrics"
