"""Session enrichment: the staging session table (one row per raw session)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.functions.dates import end_timestamp, is_weekend
from workpulse.functions.flags import flag
from workpulse.functions.rounding import round_units, to_double, units

# Thresholds of the quality flags (minutes, minutes, idle share).
MIN_MINUTES = 1
MAX_MINUTES = 480
HIGH_IDLE = 0.30

ENRICHED_COLUMNS = [
    "session_id", "user_id", "account_id", "app_id", "project_id", "date",
    "email", "first_name", "last_name", "role", "department", "user_status",
    "company_name", "industry", "subscription_tier", "company_size",
    "app_name", "app_category", "productivity_classification",
    "project_name", "project_status", "project_budget_hours",
    "start_timestamp", "end_timestamp", "duration_minutes", "duration_hours",
    "keyboard_strokes", "mouse_clicks", "activity_percentage",
    "active_hours", "idle_hours", "idle_ratio_pct",
    "is_late_arrival", "is_too_short", "is_too_long", "is_valid_session", "is_high_idle",
    "is_weekend",
]


def session_measures(sessions: DataFrame) -> DataFrame:
    """Add the computed session measures, exact to the hundredth.

    With ``d`` = duration in hundredths of a minute and ``a`` = activity in hundredths of a percent:
    duration_hours = d/6000, active_hours = d*a/6e7, idle_hours = d*(100-a%)/6e7, each rounded half
    away from zero to 2 places on integers, negative values too; idle_ratio_pct = 100 - activity (exact).
    """
    d = units("duration_minutes")
    a = units("activity_percentage")
    return sessions.withColumns({
        "end_timestamp": end_timestamp("start_timestamp", "duration_minutes"),
        "duration_hours": to_double(round_units(d, F.lit(60))),
        "active_hours": to_double(round_units(d * a, F.lit(600_000))),
        "idle_hours": to_double(round_units(d * (10_000 - a), F.lit(600_000))),
        "idle_ratio_pct": to_double(10_000 - a),
    })


def session_flags(sessions: DataFrame) -> DataFrame:
    """Add the six 0/1 quality flags. NULL inputs give 0 (a failed test is not a flag)."""
    start_day = F.to_date("start_timestamp")
    minutes = F.col("duration_minutes")
    # Idle share compared in double precision: 1 - 70.00/100 is 0.30000000000000004 > 0.30.
    idle_share = F.lit(1.0) - F.col("activity_percentage") / 100.0
    return sessions.withColumns({
        "is_late_arrival": flag(start_day > F.col("date")),
        "is_too_short": flag(minutes < MIN_MINUTES),
        "is_too_long": flag(minutes > MAX_MINUTES),
        "is_valid_session": flag((minutes >= MIN_MINUTES) & (minutes <= MAX_MINUTES)
                                 & (start_day <= F.col("date"))),
        "is_high_idle": flag(idle_share > HIGH_IDLE),
        "is_weekend": flag(is_weekend("date")),
    })


DIMENSIONS = {
    "users": ("user_id", {
        "email": "email", "first_name": "first_name", "last_name": "last_name", "role": "role",
        "department": "department", "status": "user_status"}),
    "accounts": ("account_id", {
        "company_name": "company_name", "industry": "industry",
        "subscription_tier": "subscription_tier", "company_size": "company_size"}),
    "apps": ("app_id", {
        "app_name": "app_name", "category": "app_category",
        "productivity_classification": "productivity_classification"}),
    "projects": ("project_id", {
        "project_name": "project_name", "status": "project_status",
        "budgeted_hours": "project_budget_hours"}),
}
# Second bucket column of sessions and users that were landed with heavy users spread.
BUCKET = "user_bucket"
# Tasks over which the sessions without a key are spread in a shuffle join.
SPREAD = 1021


def _join_dimension(
    fact: DataFrame, dim: DataFrame, key: str, renames: dict[str, str], broadcast: bool, spread: bool
) -> DataFrame:
    out = dim.select(F.col(key).alias("_key"), *[F.col(src).alias(dst) for src, dst in renames.items()],
                     *[F.col(c).alias("_key_bucket") for c in dim.columns if c == BUCKET])
    if BUCKET in dim.columns:
        # landed with its heavy keys spread over buckets: both tables are bucketed by these two columns
        same = (fact[BUCKET] == F.col("_key_bucket")) & (fact[key] == F.col("_key"))
        return fact.join(out, same, "left").drop("_key", "_key_bucket")
    if broadcast:
        out = F.broadcast(out)
        spread = False
    if not spread:
        return fact.join(out, fact[key] == F.col("_key"), "left").drop("_key")
    # rows without a key match nothing: a second key, never that of a dimension row, deals them out
    none = F.when(F.col(key).isNull(), F.pmod(F.xxhash64("session_id"), F.lit(SPREAD)).cast("int") + 1)
    fact = fact.withColumn("_none", none.otherwise(0))
    # not a literal: the optimizer would fold that into a filter, and the key would be gone
    out = out.withColumn("_spread", F.col("_key").isNull().cast("int"))
    matched = (fact[key] == F.col("_key")) & (F.col("_none") == F.col("_spread"))
    return fact.join(out, matched, "left").drop("_key", "_none", "_spread")


def enrich_sessions(
    sessions: DataFrame,
    users: DataFrame | None = None,
    accounts: DataFrame | None = None,
    apps: DataFrame | None = None,
    projects: DataFrame | None = None,
    broadcast: Iterable[str] = (),
    spread_missing: bool = True,
) -> DataFrame:
    """Join each session to its user, account, application and project, add measures and flags.

    All joins are LEFT joins: an unmatched or NULL key keeps the session with NULL attributes.
    The account is the session's own ``account_id``. Duplicated dimension keys fan out, as any
    relational join does. ``broadcast`` names the dimensions known to be small and bounded
    (e.g. ``{"accounts", "apps"}``); the others are left to Catalyst's size-checked choice
    between a broadcast and a shuffle join.

    A dimension that is not given is not joined: a query passes only those that it reads. Of its
    columns the result has those that the sessions already carry. (A LEFT join that may fan out is
    never removed by the optimizer, even if nothing reads its columns.)

    Sessions without a user or project would meet in one task of a shuffle join; they are dealt out
    by a second join key. ``spread_missing=False`` leaves that out, for tables that are bucketed by
    the plain key.
    """
    b = set(broadcast)
    out = sessions
    given = {"users": users, "accounts": accounts, "apps": apps, "projects": projects}
    for name, dim in given.items():
        key, renames = DIMENSIONS[name]
        if dim is not None:
            out = _join_dimension(out, dim, key, renames, name in b, spread_missing)
    if users is None and "status" in out.columns:
        out = out.withColumnRenamed("status", "user_status")
    out = session_flags(session_measures(out))
    return out.select(*[c for c in ENRICHED_COLUMNS if c in out.columns])
