"""Explicit schemas of the six raw tables (no type inference at scale).

``version`` of an application is text ("2.10" is not 2.1), dates are dates, the fractional
measures are doubles, ids are strings.
"""

from pyspark.sql import types as T

S, D, I, R, B, TS = (T.StringType(), T.DateType(), T.IntegerType(), T.DoubleType(),
                     T.BooleanType(), T.TimestampType())


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


ACCOUNTS = _schema(
    ("account_id", S), ("company_name", S), ("industry", S), ("company_size", S),
    ("account_status", S), ("subscription_tier", S), ("account_created_date", D),
    ("primary_contact", S), ("timezone", S),
)
USERS = _schema(
    ("user_id", S), ("account_id", S), ("email", S), ("first_name", S), ("last_name", S),
    ("role", S), ("department", S), ("manager_id", S), ("hire_date", D), ("status", S),
    ("timezone", S), ("weekly_capacity_hours", I),
)
APPLICATIONS = _schema(
    ("app_id", S), ("app_name", S), ("category", S), ("productivity_classification", S),
    ("is_web_based", B), ("version", S),
)
PROJECTS = _schema(
    ("project_id", S), ("account_id", S), ("project_name", S), ("status", S),
    ("start_date", D), ("end_date", D), ("budgeted_hours", I), ("priority", S),
)
TASKS = _schema(
    ("task_id", S), ("project_id", S), ("task_name", S), ("task_status", S),
    ("estimated_hours", I), ("created_date", D),
)
SESSIONS = _schema(
    ("session_id", S), ("user_id", S), ("account_id", S), ("app_id", S), ("project_id", S),
    ("task_id", S), ("date", D), ("start_timestamp", TS), ("duration_minutes", R),
    ("keyboard_strokes", I), ("mouse_clicks", I), ("activity_percentage", R),
    ("is_manual_entry", B), ("screenshot_count", I),
)

RAW_SCHEMAS: dict[str, T.StructType] = {
    "raw_dim_accounts": ACCOUNTS,
    "raw_dim_users": USERS,
    "raw_dim_applications": APPLICATIONS,
    "raw_dim_projects": PROJECTS,
    "raw_dim_tasks": TASKS,
    "raw_fact_activity_sessions": SESSIONS,
}
