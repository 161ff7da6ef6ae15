"""Small hand-made model tables for golden tests (string ids, as in the reference's data)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

D = dt.date
TS = dt.datetime

SESSION_SCHEMA = T.StructType([
    T.StructField("session_id", T.StringType()), T.StructField("user_id", T.StringType()),
    T.StructField("account_id", T.StringType()), T.StructField("app_id", T.StringType()),
    T.StructField("project_id", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("start_timestamp", T.TimestampType()),
    T.StructField("duration_minutes", T.DoubleType()),
    T.StructField("keyboard_strokes", T.IntegerType()), T.StructField("mouse_clicks", T.IntegerType()),
    T.StructField("activity_percentage", T.DoubleType()),
])
USER_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType()), T.StructField("account_id", T.StringType()),
    T.StructField("email", T.StringType()), T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()), T.StructField("role", T.StringType()),
    T.StructField("department", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("weekly_capacity_hours", T.IntegerType()),
])
ACCOUNT_SCHEMA = T.StructType([
    T.StructField("account_id", T.StringType()), T.StructField("company_name", T.StringType()),
    T.StructField("industry", T.StringType()), T.StructField("subscription_tier", T.StringType()),
    T.StructField("company_size", T.StringType()),
])
APP_SCHEMA = T.StructType([
    T.StructField("app_id", T.StringType()), T.StructField("app_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("productivity_classification", T.StringType()),
])
PROJECT_SCHEMA = T.StructType([
    T.StructField("project_id", T.StringType()), T.StructField("project_name", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("budgeted_hours", T.IntegerType()),
])
DAILY_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()), T.StructField("user_id", T.StringType()),
    T.StructField("account_id", T.StringType()), T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()), T.StructField("total_hours", T.DoubleType()),
    T.StructField("productive_hours", T.DoubleType()), T.StructField("is_active_day", T.IntegerType()),
])

USERS = [
    ("USR0001", "ACC001", "a@x.com", "Ann", "Lee", "Developer", "Engineering", "active", 40),
    ("USR0002", "ACC001", "b@x.com", "Bob", None, "Designer", "Product", "active", 40),
    ("USR0003", "ACC002", "c@x.com", "Cid", "Ray", "QA Engineer", "Engineering", "active", 40),
    ("USR0004", "ACC002", "d@x.com", "Dee", "Fox", "Developer", "Operations", "active", 40),
]
ACCOUNTS = [
    ("ACC001", "Northwind Mills", "Technology", "pro", "Small"),
    ("ACC002", "Blue Heron Works", "Consulting", "enterprise", "Medium"),
]
APPS = [
    ("APP001", "Code Bench", "Development", "productive"),
    ("APP012", "Chatter Box", "Communication", "neutral"),
    ("APP026", "Clip Stream", "Entertainment", "unproductive"),
    ("APP099", "Unknown Tool", "Other", None),
]
PROJECTS = [("PRJ001", "Harbour Survey", "active", 100), ("PRJ002", "Bridge Audit", "on_hold", 50)]


def session(sid, user="USR0001", day=D(2025, 8, 4), minutes=30.0, activity=80.0, app="APP001",
            project="PRJ001", account="ACC001", start=None, keys=100, clicks=50):
    start = start or TS(day.year, day.month, day.day, 9, 0)
    return (sid, user, account, app, project, day, start, minutes, keys, clicks, activity)


def frames(spark, sessions, users=USERS):
    return {
        "sessions": spark.createDataFrame(sessions, SESSION_SCHEMA),
        "users": spark.createDataFrame(users, USER_SCHEMA),
        "accounts": spark.createDataFrame(ACCOUNTS, ACCOUNT_SCHEMA),
        "apps": spark.createDataFrame(APPS, APP_SCHEMA),
        "projects": spark.createDataFrame(PROJECTS, PROJECT_SCHEMA),
    }


def daily_rows(spark, rows):
    """rows: (date, user_id, account_id, total_hours[, productive_hours[, is_active_day]])."""
    full = []
    for r in rows:
        date, user, account, total = r[:4]
        productive = r[4] if len(r) > 4 else total
        active = r[5] if len(r) > 5 else int(total > 0)
        full.append((date, user, account, "F", "L", total, productive, active))
    return spark.createDataFrame(full, DAILY_SCHEMA)
