"""Adapter: the model tables built from the given test Parquet tables.

The work-activity tables do not exist in the test data, so every registered query first maps the
given TPC-H-like tables onto them, with the same rules as the SQL oracle:

* sessions <- ``events``: one session per event; the account is the user's nation's region;
  ``project_id`` is ``props.k`` for 7 of 10 values of its last digit; one event in 97 is dated a
  day before it starts (a late arrival); activity is a fixed pseudo-random 0-100.00 from the id.
* users <- ``customer`` (+ ``nation`` for the account), accounts <- ``region`` (5 rows),
  projects <- ``part``, the application catalog is the 5 event types.
* tasks <- ``orders``, one for each (only for loading and publishing).
* long activity history (for cohorts) <- ``orders``: one active day per order date.
* the duplicate operators get the sessions plus an exact copy of every 200th one (0.5 %).
* ``odd_sessions`` has the same sessions with the values that a clean source would not send:
  negative durations, activity over 100, missing users, projects, applications and dates.

Only the columns used downstream are produced. ``customer`` is joined to the events directly, so
that the planner sees its true size, and only once: account and user attributes come together.
``nation`` and ``region`` have a fixed size in this schema (25 and 5 rows) and the application
catalog is 5 literal rows, so they are broadcast explicitly; ``customer`` and ``part`` grow with
the data and are left to Spark's size-checked join selection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from workpulse.operators.enrich import SPREAD

# Adapter rule (not a reference value): the application catalog over the event types
# (app_id, app_name, category, productivity_classification).
APP_CATALOG = [
    ("purchase", "Purchase", "Commerce", "productive"),
    ("signup", "Signup", "Onboarding", "productive"),
    ("view", "View", "Browsing", "neutral"),
    ("click", "Click", "Browsing", "neutral"),
    ("error", "Error", "Support", "unproductive"),
]

APP_SCHEMA = T.StructType([
    T.StructField("app_id", T.StringType()),
    T.StructField("app_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("productivity_classification", T.StringType()),
])

# Declared schemas of the given tables: no footer has to be read on the driver to plan a query
# (at scale a table is thousands of files).
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{str(sf_dir).rstrip('/')}/{name}.parquet"
    schema = TABLE_SCHEMAS.get(name)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def _nation_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return F.broadcast(read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))


def _user_columns() -> list:
    """The user attributes, from the columns of ``customer``."""
    return [
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.col("c_mktsegment").alias("role"),
        F.col("c_mktsegment").alias("department"),
        F.when(F.col("c_custkey").isNotNull(), "active").alias("status"),
    ]


def with_user(df: DataFrame, spark: SparkSession, sf_dir: str, attributes: bool = False) -> DataFrame:
    """``df`` with the account of its ``user_id`` and, if asked for, the user's attributes.

    The customers are joined at the size of their own table and the nations after them. Rows without
    a user can't match: a second key spreads them over the tasks of a shuffle join.
    """
    customer = read(spark, sf_dir, "customer").withColumn("_spread", F.col("c_custkey").isNull().cast("int"))
    keyed = df.withColumn(
        "_none", F.when(F.col("user_id").isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD)).cast("int") + 1).otherwise(0)
    )
    joined = keyed.join(
        customer, (F.col("user_id") == F.col("c_custkey")) & (F.col("_none") == F.col("_spread")), "left"
    ).join(_nation_regions(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select(
        *df.columns, F.col("n_regionkey").alias("account_id"), *(_user_columns() if attributes else [])
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    return c.join(_nation_regions(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("user_id"),
        F.col("n_regionkey").alias("account_id"),
        *_user_columns(),
        F.lit(40).alias("weekly_capacity_hours"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("r_regionkey")
    return read(spark, sf_dir, "region").select(
        key.alias("account_id"),
        F.col("r_name").alias("company_name"),
        # adapter rules: attributes derived from the region's key and name
        F.concat(F.lit("industry of "), F.lower("r_name")).alias("industry"),
        F.concat(F.lit("tier "), (key % 3).cast("string")).alias("subscription_tier"),
        F.concat(F.lit("size "), F.length("r_name").cast("string")).alias("company_size"),
    )


def apps(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(APP_CATALOG, APP_SCHEMA)


def projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("project_id"),
        F.col("p_name").alias("project_name"),
        F.when(F.col("p_size") % 4 == 0, "on_hold").otherwise("active").alias("status"),
        F.col("p_size").alias("budgeted_hours"),
    )


SESSION_COLUMNS = [
    "session_id", "user_id", "account_id", "app_id", "project_id", "date", "start_timestamp",
    "duration_minutes", "keyboard_strokes", "mouse_clicks", "activity_percentage",
]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sessions without their account; the raw ``props`` text is parsed here, before any join."""
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    late = F.when(F.col("event_id") % 97 == 0, 1).otherwise(0)
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("session_id"),
        "user_id",
        F.col("event_type").alias("app_id"),
        F.when(k % 10 < 7, k).alias("project_id"),
        F.date_sub(F.to_date("ts"), late).alias("date"),
        F.col("ts").alias("start_timestamp"),
        F.col("value").alias("duration_minutes"),
        (F.floor("value") * 10).cast("bigint").alias("keyboard_strokes"),
        (F.floor("value") * 5).cast("bigint").alias("mouse_clicks"),
        (((F.col("event_id") * 7919) % 10001).cast("double") / 100.0).alias("activity_percentage"),
    )


def sessions(spark: SparkSession, sf_dir: str, attributes: bool = False) -> DataFrame:
    """The session fact, one row per event, with the user's attributes if asked for."""
    out = with_user(_events(spark, sf_dir), spark, sf_dir, attributes)
    return out.select(*SESSION_COLUMNS, *out.columns[len(SESSION_COLUMNS):])


def bare_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The session fact without its account, for what needs no dimension at all."""
    return _events(spark, sf_dir)


def odd_sessions(spark: SparkSession, sf_dir: str, attributes: bool = False) -> DataFrame:
    """The sessions with values that a clean source would not send, by fixed rules on the id."""
    i = F.col("session_id")
    e = _events(spark, sf_dir).withColumns({
        "user_id": F.when(i % 3 == 0, F.lit(None)).otherwise(F.col("user_id")),
        "app_id": F.when(i % 11 == 0, F.lit(None)).otherwise(F.col("app_id")),
        "date": F.when(i % 13 == 0, F.lit(None)).otherwise(F.col("date")),
        "duration_minutes": F.when(i % 5 == 0, -F.col("duration_minutes")).otherwise(F.col("duration_minutes")),
        "activity_percentage": F.when(i % 7 == 0, F.lit(None))
        .when(i % 4 == 0, F.col("activity_percentage") + 100.0).otherwise(F.col("activity_percentage")),
    })
    out = with_user(e, spark, sf_dir, attributes)
    return out.select(*SESSION_COLUMNS, *out.columns[len(SESSION_COLUMNS):])


def sessions_with_copies(spark: SparkSession, sf_dir: str, bare: bool = False) -> DataFrame:
    """Sessions plus an exact second copy of every 200th one, from one scan."""
    s = bare_sessions(spark, sf_dir) if bare else sessions(spark, sf_dir)
    times = F.when(F.col("session_id") % 200 == 0, 2).otherwise(1)
    return s.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")


def with_account(bare: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bare_sessions`` or rows chosen from them, with the account of their user."""
    return with_user(bare, spark, sf_dir).select(*SESSION_COLUMNS)


def order_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long daily history from ``orders``: (date, user_id, account_id, is_active_day=1), one row
    per order (several orders of a day give several rows, as two daily rows would)."""
    o = read(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("date")
    )
    return with_user(o, spark, sf_dir).select(
        "date", "user_id", "account_id", F.lit(1).alias("is_active_day")
    )


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The task dimension from ``orders``, one task for each."""
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("task_id"),
        (F.col("o_custkey") % 1000).alias("project_id"),
        F.col("o_orderpriority").alias("task_name"),
        F.col("o_orderstatus").alias("task_status"),
        F.floor(F.col("o_totalprice") / 10_000).cast("int").alias("estimated_hours"),
        F.to_date("o_orderdate").alias("created_date"),
    )


def used_apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The application catalog as far as the events use it."""
    return read(spark, sf_dir, "events").select(F.col("event_type").alias("app_id")).distinct().join(
        F.broadcast(apps(spark)), "app_id")


def model(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All model tables, keyed like the raw layer."""
    return {
        "sessions": sessions(spark, sf_dir),
        "users": users(spark, sf_dir),
        "accounts": accounts(spark, sf_dir),
        "apps": apps(spark),
        "projects": projects(spark, sf_dir),
    }
