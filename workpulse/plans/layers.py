"""The full rebuild: raw -> staging -> analytics, each layer committed as a version of its table.

Every table is read back before the next layer uses it, so lineage stops at a table written to shared
storage: if executors are lost later, only the current layer is recomputed. A rebuild that fails leaves
every table whole, in its new version or its former one; run again with the same run name it goes on after
the last committed layer. Row counts are observed while the tables are written and kept in their commits.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from workpulse.operators.allocation import project_allocation
from workpulse.operators.apps import app_productivity
from workpulse.operators.cohorts import retention_cohorts
from workpulse.operators.daily import daily_user_metrics
from workpulse.operators.enrich import enrich_sessions
from workpulse.operators.quality import dedupe_sessions
from workpulse.operators.user_activity import LOOKBACK_DAYS, user_activity_metrics
from workpulse.sources.csv import header_drift, load_raw, read_csv_table
from workpulse.sources.sinks import publish_bucketed, refresh_table
from workpulse.sources.versions import committed_counts, current_version, read_published

RAW_TO_MODEL = {
    "raw_fact_activity_sessions": "sessions",
    "raw_dim_users": "users",
    "raw_dim_accounts": "accounts",
    "raw_dim_applications": "apps",
    "raw_dim_projects": "projects",
}


def model_from_raw(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rename loaded raw tables (``raw_dim_users`` ...) to the operator inputs (``users`` ...)."""
    return {RAW_TO_MODEL[k]: v for k, v in raw.items() if k in RAW_TO_MODEL}


def heavy_users(sessions: DataFrame, buckets: int) -> DataFrame:
    """(user_id, parts) of the users, and of the missing one, with more sessions than a bucket's fair share: at most
    ``buckets`` rows. ``parts`` are so many that each is at most that share."""
    counted = sessions.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n"))
    total = sessions.agg(F.count(F.lit(1)).alias("_all"))
    share = F.greatest(F.lit(1.0), total.scalar() / F.lit(buckets))
    return counted.where(F.col("_n") > share).select("user_id", F.ceil(F.col("_n") / share).cast("int").alias("parts"))


def spread_over_buckets(sessions: DataFrame, users: DataFrame, heavy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sessions and users with ``user_bucket``: one value for a user, ``parts`` for a heavy one.

    A heavy user's sessions are dealt over the values by a hash of the session, and its dimension row is repeated
    for each of them: at most two rows for each bucket are added. Sessions without a user match none of them.
    """
    of = F.broadcast(heavy.select(F.col("user_id").alias("_heavy"), "parts"))  # at most a row for each bucket
    value = lambda part: F.xxhash64("user_id", part)
    parts = F.coalesce("parts", F.lit(1))
    dealt = sessions.join(of, sessions["user_id"].eqNullSafe(F.col("_heavy")), "left").withColumn(
        "user_bucket", value(F.pmod(F.xxhash64("session_id"), parts).cast("int")))
    known = users.where("user_id is not null")
    repeated = known.join(of, known["user_id"] == F.col("_heavy"), "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), parts - 1))).withColumn("user_bucket", value(F.col("_part").cast("int")))
    return dealt.select(*sessions.columns, "user_bucket"), repeated.select(*users.columns, "user_bucket")


def land_co_located(
    spark: SparkSession, model: dict[str, DataFrame], out_dir: str, database: str, buckets: int
) -> dict[str, DataFrame]:
    """Land the session fact and the user dimension bucketed by ``user_id`` (same bucket
    count) and return the model reading them back, so the enrichment join runs without shuffling the fact. Meant
    for the ingest step of a deployment where the user dimension is too large to broadcast.

    Where a user, or the sessions without one, would fill more than a bucket, both tables are bucketed by
    (``user_bucket``, ``user_id``): see ``spread_over_buckets``. The enrichment joins on both columns then.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    landed = dict(model)
    tables = {name: model[name] for name in ("sessions", "users")}
    keys = ["user_id"]
    heavy = heavy_users(tables["sessions"], buckets)
    found = heavy.collect()  # at most a row for each bucket
    if found:
        heavy = spark.createDataFrame(found, heavy.schema)
        tables = dict(zip(tables, spread_over_buckets(*tables.values(), heavy), strict=True))
        keys = ["user_bucket", "user_id"]
    for name, df in tables.items():
        table = f"{database}.raw_{name}_by_user"
        publish_bucketed(df, f"{out_dir.rstrip('/')}/raw_{name}_by_user", table, keys, buckets)
        landed[name] = spark.table(table)
    return landed


def _refresh_and_reload(
    spark: SparkSession, df: DataFrame, out_dir: str, table: str, database: str | None = None, run: str | None = None,
    counts: dict[str, Column] | None = None, histogram_of: DataFrame | None = None,
) -> DataFrame:
    """Commit the next version of a table, unless ``run`` has committed it already, and read it back."""
    path = f"{out_dir.rstrip('/')}/{table}"
    now = current_version(spark, path)
    if run is None or now is None or now.run != run:
        refresh_table(df, path, table, counts, run=run, histogram_of=histogram_of,
                      catalog_name=f"{database}.{table}" if database else None)
    return read_published(spark, path)


def land_raw(
    spark: SparkSession, raw_dir: str, out_dir: str, files: dict[str, str] | None = None, run: str | None = None
) -> tuple[dict[str, DataFrame], list[tuple[str, str, str]], DataFrame]:
    """Load the raw files and commit each as a table: (tables read back, load report, counts).

    ``counts`` has (table_name, rows, malformed): both are counted while the tables are written, from the one
    scan of each file.
    """
    found, report = load_raw(spark, raw_dir, files)
    tables = {}
    for table, path, status in report:
        if status == "loaded":
            df = read_csv_table(spark, path, table, "_malformed")
            tables[table] = _refresh_and_reload(spark, df, out_dir, table, run=run, counts={"malformed": F.count("_malformed")})
    paths = {table: f"{out_dir.rstrip('/')}/{table}" for table in sorted(found)}
    return tables, report, committed_counts(spark, paths, ("rows", "malformed"))


def build_layers(
    spark: SparkSession,
    model: dict[str, DataFrame],
    out_dir: str,
    as_of: str | dt.date | None = None,
    lookback_days: int = LOOKBACK_DAYS,
    dedupe: bool = False,
    broadcast_dims: tuple[str, ...] = (),
    database: str | None = None,
    co_locate_buckets: int | None = None,
    run: str | None = None,
) -> DataFrame:
    """Build and commit all staging and analytics tables; return the layer summary
    (table_name, rows, valid_rows), which was counted while they were written.

    ``dedupe`` removes repeated session ids before staging (the reference keeps them).
    With ``database`` a view of that catalog database (created if missing) points to each table's
    current version. Tables that a rebuild with the same ``run`` has committed are not built again. With ``co_locate_buckets`` (needs
    ``database``) sessions and users are first landed bucketed by ``user_id``, so the
    enrichment join does not shuffle the fact.
    """
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    if co_locate_buckets:
        if not database:
            raise ValueError("co_locate_buckets needs a catalog database")
        model = land_co_located(spark, model, out_dir, database, co_locate_buckets)
    sessions = dedupe_sessions(model["sessions"]) if dedupe else model["sessions"]
    users = model["users"]
    if not co_locate_buckets:
        # a table of its own: the planner then knows the size of what it joins
        users = _refresh_and_reload(spark, users, out_dir, "staging_users", database, run)
    enriched = _refresh_and_reload(
        spark,
        enrich_sessions(sessions, users, model["accounts"], model["apps"], model["projects"],
                        broadcast=broadcast_dims, spread_missing=not co_locate_buckets),
        out_dir, "staging_enriched_sessions", database, run,
        {"valid_rows": F.sum("is_valid_session")}, histogram_of=model["sessions"])
    daily = _refresh_and_reload(spark, daily_user_metrics(enriched), out_dir, "staging_daily_user_metrics", database, run,
                                {"valid_rows": F.sum("is_active_day")}, histogram_of=enriched)
    analytics = {
        "analytics_user_activity_metrics": lambda: user_activity_metrics(daily, as_of, lookback_days),
        "analytics_app_productivity": lambda: app_productivity(enriched, as_of, lookback_days),
        "analytics_retention_cohorts": lambda: retention_cohorts(daily),
        "analytics_project_allocation": lambda: project_allocation(enriched, as_of, lookback_days),
    }
    for table, built in analytics.items():
        source = {"analytics_user_activity_metrics": daily, "analytics_app_productivity": enriched}.get(table)
        _refresh_and_reload(spark, built(), out_dir, table, database, run, histogram_of=source)
    names = ["staging_enriched_sessions", "staging_daily_user_metrics", *analytics]
    return committed_counts(spark, {n: f"{out_dir.rstrip('/')}/{n}" for n in names}, ("rows", "valid_rows"))


def main(argv: list[str] | None = None) -> None:
    from workpulse.session import get_spark

    p = argparse.ArgumentParser(description="Rebuild the staging and analytics layers.")
    p.add_argument("--raw-dir", required=True, help="folder with the six raw CSV files")
    p.add_argument("--out-dir", required=True, help="folder for the published tables")
    p.add_argument("--as-of", default=None, help="reporting date (default: today, UTC)")
    p.add_argument("--lookback-days", type=int, default=LOOKBACK_DAYS)
    p.add_argument("--dedupe", action="store_true", help="drop repeated session ids first")
    p.add_argument("--database", default=None, help="also register the tables in this database")
    p.add_argument("--co-locate-buckets", type=int, default=None,
                   help="land sessions and users bucketed by user_id first (needs --database)")
    p.add_argument("--run", default=None,
                   help="name of this rebuild: started again under it, it goes on after the last committed table")
    args = p.parse_args(argv)
    spark = get_spark()
    raw, report, counts = land_raw(spark, args.raw_dir, args.out_dir, run=args.run)
    for table, path, status in report:
        print(f"{table}: {status} ({path})")
    header_drift(spark, report).show(truncate=False)
    counts.show(truncate=False)
    summary = build_layers(spark, model_from_raw(raw), args.out_dir, args.as_of,
                           args.lookback_days, args.dedupe, database=args.database,
                           co_locate_buckets=args.co_locate_buckets, run=args.run)
    summary.show(truncate=False)


if __name__ == "__main__":
    main()
