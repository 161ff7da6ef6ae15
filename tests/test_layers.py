"""End-to-end rebuild on the smallest test scale."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from workpulse.operators.daily import daily_user_metrics
from workpulse.plans.catalog import AS_OF, BOUNDED_DIMS, enriched
from workpulse.plans.layers import build_layers
from workpulse.sources import read_published, testdata

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))


def test_build_publishes_every_layer(spark):
    out = tempfile.mkdtemp(prefix="wp-pipe-", dir="/tmp")
    summary = {r["table_name"]: r for r in build_layers(
        spark, testdata.model(spark, SF), out, AS_OF, 90, broadcast_dims=BOUNDED_DIMS).collect()}
    assert summary["staging_enriched_sessions"]["rows"] == 1000
    assert summary["staging_enriched_sessions"]["valid_rows"] == 979
    assert set(summary) == {
        "staging_enriched_sessions", "staging_daily_user_metrics",
        "analytics_user_activity_metrics", "analytics_app_productivity",
        "analytics_retention_cohorts", "analytics_project_allocation"}
    daily_back = read_published(spark, os.path.join(out, "staging_daily_user_metrics"))
    assert _rows(daily_back.select(*daily_user_metrics(enriched(spark, SF)).columns)) == _rows(
        daily_user_metrics(enriched(spark, SF)))


def test_cli_rebuild_from_csv(spark):
    """Raw CSV files (reference layout) -> load_raw -> all layers, through the command line."""
    from workpulse.plans.layers import main
    from workpulse.sources import RAW_FILES, RAW_SCHEMAS, write_csv

    root = tempfile.mkdtemp(prefix="wp-cli-", dir="/tmp")
    raw_dir, out = os.path.join(root, "raw"), os.path.join(root, "out")
    m = testdata.model(spark, SF)
    sources = {
        "raw_fact_activity_sessions": m["sessions"], "raw_dim_users": m["users"],
        "raw_dim_accounts": m["accounts"], "raw_dim_applications": m["apps"],
        "raw_dim_projects": m["projects"],
    }
    for table, schema in RAW_SCHEMAS.items():
        src = sources.get(table)
        cols = []
        for field in schema.fields:
            if src is not None and field.name in src.columns:
                cols.append(F.col(field.name).cast(field.dataType).alias(field.name))
            else:
                cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        df = (src if src is not None else spark.range(0)).select(*cols)
        write_csv(df.coalesce(1), os.path.join(raw_dir, RAW_FILES[table]))
    main(["--raw-dir", raw_dir, "--out-dir", out, "--as-of", AS_OF])
    back = read_published(spark, os.path.join(out, "staging_enriched_sessions"))
    assert back.count() == 1000
    assert back.filter("is_valid_session = 1").count() == 979
    cohorts = read_published(spark, os.path.join(out, "analytics_retention_cohorts"))
    assert cohorts.filter("weeks_since_cohort = 0 AND retention_pct = 100.0").count() == \
        cohorts.filter("weeks_since_cohort = 0").count() > 0


def test_build_registers_catalog_tables(spark):
    from workpulse.sources import catalog_inventory

    out = tempfile.mkdtemp(prefix="wp-cat-", dir="/tmp")
    build_layers(spark, testdata.model(spark, SF), out, AS_OF, 90,
                 broadcast_dims=BOUNDED_DIMS, database="wp_test", co_locate_buckets=4).collect()
    inv = {r["table_name"]: r["row_count"] for r in catalog_inventory(spark, "wp_test").collect()}
    assert inv["staging_enriched_sessions"] == 1000
    assert sorted(inv) == sorted([
        "analytics_app_productivity", "analytics_project_allocation", "analytics_retention_cohorts",
        "analytics_user_activity_metrics", "raw_sessions_by_user", "raw_users_by_user",
        "staging_daily_user_metrics", "staging_enriched_sessions"])
    assert inv["raw_sessions_by_user"] == 1000
    assert spark.table("wp_test.staging_daily_user_metrics").count() == inv["staging_daily_user_metrics"]


def test_session_table_prunes_dates(spark):
    """The lookback of the application table reads only the date folders that it needs."""
    import contextlib
    import io

    from workpulse.operators.apps import app_productivity

    out = tempfile.mkdtemp(prefix="wp-prune-", dir="/tmp")
    build_layers(spark, testdata.model(spark, SF), out, AS_OF, 90, broadcast_dims=BOUNDED_DIMS)
    published = read_published(spark, os.path.join(out, "staging_enriched_sessions"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        app_productivity(published, AS_OF, 14).explain()
    assert "PartitionFilters: [isnotnull(date" in buf.getvalue()


def test_build_keeps_duplicates_unless_asked(spark):
    model = testdata.model(spark, SF)
    model["sessions"] = testdata.sessions_with_copies(spark, SF)  # 5 extra copies at sf0.001
    kept = {r["table_name"]: r["rows"] for r in build_layers(
        spark, model, tempfile.mkdtemp(prefix="wp-dup-", dir="/tmp"), AS_OF, 90,
        broadcast_dims=BOUNDED_DIMS).collect()}
    deduped = {r["table_name"]: r["rows"] for r in build_layers(
        spark, model, tempfile.mkdtemp(prefix="wp-dedup-", dir="/tmp"), AS_OF, 90, dedupe=True,
        broadcast_dims=BOUNDED_DIMS).collect()}
    assert kept["staging_enriched_sessions"] == 1005
    assert deduped["staging_enriched_sessions"] == 1000
