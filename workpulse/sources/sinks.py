"""Publishing tables (full refresh) and CSV output."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from workpulse.sources.layout import Layout
from workpulse.sources.versions import Folder, Version, refresh

# Read layouts of the published tables (what the reference's indexes served). Tables with a date have a folder
# for each, so the lookback filters prune folders. In it the session and user-day tables lie along a curve over
# their look-up keys: a user, an account or both touch few row groups, by the min/max statistics, and Bloom filters
# answer for single ids. The retention table has one order through all its files.
LAYOUTS: dict[str, Layout] = {
    "staging_enriched_sessions": Layout(("date",), cluster_by=("user_id", "account_id"), bloom=("user_id", "account_id")),
    "staging_daily_user_metrics": Layout(("date",), cluster_by=("user_id", "account_id"), bloom=("user_id", "account_id")),
    "analytics_user_activity_metrics": Layout(("date",), cluster_by=("user_id", "account_id"), bloom=("user_id", "account_id")),
    "analytics_app_productivity": Layout(("date",), ("account_id",)),
    "analytics_retention_cohorts": Layout((), ("cohort_week", "account_id", "weeks_since_cohort"), ordered=True),
    "analytics_project_allocation": Layout((), ("account_id", "project_id"), ordered=True),
}


def publish(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    cluster: bool = True,
    catalog_name: str | None = None,
) -> None:
    """Full-refresh Parquet write of one plain folder, so that a rerun is idempotent.

    The rows are written to a folder next to ``path`` first, which then takes its place: a write that fails leaves the
    former table as it was. Between the two renames there is none; ``versions.refresh`` has no such moment,
    needs no rename, and keeps former versions. Rows are clustered by the partition columns with a REBALANCE (one
    shuffle; AQE splits a partition value that is too big into several tasks and files, and merges small ones)
    unless ``cluster`` is False, then sorted inside each task by ``sort_by``. With ``catalog_name`` (``db.table`` or
    ``table``) the data is registered in the session catalog as an external table at ``path``, as Spark replaces one.
    """
    out = df.hint("rebalance", *partition_by) if partition_by and cluster else df
    if sort_by:
        out = out.sortWithinPartitions(*[*partition_by, *sort_by])
    writer = out.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if catalog_name is not None:
        writer.option("path", path).saveAsTable(catalog_name)
        return
    parent, name = path.rstrip("/").rsplit("/", 1)
    folder = Folder(df.sparkSession, parent)
    fresh, former = (f"_{kind}-{name}-{uuid.uuid4().hex}" for kind in ("fresh", "former"))
    try:
        writer.save(f"{parent}/{fresh}")
    except BaseException:
        folder.delete(fresh)
        raise
    replaced = folder.move(name, former)
    if not folder.move(fresh, name):
        if replaced:
            folder.move(former, name)
        folder.delete(fresh)
        raise OSError(f"{path} could not be replaced")
    folder.delete(former)


def publish_table(df: DataFrame, path: str, table: str, catalog_name: str | None = None) -> None:
    """Publish one plain folder with the partitions and the sort keys of the table's layout."""
    layout = LAYOUTS.get(table, Layout())
    publish(df, path, layout.partition_by, layout.sort_by or layout.cluster_by, catalog_name=catalog_name)


def refresh_table(df: DataFrame, path: str, table: str, counts: dict[str, Column] | None = None, **options) -> Version:
    """Commit ``df`` as the next version of the table at ``path``, with the table's layout (``versions.refresh``)."""
    return refresh(df, path, LAYOUTS.get(table, Layout()), counts, **options)


def publish_bucketed(df: DataFrame, path: str, catalog_name: str, key: str | Sequence[str], buckets: int) -> None:
    """Write a catalog table hash-bucketed and sorted by ``key``, a column or several (external, at ``path``).

    Two tables bucketed the same way on the join key join without a shuffle on either side:
    Spark reads matching buckets together. Sessions and users bucketed by ``user_id`` make the
    enrichment join, and the user-keyed aggregation after it, exchange-free. ``buckets`` should
    give files of a few hundred MB at the target scale.
    """
    keys = [key] if isinstance(key, str) else list(key)
    (df.write.mode("overwrite").format("parquet").option("path", path)
       .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(catalog_name))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header row and no index column, full refresh."""
    (df.write.mode("overwrite").option("header", True)
       .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
