"""Raw schemas, CSV loading, publishing, and the adapter over the given test tables."""

from workpulse.sources.csv import (
    RAW_FILES,
    catalog_inventory,
    csv_header,
    header_drift,
    load_raw,
    malformed_rows,
    read_csv_table,
    table_inventory,
    value_drift,
)
from workpulse.sources.layout import Layout, plan_write
from workpulse.sources.schemas import RAW_SCHEMAS
from workpulse.sources.sinks import LAYOUTS, publish, publish_bucketed, publish_table, refresh_table, write_csv
from workpulse.sources.versions import (
    ConcurrentRefresh,
    committed_counts,
    current_version,
    read_in_order,
    read_published,
    refresh,
    list_versions,
)

__all__ = ["LAYOUTS", "RAW_FILES", "RAW_SCHEMAS", "ConcurrentRefresh", "Layout", "catalog_inventory", "committed_counts",
           "csv_header", "current_version", "header_drift", "list_versions", "load_raw", "malformed_rows", "plan_write", "publish",
           "publish_bucketed", "publish_table", "read_csv_table", "read_in_order", "read_published", "refresh", "refresh_table",
           "table_inventory", "value_drift", "write_csv"]
