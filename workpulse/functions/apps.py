"""Application-dimension expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# An application is web-based when its name contains one of these words
# or is one of the listed names.
WEB_NAME_PARTS = ["Google", "Gmail"]
WEB_NAMES = ["Jira", "Figma"]


def is_web_based(app_name: Column | str) -> Column:
    """Substring test OR list membership; a NULL name gives NULL."""
    name = F.col(app_name) if isinstance(app_name, str) else app_name
    contains = None
    for part in WEB_NAME_PARTS:
        c = name.contains(part)
        contains = c if contains is None else contains | c
    return contains | name.isin(*WEB_NAMES)


def with_web_flag(apps: DataFrame) -> DataFrame:
    """Fill ``is_web_based`` of the application dimension from the name where it is missing."""
    derived = is_web_based("app_name")
    if "is_web_based" in apps.columns:
        derived = F.coalesce(F.col("is_web_based"), derived)
    return apps.withColumn("is_web_based", derived)
