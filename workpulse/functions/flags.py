"""0/1 flags and ordered tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(cond: Column) -> Column:
    """1 when ``cond`` is true, else 0 (NULL counts as false), as an int that can be summed."""
    return F.when(cond, 1).otherwise(0)


def tier(value: Column, bands: Sequence[tuple[float, str]], default: str) -> Column:
    """First band whose threshold ``value`` reaches (``>=``), in the given order, else ``default``."""
    expr = None
    for threshold, label in bands:
        cond = value >= threshold
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.lit(default) if expr is None else expr.otherwise(default)
