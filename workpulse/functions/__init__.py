"""Column-expression helpers (all JVM-side, no Python UDFs)."""

from workpulse.functions.dates import day_number, end_timestamp, is_weekend, week_start, weeks_between
from workpulse.functions.flags import flag, tier
from workpulse.functions.rounding import idiv, round_units, to_double, units

__all__ = [
    "day_number", "end_timestamp", "is_weekend", "week_start", "weeks_between",
    "flag", "tier", "idiv", "round_units", "to_double", "units",
]
