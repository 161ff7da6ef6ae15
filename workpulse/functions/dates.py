"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from workpulse.functions.rounding import ColumnOrName, _col, idiv, units

# Microseconds in one hundredth of a minute.
_MICROS_PER_CENTIMINUTE = 600_000


def end_timestamp(start: ColumnOrName, duration_minutes: ColumnOrName) -> Column:
    """Start plus a fractional number of minutes, cut to whole seconds.

    The duration is a 2-place decimal, so the offset is an exact number of microseconds
    (0.01 min = 0.6 s); the sum is truncated to the second. NULL or negative duration gives NULL.
    The input type is kept (timestamp_ntz stays timestamp_ntz) and no session time zone is used.
    """
    d = units(duration_minutes, 2)
    shifted = F.timestamp_add("MICROSECOND", d * _MICROS_PER_CENTIMINUTE, _col(start))
    # drop the sub-second part arithmetically: no time-zone round trip, type unchanged
    sub_second = (F.extract(F.lit("SECOND"), shifted) * 1_000_000).cast("bigint") % 1_000_000
    return F.when(d >= 0, F.timestamp_add("MICROSECOND", -sub_second, shifted))


def week_start(d: ColumnOrName) -> Column:
    """Monday of the date's week (Sunday belongs to the week that started six days before)."""
    return F.trunc(_col(d), "week")


def is_weekend(d: ColumnOrName) -> Column:
    """True on Saturday and Sunday (``dayofweek`` is 1 = Sunday ... 7 = Saturday)."""
    return F.dayofweek(_col(d)).isin(1, 7)


def weeks_between(later: ColumnOrName, earlier: ColumnOrName) -> Column:
    """Whole weeks between two dates, truncated toward zero."""
    return idiv(F.datediff(_col(later), _col(earlier)), 7).cast("int")


def day_number(d: ColumnOrName) -> Column:
    """Days since 1970-01-01: an integer order key for calendar range frames."""
    return F.unix_date(_col(d))
