"""Exact rounding.

The published measures are decimals with 1-3 places, rounded half away from zero. Doing that on
doubles is not exact: a duration of 22.57 minutes is stored as 22.569999..., and about one
session in sixty lands on an exact .005 tie. So every measure is carried as an integer count of
units (hundredths of an hour, hundredths of a percent, ...), sums run on those integers (exact and
independent of summation order across partitions), and a ratio is rounded with integer division.
Values are converted back to doubles only when published.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName | int | float) -> Column:
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c) if isinstance(c, (int, float)) else c


def units(c: ColumnOrName, scale: int = 2) -> Column:
    """Integer number of ``10**-scale`` units in a double holding a ``scale``-place decimal."""
    return F.round(_col(c) * float(10**scale)).cast("bigint")


def idiv(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Integral division (truncates toward zero), as SQL ``div``."""
    return F.call_function("div", _col(num), _col(den))


def round_units(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / den`` rounded half away from zero to an integer, for integer ``num`` and ``den``.

    NULL when ``den`` is NULL or not positive (the guarded ratios of the reference give NULL there).
    """
    n, d = _col(num), _col(den)
    d = F.when(d > 0, d)
    magnitude = idiv(F.abs(n) * 2 + d, d * 2)
    return F.when(n < 0, -magnitude).otherwise(magnitude)


def to_double(u: ColumnOrName, scale: int = 2) -> Column:
    """Publish an integer unit count as a double with ``scale`` places."""
    return _col(u).cast("double") / float(10**scale)


def ratio_at_least(num: ColumnOrName, den: ColumnOrName, threshold: float) -> Column:
    """``num / den >= threshold`` decided exactly on integers (``den`` > 0): the decimal
    threshold is read as the fraction it is written as (0.30 is 3/10, not a binary double)."""
    t = Fraction(str(threshold))
    return _col(num) * t.denominator >= _col(den) * t.numerator


def ratio_above(num: ColumnOrName, den: ColumnOrName, threshold: float) -> Column:
    """``num / den > threshold`` decided exactly on integers (``den`` > 0)."""
    t = Fraction(str(threshold))
    return _col(num) * t.denominator > _col(den) * t.numerator
