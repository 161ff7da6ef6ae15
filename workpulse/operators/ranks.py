"""Ranks inside a group without sorting the group in one task.

``RANK``/``PERCENT_RANK`` over a window need the whole partition in one task; an account with a
third of all users would put a third of a day's rows there. Here a row's rank comes from counts
instead: rows strictly below and strictly above its value in the group. A value histogram per
group is built with a partially aggregated group-by (a hot group shuffles one row per distinct
value, not one per user), cumulative counts run over the histogram (one row per distinct value),
and the counts are joined back on (group, value). The join is an equi-join that Spark can
broadcast when the histogram is small and split with AQE when one key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workpulse.functions.rounding import ratio_at_least, round_units, to_double

# Performance tiers by percent rank (first match wins).
PERFORMANCE_BANDS = [(0.90, "Top Performer"), (0.70, "Above Average"), (0.30, "Average")]
PERFORMANCE_DEFAULT = "Below Average"


def reads_all(df: DataFrame) -> DataFrame:
    """``df`` as a branch of a plan that reads all its columns, though only a few are used after it.

    Spark takes the result of an exchange twice if both readers ask for the same columns. The condition is true
    for every row, which the optimizer does not know.
    """
    return df.where(F.xxhash64(*df.columns) % 2 < 2)


def add_rank_counts(df: DataFrame, group: Sequence[str], value: str, counted: DataFrame | None = None) -> DataFrame:
    """Add ``_below`` (rows of the group with a smaller value; NULL sorts lowest),
    ``_above`` (rows with a larger value) and ``_n`` (rows in the group).

    The histogram is made from ``counted``, by default ``df``: an earlier step with the same rows in each group
    of ``df`` (other groups don't matter). All its columns are read there, so that if ``df`` is made from them too,
    both branches share the last exchange before it, and what lies below is read once.
    """
    keys = [*group, value]
    hist = reads_all(df if counted is None else counted).groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    ordered = Window.partitionBy(*group).orderBy(value)
    hist = (
        hist.withColumns({
            "_upto": F.sum("_c").over(ordered.rowsBetween(Window.unboundedPreceding,
                                                          Window.currentRow)),
            "_n": F.sum("_c").over(Window.partitionBy(*group)),
        })
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                (F.col("_upto") - F.col("_c")).alias("_below"),
                (F.col("_n") - F.col("_upto")).alias("_above"),
                "_n")
    )
    cond = [df[k].eqNullSafe(hist[f"_k_{k}"]) for k in keys]
    return df.join(hist, cond, "left").drop(*[f"_k_{k}" for k in keys])


# Value ranges per factor e: a group has at most some thousand, whatever its rows and values.
RANGES = 64


def rank_in_ranges(df: DataFrame, group: str, value: str) -> DataFrame:
    """(_group, _value, _rank, _total): RANK of each value of a group, the largest first, and the sum
    of the group's values. No step has more than one range of a group's values in a task.

    Values fall into ranges that follow their order (steps of a 64th on a logarithmic scale). The
    distinct values of a range are counted off in a window over (group, range); how many rows stand in
    higher ranges comes from one array of range counts per group, as long as there are ranges.
    """
    number = F.col(value).cast("double")
    ranged = F.floor(F.signum(number) * F.log1p(F.abs(number)) * RANGES)
    hist = (
        df.groupBy(F.col(group).alias("_group"), F.col(value).alias("_value"))
        .agg(F.count(F.lit(1)).alias("_c"), F.first(ranged).alias("_range"))
    )
    inside = Window.partitionBy("_group", "_range").orderBy(F.desc("_value"))
    counted = hist.withColumn(
        "_before", F.coalesce(F.sum("_c").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    ranges = (
        hist.groupBy("_group", "_range")
        .agg(F.sum("_c").alias("_c"), F.sum(F.col("_c") * F.col("_value")).alias("_s"))
        .groupBy("_group")
        .agg(F.collect_list(F.struct("_range", "_c")).alias("_ranges"), F.sum("_s").alias("_total"))
    )
    add = lambda total, r: total + r["_c"]
    higher = lambda this: F.aggregate(
        # values that are missing rank below all others
        F.filter("_ranges", lambda r: (r["_range"] > this["_range"]) | (this["_range"].isNull() & r["_range"].isNotNull())),
        F.lit(0).cast("bigint"), add)
    offsets = ranges.select(
        F.col("_group").alias("_g"), "_total",
        F.inline(F.transform("_ranges", lambda r: F.struct(r["_range"].alias("_r"), higher(r).alias("_higher")))),
    )
    same = counted["_group"].eqNullSafe(offsets["_g"]) & counted["_range"].eqNullSafe(offsets["_r"])
    return counted.join(offsets, same, "left").select(
        "_group", "_value", (F.col("_higher") + F.col("_before") + 1).alias("_rank"), "_total")


def add_productivity_ranks(
    df: DataFrame, group: Sequence[str] = ("account_id", "date"), value: str = "productive_hours",
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add ``productivity_percentile`` (PERCENT_RANK ascending, 3 places; 0 for a lone row),
    ``productivity_rank`` (RANK descending: ties share, next rank skips) and
    ``performance_tier`` (from the unrounded percent rank). ``counted``: see ``add_rank_counts``."""
    ranked = add_rank_counts(df, group, value, counted)
    below, n = F.col("_below"), F.col("_n")
    lone = n <= 1
    perf = None
    for threshold, label in PERFORMANCE_BANDS:
        cond = ~lone & ratio_at_least(below, n - 1, threshold)
        perf = F.when(cond, label) if perf is None else perf.when(cond, label)
    return ranked.withColumns({
        "productivity_percentile":
            F.when(lone, F.lit(0.0)).otherwise(to_double(round_units(below * 1000, n - 1), 3)),
        "productivity_rank": (F.col("_above") + 1).cast("bigint"),
        "performance_tier": perf.otherwise(PERFORMANCE_DEFAULT),
    }).drop("_below", "_above", "_n")
