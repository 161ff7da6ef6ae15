"""Data-quality operators: layer row counts, per-day flag counts, duplicate sessions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def layer_summary(tables: dict[str, tuple[DataFrame, str | None]]) -> DataFrame:
    """(table_name, rows, valid_rows): row count of each table and the sum of its flag column
    (NULL when the table has none), one aggregate per table, unioned."""
    parts = []
    for name, (df, flag_col) in tables.items():
        valid = F.sum(flag_col).cast("bigint") if flag_col else F.lit(None).cast("bigint")
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"), valid.alias("valid_rows"))
                     .select(F.lit(name).alias("table_name"), "rows", "valid_rows"))
    return reduce(DataFrame.unionByName, parts)


def session_quality(enriched: DataFrame) -> DataFrame:
    """Per date: sessions and how many carry each quality flag."""
    s = lambda c: F.sum(c).cast("bigint")
    return enriched.groupBy("date").agg(
        F.count(F.lit(1)).alias("sessions"),
        s("is_valid_session").alias("valid_sessions"),
        (F.count(F.lit(1)) - s("is_valid_session")).alias("invalid_sessions"),
        s("is_late_arrival").alias("late_arrivals"),
        s("is_too_short").alias("too_short_sessions"),
        s("is_too_long").alias("too_long_sessions"),
        s("is_high_idle").alias("high_idle_sessions"),
        s("is_weekend").alias("weekend_sessions"),
    )


def duplicate_sessions(sessions: DataFrame, key: str = "session_id") -> DataFrame:
    """(session_id, copies) for ids that occur more than once. Counts combine map-side, so an
    id with millions of copies is still a handful of partial counts."""
    return (sessions.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))


#: Bits of the filter of repeated ids (512 KB): about 10 for each repeated id let 1 to 2 % of the others through, so
#: pass more where more than some 400 000 ids are repeated (1 << 28, 32 MB, for 25 million).
FILTER_BITS = 1 << 22
FILTER_HASHES = 3


def _filter_positions(key: str, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(FILTER_HASHES)]


def id_filter(ids: DataFrame, key: str, bits: int = FILTER_BITS) -> Column:
    """A column that is true for every row whose ``key`` is in ``ids``, and for few others.

    A Bloom filter of ``bits`` bits (a multiple of 64), held as 64-bit words: every id sets its bits in its task,
    words are merged with partial ORs, and the finished array, whose size is ``bits`` whatever the number of
    ids, is a scalar subquery of the plan that tests it.
    """
    spark = ids.sparkSession
    place = ids.select(F.explode(F.array(*_filter_positions(key, bits))).alias("_p"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_p").bitwiseAND(F.lit(63)).cast("int"))
    words = place.select(F.shiftright("_p", 6).alias("id"), one.alias("_bit")).groupBy("id").agg(F.bit_or("_bit").alias("_word"))
    every = spark.range(bits // 64).join(words, "id", "left").select("id", F.coalesce("_word", F.lit(0).cast("bigint")).alias("_word"))
    table = every.agg(F.transform(F.sort_array(F.collect_list(F.struct("id", "_word"))), lambda w: w["_word"]).alias("_words")).scalar()
    tests = [
        F.getbit(F.get(table, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1
        for p in _filter_positions(key, bits)
    ]
    return reduce(lambda x, y: x & y, tests)


def dedupe_sessions(sessions: DataFrame, key: str = "session_id", filter_bits: int = FILTER_BITS) -> DataFrame:
    """One row per id: the smallest row of its copies (a fixed choice; copies are usually exact).

    The repeated ids are found from the id column alone. Whole rows are tested against a filter of these ids where
    they are read: what it doesn't hold has an id of its own and passes through without a shuffle; the rest, the
    copies and a few others, is compared by a MIN over a struct that takes partial minima before its shuffle, so
    that a heavily repeated id never gathers its copies in one task. The result is exact whatever the filter lets
    through; with far more repeated ids than ``filter_bits`` / 10 more rows move. Rows without an id are one group.
    """
    others = [c for c in sessions.columns if c != key]
    repeated = duplicate_sessions(sessions, key).select(key)
    tested = sessions.withColumn("_maybe", id_filter(repeated, key, filter_bits))
    single = tested.where(~F.col("_maybe")).drop("_maybe")
    chosen = (
        tested.where("_maybe")
        .groupBy(key).agg(F.min(F.struct(*others)).alias("_row"))
        .select(key, *[F.col(f"_row.{c}").alias(c) for c in others])
    )
    return single.select(key, *others).unionByName(chosen).select(*sessions.columns)


def staging_summary(daily: DataFrame) -> DataFrame:
    """Rows and valid rows of the enriched and the daily table, both from one pass over the daily one:
    every enriched session is counted in exactly one user-day."""
    sums = daily.agg(
        F.coalesce(F.sum("total_sessions"), F.lit(0)).cast("bigint").alias("_sessions"),
        F.sum("valid_sessions").cast("bigint").alias("_valid"),
        F.count(F.lit(1)).alias("_days"),
        F.sum("is_active_day").cast("bigint").alias("_active"),
    )
    row = lambda name, rows, valid: F.struct(
        F.lit(name).alias("table_name"), F.col(rows).alias("rows"), F.col(valid).alias("valid_rows"))
    return sums.select(F.inline(F.array(
        row("staging_enriched_sessions", "_sessions", "_valid"),
        row("staging_daily_user_metrics", "_days", "_active"),
    )))
