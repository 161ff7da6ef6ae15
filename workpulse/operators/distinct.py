"""Distinct users that can be merged: exact bitmaps kept with the user-days.

A user's number gives a bucket and a bit in it. For each (date, account, bucket) one row holds the bitmaps of the
users with an active day and of those with any row, and the productive hours. Any period, any set of accounts
and any trailing window is then an OR of stored bitmaps and a count of bits: exact, without a user's id
leaving its task, and a day's bitmaps are made once.

A bitmap has 32768 bits whatever it holds; ``number_users`` numbers users account by account, so that an
account's users fill few buckets. Integer ids may be numbers themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from workpulse.functions.dates import week_start
from workpulse.functions.rounding import round_units, to_double, units
from workpulse.operators.engagement import L7D_DAYS
from workpulse.session import materialize


def number_users(users: DataFrame, former: DataFrame | None = None, by: tuple[str, ...] = ("account_id", "user_id")) -> DataFrame:
    """(user_id, user_number): each user's own number from 1, in the order of ``by``.

    Users of ``former`` keep theirs and new ones follow, so that stored bitmaps stay right. Users are sorted by
    ranges; a range's first number comes from the counts of the ranges before it, one number for each. The result is
    a checkpoint: numbers must not change when a task is run again.
    """
    fresh = users.where("user_id is not null").select("user_id", *(c for c in by if c != "user_id")).dropDuplicates(["user_id"])
    start = F.lit(0).cast("bigint")
    if former is not None:
        fresh = fresh.join(former.select("user_id"), "user_id", "left_anti")
        start = F.lit(former.agg(F.coalesce(F.max("user_number"), F.lit(0))).first()[0])
    placed = materialize(
        fresh.repartitionByRange(*by).sortWithinPartitions(*by).select("user_id", F.monotonically_increasing_id().alias("_place")))
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    in_part = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").select(
        "user_id", (start + F.col("_before") + in_part + 1).alias("user_number"))
    return numbered if former is None else former.select("user_id", "user_number").unionByName(numbered)


def user_bitmaps(daily: DataFrame, numbers: DataFrame | None = None) -> DataFrame:
    """(date, account_id, bucket, active_users, seen_users, productive_units) from user-days.

    ``active_users`` and ``seen_users`` are bitmaps; productive hours are whole hundredths. ``numbers`` has
    (user_id, user_number); without it an integer ``user_id`` is the number. Rows without a user keep their hours,
    in a row without a bucket.
    """
    if numbers is None:
        numbered = daily.withColumn("_number", F.col("user_id").cast("bigint"))
    else:
        numbered = daily.join(numbers.select("user_id", F.col("user_number").alias("_number")), "user_id", "left")
    number = F.col("_number")
    position = F.bitmap_bit_position(number)
    return numbered.groupBy("date", "account_id", F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.when(F.col("is_active_day") == 1, position)).alias("active_users"),
        F.bitmap_construct_agg(position).alias("seen_users"),
        F.sum(units("productive_hours")).alias("productive_units"),
    )


def distinct_users(bitmaps: DataFrame, by: list[str], column: str = "active_users") -> DataFrame:
    """(*by, users): distinct users of each group of ``by`` columns over all its dates and accounts."""
    merged = bitmaps.groupBy(*by, F.col("bucket").alias("_bucket")).agg(F.bitmap_count(F.bitmap_or_agg(column)).alias("_n"))
    return merged.groupBy(*by).agg(F.sum("_n").alias("users"))


def active_users_by_day(bitmaps: DataFrame, days: int = L7D_DAYS) -> DataFrame:
    """(as_of, scope, account_id, active_users) for every date that has a user-day as the reporting date.

    Distinct users with an active day in the ``days`` up to it, per account and (scope 'all') overall: each day's
    bitmaps count for the days after it, and accounts are merged bucket by bucket.
    """
    reported = bitmaps.select(F.col("date").alias("as_of")).where("as_of is not null").distinct()
    active = bitmaps.where(F.bitmap_count("active_users") > 0)
    reach = active.select(
        F.explode(F.sequence("date", F.date_add("date", days - 1))).alias("as_of"), "account_id", "bucket", "active_users"
    ).join(F.broadcast(reported), "as_of", "left_semi")
    merged = reach.groupBy("as_of", "account_id", "bucket").agg(F.bitmap_or_agg("active_users").alias("active_users"))
    # a user of two accounts has one bit in their merged bitmap
    all_of = merged.groupBy("as_of", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("active_users")).alias("_n"))
    accounts = merged.groupBy("as_of", "account_id").agg(F.sum(F.bitmap_count("active_users")).alias("active_users"))
    overall = all_of.groupBy("as_of").agg(F.sum("_n").alias("active_users"))
    return accounts.select("as_of", F.lit("account").alias("scope"), "account_id", "active_users").unionByName(
        overall.select("as_of", F.lit("all").alias("scope"), F.lit(None).cast(dict(bitmaps.dtypes)["account_id"]).alias("account_id"), "active_users"))


def productive_hours_by_period(bitmaps: DataFrame, period: str = "week") -> DataFrame:
    """(account_id, period_start, users, productive_hours, avg_productive_hours), as ``avg_productive_hours`` gives
    them from the user-days, for any period: 'week', 'month', 'quarter' or 'year'."""
    start = week_start("date") if period == "week" else F.trunc("date", period)
    merged = bitmaps.groupBy("account_id", start.alias("period_start"), "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("seen_users")).alias("_n"), F.sum("productive_units").alias("_p"))
    return merged.groupBy("account_id", "period_start").agg(F.sum("_n").alias("users"), F.sum("_p").alias("_p")).select(
        "account_id", "period_start", "users", to_double("_p").alias("productive_hours"),
        to_double(round_units("_p", "users")).alias("avg_productive_hours"))
