"""Project allocation: where each account's valid hours went."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from workpulse.functions.rounding import round_units, to_double, units
from workpulse.operators.ranks import rank_in_ranges
from workpulse.operators.user_activity import lookback_start

UNALLOCATED = "unallocated"


def project_allocation(
    enriched: DataFrame, as_of: str | dt.date | None = None, lookback_days: int | None = None
) -> DataFrame:
    """Valid sessions per (account, project): ``session_count``, ``unique_users``, ``total_hours``,
    ``pct_of_account_hours``, ``pct_of_budget`` (hours over the project's budgeted hours; NULL
    without a budget), and ``project_rank`` in the account by hours (RANK, ties share).
    Sessions without a project form one 'unallocated' row per account.

    With ``lookback_days`` only sessions on or after ``as_of - lookback_days`` count. No step needs
    all projects of an account in one task: see ``rank_in_ranges``.
    """
    v = enriched.filter(F.col("is_valid_session") == 1)
    if lookback_days is not None:
        v = v.filter(F.col("date") >= lookback_start(as_of, lookback_days))
    name = F.when(F.col("project_id").isNull(), F.lit(UNALLOCATED)).otherwise(F.col("project_name"))
    agg = v.groupBy("account_id", "project_id", name.alias("project_name"), "project_status",
                    "project_budget_hours").agg(
        F.count(F.lit(1)).alias("session_count"),
        F.count_distinct("user_id").alias("unique_users"),
        F.sum(units("duration_hours")).alias("_h"),
    )
    # the ranks read the same columns as the rows they go to, so that Spark reuses one exchange
    ranks = rank_in_ranges(agg.filter(F.col("session_count") > 0), "account_id", "_h")
    same = agg["account_id"].eqNullSafe(ranks["_group"]) & agg["_h"].eqNullSafe(ranks["_value"])
    return agg.join(ranks, same, "left").select(
        "account_id", "project_id", "project_name", "project_status", "project_budget_hours",
        "session_count", "unique_users",
        to_double("_h").alias("total_hours"),
        to_double(round_units(F.col("_h") * 10_000, "_total")).alias("pct_of_account_hours"),
        to_double(round_units(F.col("_h") * 100, F.col("project_budget_hours").cast("bigint")))
        .alias("pct_of_budget"),
        F.col("_rank").alias("project_rank"),
    )
