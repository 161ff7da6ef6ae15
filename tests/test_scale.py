"""Plan shape and skew behaviour: the properties the operators rely on at scale."""

from __future__ import annotations

import contextlib
import io
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from workpulse.operators.daily import daily_user_metrics
from workpulse.operators.enrich import enrich_sessions
from workpulse.operators.user_activity import user_activity_metrics
from workpulse.plans.catalog import AS_OF, BOUNDED_DIMS, QUERIES, daily
from workpulse.sources import publish_table, testdata

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_user_windows_share_one_shuffle_over_a_published_daily_table(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="wp-scale-", dir="/tmp"), "daily")
    publish_table(daily(spark, SF), path, "staging_daily_user_metrics")
    published = spark.read.parquet(path)
    plan = plan_of(user_activity_metrics(published, AS_OF, 14))
    main = plan.split("SubqueryAdaptiveBroadcast")[0]  # dynamic-pruning subqueries come after
    # L7D, LAG and both rolling averages: one exchange on user_id for all of them, and the
    # rank histogram branch does not shuffle by user at all
    assert main.count("Exchange hashpartitioning(user_id") == 1
    # the lookback filter prunes date partitions of the published table
    assert "PartitionFilters: [isnotnull(date" in plan


def _default_session(spark):
    """The caller's settings are Spark's own, not those of ``get_spark``."""
    from workpulse.session import DEFAULTS

    saved = {k: spark.conf.get(k) for k in DEFAULTS if k.startswith("spark.sql.") and "arrow" not in k and "timeZone" not in k}
    for k in saved:
        spark.conf.unset(k)
    return saved


def _initial(plan: str) -> str:
    return plan.split("== Initial Plan ==")[-1]


WRITING = {"csv_round_trip", "rebuild_counts", "retention_published", "published_lookups", "active_users_by_day",
           "productive_hours_by_period"}
EVENT_QUERIES = sorted(set(QUERIES) - {"retention_orders", "retention_rate_orders", "web_apps"} - WRITING)


@pytest.mark.parametrize("name", EVENT_QUERIES)
def test_events_are_not_shuffled_for_a_small_dimension(spark, name):
    """Users that fit the threshold are broadcast: no exchange between the scan of the events and the
    first aggregate, and no shuffle join on them. One customer scan for each events scan, ``props``
    parsed next to the scan, no Expand of the fact but for the counts by ROLLUP."""
    saved = _default_session(spark)
    try:
        plan = plan_of(QUERIES[name](spark, "/root/testdata/sf0.1"))
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    lines = _initial(plan).splitlines()
    for at, line in enumerate(lines):
        if "FileScan parquet" not in line or "event_id" not in line:
            continue
        depth = line.index("FileScan")
        for above in reversed(lines[:at]):
            here = len(above) - len(above.lstrip(" :+-"))
            if here >= depth:
                continue
            depth = here
            if "Aggregate" in above:
                break
            if name != "dedupe_sessions":
                assert "Exchange" not in above and "SortMergeJoin" not in above, above
    scans = [x for x in lines if "FileScan parquet" in x]
    events = sum("event_id" in x or "event_type" in x or "[user_id" in x or "[ts" in x for x in scans)
    assert sum("c_custkey" in x or "c_nationkey" in x for x in scans) <= events + (name in ("engagement_distribution", "utilization_rate", "raw_inventory"))
    assert "Expand" not in plan or name == "active_users_l7d"


@pytest.mark.parametrize("name", ["project_allocation"])
def test_no_window_over_a_whole_account(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    windows = [x for x in plan.splitlines() if " Window [" in x]
    assert windows and all("_range" in x for x in windows)


def test_account_with_very_many_projects_is_spread(spark):
    from workpulse.operators.ranks import rank_in_ranges

    rows = spark.range(40_000).select(F.lit("A").alias("g"), (F.pmod(F.xxhash64("id"), F.lit(9_000_000)) + 1).alias("v"))
    got = {r["_value"]: (r["_rank"], r["_total"]) for r in rank_in_ranges(rows, "g", "v").collect()}
    values = sorted((r["v"] for r in rows.collect()), reverse=True)
    first = {}
    for place, v in enumerate(values, 1):
        first.setdefault(v, place)
    assert {v: r for v, (r, _) in got.items()} == first
    assert {t for _, t in got.values()} == {sum(values)}
    # the counting windows run over many ranges, none of which has a tenth of the account
    ranges = rows.groupBy(F.floor(F.log1p(F.col("v").cast("double")) * 64).alias("r")).count().collect()
    assert len(ranges) > 50 and max(r["count"] for r in ranges) < 4_000


def test_sessions_without_a_user_are_dealt_out(spark):
    """Without AQE: rows whose user is missing don't meet in one partition of a shuffle join."""
    m = testdata.model(spark, "/root/testdata/sf0.01")
    s = m["sessions"].withColumn("user_id", F.when(F.col("session_id") % 3 > 0, F.col("user_id")))
    saved = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        e = enrich_sessions(s, m["users"], m["accounts"], m["apps"], broadcast=BOUNDED_DIMS)
        sizes = [r["count"] for r in e.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert sum(sizes) == s.count()
    assert max(sizes) < 2 * sum(sizes) / 8


def test_new_files_are_seen(spark, tmp_path):
    """A query built again after files were added reads them: no plan is kept between calls."""
    import shutil

    for name in ("events", "customer", "nation", "region", "part"):
        (tmp_path / f"{name}.parquet").mkdir()
        shutil.copy(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet" / "one.parquet")
    names = sorted(set(EVENT_QUERIES) - {"dedupe_sessions"})
    counted = ("session_flags", "layer_summary", "session_quality", "enriched_sessions")
    before = {n: QUERIES[n](spark, str(tmp_path)).inputFiles() for n in names}
    rows = {n: QUERIES[n](spark, str(tmp_path)).count() for n in counted}
    shutil.copy(f"{SF}/events.parquet", tmp_path / "events.parquet" / "two.parquet")
    for n in names:
        after = QUERIES[n](spark, str(tmp_path)).inputFiles()
        assert len(after) == len(before[n]) + 1, n
    assert QUERIES["session_flags"](spark, str(tmp_path)).count() == 2 * rows["session_flags"]
    assert QUERIES["enriched_sessions"](spark, str(tmp_path)).count() == 2 * rows["enriched_sessions"]


def test_no_registered_query_writes_a_checkpoint(spark, monkeypatch):
    from pyspark.sql import DataFrame

    def refuse(*_, **__):
        raise AssertionError("checkpoint")

    monkeypatch.setattr(DataFrame, "checkpoint", refuse)
    for name in sorted(set(QUERIES) - {"csv_round_trip"}):
        QUERIES[name](spark, SF)


def test_checkpoints_need_a_shared_folder(monkeypatch):
    from workpulse.session import ensure_checkpoint_dir

    class Context:
        getCheckpointDir = staticmethod(lambda: None)  # noqa: N815
        getConf = staticmethod(lambda: {})  # noqa: N815

    class Session:
        sparkContext = Context()  # noqa: N815

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


def test_hot_user_split_by_aqe_gives_identical_results(spark):
    """One user holds a third of all sessions. With skew thresholds forced low AQE splits that
    user's join partition; the results must equal the unsplit run."""
    m = testdata.model(spark, "/root/testdata/sf0.01")
    # spread over 8 map tasks, as a many-file input would be: AQE splits a hot partition along
    # map-output boundaries
    hot = m["sessions"].withColumn(
        "user_id", F.when(F.col("session_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id"))
    ).repartition(8)
    users = m["users"].hint("shuffle_merge")  # keep a sort-merge join so the skew rule applies

    def run():
        e = enrich_sessions(hot, users, m["accounts"], m["apps"], m["projects"],
                            broadcast=BOUNDED_DIMS)
        df = user_activity_metrics(daily_user_metrics(e), AS_OF, 90)
        return df, sorted(map(tuple, df.collect()), key=str)

    keys = ["spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.autoBroadcastJoinThreshold"]
    saved = {k: spark.conf.get(k) for k in keys}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        _, plain = run()
        spark.conf.set(keys[0], "1k")
        spark.conf.set(keys[1], "1")
        spark.conf.set(keys[2], "1k")
        df, split = run()
        assert "skew=true" in plan_of(df)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert split == plain
    assert len(plain) > 0


def test_bucketed_sessions_and_users_join_without_shuffle(spark):
    from workpulse.plans.catalog import BOUNDED_DIMS
    from workpulse.plans.layers import land_co_located

    out = tempfile.mkdtemp(prefix="wp-bucket-", dir="/tmp")
    m = land_co_located(spark, testdata.model(spark, SF), out, "wp_bucketed", buckets=4)
    users = m["users"].hint("merge")  # as if too big to broadcast
    e = enrich_sessions(m["sessions"], users, m["accounts"], m["apps"], m["projects"],
                        broadcast=BOUNDED_DIMS, spread_missing=False)
    daily_df = daily_user_metrics(e)
    plan = plan_of(daily_df)
    assert "SortMergeJoin" in plan
    # neither join side moves, and the rollup keeps the bucketing by user
    assert "Exchange hashpartitioning" not in plan
    got = sorted(map(tuple, daily_df.collect()), key=str)
    expected = sorted(map(tuple, daily(spark, SF).collect()), key=str)
    assert got == expected


@pytest.mark.parametrize("name", ["productivity_percentile", "productivity_rank", "performance_tier", "user_activity_metrics", "user_activity_short"])
def test_ranks_read_the_events_once(spark, name):
    """Both branches of the ranks, rows and histogram, share the exchange below the user-days."""
    df = QUERIES[name](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = [x for x in final.splitlines() if "FileScan parquet" in x and "event_type" in x]
    assert len(scans) == 1 and "ReusedExchange" in final


def test_co_located_landing_spreads_heavy_users(spark):
    """A user with a third of the sessions, and as many without one: no bucket has far more than its share, the
    enrichment has no exchange, and its rows are those of the plain join."""
    from workpulse.plans.layers import land_co_located

    base = testdata.bare_sessions(spark, "/root/testdata/sf0.01").drop("account_id")
    i = F.col("session_id")
    sessions = base.withColumn("user_id", F.when(i % 3 == 0, 7).when(i % 3 == 1, F.lit(None)).otherwise(F.col("user_id")))
    sessions = sessions.withColumn("account_id", F.lit(1))
    users = testdata.users(spark, "/root/testdata/sf0.01")
    out = tempfile.mkdtemp(prefix="wp-hot-", dir="/tmp")
    landed = land_co_located(spark, {"sessions": sessions, "users": users}, out, "wp_hot", 16)
    sizes = [r["count"] for r in spark.read.parquet(f"{out}/raw_sessions_by_user").groupBy(
        F.regexp_extract(F.input_file_name(), r"_(\d+)\.c000", 1)).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * sum(sizes) / 16
    assert landed["users"].count() <= users.count() + 2 * 16
    joined = enrich_sessions(landed["sessions"], landed["users"], spread_missing=False)
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        want = enrich_sessions(sessions, users)
        assert joined.columns == want.columns
        assert joined.exceptAll(want).count() == want.exceptAll(joined).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
    spark.sql("DROP DATABASE wp_hot CASCADE")
