"""Duplicate removal: exact whatever the filter lets through, and few rows move."""

from __future__ import annotations

import random

import pytest

from workpulse.operators.quality import dedupe_sessions, duplicate_sessions, id_filter


def _sessions(spark, n=4000):
    rng = random.Random(2)
    rows = [(f"S{i}", rng.randrange(5), None) for i in range(n)]
    rows += [(f"S{i}", rng.randrange(5), "copy") for i in range(0, n, 100)] + [("S7", 9, "x")] * 900 + [(None, 3, None), (None, 1, "y")]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "session_id string, user_id int, note string").repartition(6), rows


def _want(rows):
    best = {}
    low = lambda r: tuple((v is not None, v) for v in r[1:])
    for r in rows:
        if r[0] not in best or low(r) < low(best[r[0]]):
            best[r[0]] = r
    return sorted(best.values(), key=str)


@pytest.mark.parametrize("bits", [64, 1 << 12, 1 << 20])  # nothing, much and hardly anything is let through
def test_exact_with_any_filter(spark, bits):
    df, rows = _sessions(spark)
    assert sorted(map(tuple, dedupe_sessions(df, filter_bits=bits).collect()), key=str) == _want(rows)


def test_filter_has_every_repeated_id_and_few_others(spark):
    df, rows = _sessions(spark)
    repeated = duplicate_sessions(df).select("session_id")
    got = {r["session_id"]: r["m"] for r in df.select("session_id", id_filter(repeated, "session_id", 1 << 14).alias("m")).collect()}
    held = {r["session_id"] for r in repeated.collect()}
    assert all(got[i] for i in held)
    assert sum(got.values()) - len(held) < 0.02 * len(got)


def test_only_possible_copies_are_shuffled(spark):
    """Whole rows pass an exchange only behind the filter; the other exchange carries ids."""
    df, _ = _sessions(spark)
    folder = spark.conf.get("spark.sql.warehouse.dir") + "/dedupe-input"
    df.write.mode("overwrite").parquet(folder)
    out = dedupe_sessions(spark.read.parquet(folder))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("Subqueries")[0]
    assert "Join" not in plan.split("Subquery")[0]
    moved = [x for x in plan.splitlines() if "Exchange hashpartitioning(session_id" in x]
    assert moved and plan.count("Union") == 1


def test_empty(spark):
    df, _ = _sessions(spark, 10)
    assert dedupe_sessions(df.where("false")).count() == 0
