"""Distinct users from stored bitmaps against plain sets."""

from __future__ import annotations

import collections
import datetime as dt
import random

from workpulse.operators.distinct import (
    active_users_by_day,
    distinct_users,
    number_users,
    productive_hours_by_period,
    user_bitmaps,
)
from workpulse.operators.metrics import active_users_l7d, avg_productive_hours

FIRST = dt.date(2024, 2, 20)


def _daily(spark, n=2500, text=False):
    rng = random.Random(6)
    # ids far apart, negative ids, a missing user, account and date; one user of many accounts; a hot account
    ids = [None, -3, -40_000, 0, 1, 32_768, 32_769, 65_536, 10**12, *range(100, 160)]
    rows = []
    for _ in range(n):
        user = rng.choice(ids)
        rows.append((None if rng.random() < 0.02 else FIRST + dt.timedelta(rng.randrange(25)),
                     f"u{user}" if text and user is not None else user,
                     rng.choice(["a", "a", "a", "b", None]), int(rng.random() < 0.6), rng.randrange(500) / 100))
    kind = "string" if text else "bigint"
    return spark.createDataFrame(rows, f"date date, user_id {kind}, account_id string, is_active_day int, productive_hours double")


def _rows(df, columns=None):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=str)


def test_any_reporting_day(spark):
    daily = _daily(spark)
    got = collections.defaultdict(list)
    for r in active_users_by_day(user_bitmaps(daily)).collect():
        got[r["as_of"]].append((r["scope"], r["account_id"], r["active_users"]))
    assert len(got) == 25
    for day in (FIRST, FIRST + dt.timedelta(9), FIRST + dt.timedelta(24)):
        assert sorted(got[day], key=str) == _rows(active_users_l7d(daily, day))


def test_any_period(spark):
    daily = _daily(spark)
    bitmaps = user_bitmaps(daily)
    for period in ("week", "month", "quarter"):
        assert _rows(productive_hours_by_period(bitmaps, period)) == _rows(avg_productive_hours(daily, period))


def test_bitmaps_of_days_merge(spark):
    """Bitmaps made day by day, each from that day's rows alone, give what one pass gives."""
    daily = _daily(spark)
    parts = [user_bitmaps(daily.where(f"date = '{FIRST + dt.timedelta(d)}'")) for d in range(25)]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    want = {(r["account_id"],): None for r in daily.select("account_id").distinct().collect()}
    sets = collections.defaultdict(set)
    for r in daily.where("date is not null and user_id is not null").collect():
        sets[r["account_id"]].add(r["user_id"])
    got = {r["account_id"]: r["users"] for r in distinct_users(whole, ["account_id"], "seen_users").collect()}
    assert got == {k: len(v) for k, v in sets.items()} and len(want) == 3


def test_text_ids_by_numbers_that_stay(spark):
    daily = _daily(spark, text=True)
    users = daily.select("user_id", "account_id").distinct()
    some = users.where("account_id = 'b'")
    first = number_users(some)
    both = number_users(users, former=first)
    n = {r["user_id"]: r["user_number"] for r in both.collect()}
    assert sorted(n.values()) == list(range(1, len(n) + 1)) and len(n) == daily.select("user_id").where("user_id is not null").distinct().count()
    assert all(n[r["user_id"]] == r["user_number"] for r in first.collect())
    got = _rows(active_users_by_day(user_bitmaps(daily, both)).where(f"as_of = '{FIRST + dt.timedelta(12)}'"), ["scope", "account_id", "active_users"])
    assert got == _rows(active_users_l7d(daily, FIRST + dt.timedelta(12)))


def test_empty(spark):
    bitmaps = user_bitmaps(_daily(spark).where("false"))
    assert active_users_by_day(bitmaps).count() == productive_hours_by_period(bitmaps).count() == 0
