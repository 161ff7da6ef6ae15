"""Random small inputs: the Spark operators against a plain-Python brute force written from the
metric definitions with Decimal half-up arithmetic (independent of the integer-unit formulas)."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.fixtures import daily_rows, frames, session
from workpulse.operators.daily import daily_user_metrics
from workpulse.operators.engagement import add_active_days_l7d
from workpulse.operators.enrich import enrich_sessions
from workpulse.operators.ranks import add_productivity_ranks
from workpulse.operators.trends import add_trends

START = dt.date(2025, 8, 1)
CLASS = {"APP001": "productive", "APP012": "neutral", "APP026": "unproductive", "APP099": None}
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])


def half_up(x: Decimal, places: int) -> Decimal:
    return x.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def dec(x: float) -> Decimal:
    return Decimal(repr(x))


minutes = st.one_of(st.sampled_from([0.3, 0.99, 1.0, 22.57, 480.0, 480.01]),
                    st.integers(0, 60000).map(lambda c: c / 100))
activity = st.one_of(st.sampled_from([0.0, 70.0, 70.01, 100.0]),
                     st.integers(0, 10000).map(lambda c: c / 100))
session_rows = st.lists(
    st.tuples(st.sampled_from(["USR0001", "USR0002", "USR0003"]), st.integers(0, 20), minutes, activity,
              st.sampled_from(sorted(CLASS)), st.sampled_from(["PRJ001", None])),
    min_size=1, max_size=40)


@SETTINGS
@given(rows=session_rows)
def test_daily_rollup_matches_brute_force(spark, rows):
    account = {"USR0001": "ACC001", "USR0002": "ACC001", "USR0003": "ACC002"}
    sessions = [session(f"S{i}", user=u, account=account[u], day=START + dt.timedelta(days=d), minutes=m,
                        activity=a, app=app, project=p)
                for i, (u, d, m, a, app, p) in enumerate(rows)]
    f = frames(spark, sessions)
    got = {(r["user_id"], r["date"]): r for r in daily_user_metrics(
        enrich_sessions(f["sessions"], f["users"], f["accounts"], f["apps"], f["projects"])).collect()}

    groups = defaultdict(list)
    for u, d, m, a, app, p in rows:
        groups[(u, START + dt.timedelta(days=d))].append((dec(m), dec(a), CLASS[app], app, p))
    assert set(got) == set(groups)
    for key, items in groups.items():
        valid = [x for x in items if Decimal(1) <= x[0] <= Decimal(480)]
        hours = [half_up(m / 60, 2) for m, *_ in valid]
        total = sum(hours, Decimal(0))
        productive = sum((h for h, x in zip(hours, valid) if x[2] == "productive"), Decimal(0))
        idle = sum((half_up(m / 60 * (1 - a / 100), 2) for m, a, *_ in valid), Decimal(0))
        r = got[key]
        assert r["total_sessions"] == len(items) and r["valid_sessions"] == len(valid)
        assert r["unique_apps_used"] == len({x[3] for x in items})
        assert r["unique_projects"] == len({x[4] for x in items if x[4] is not None})
        assert Decimal(repr(r["total_hours"])) == total
        assert Decimal(repr(r["productive_hours"])) == productive
        assert Decimal(repr(r["idle_hours"])) == idle
        if valid:
            mean = sum((a for _, a, *_ in valid), Decimal(0)) / len(valid)
            assert Decimal(repr(r["avg_activity_pct"])) == half_up(mean, 2)
        else:
            assert r["avg_activity_pct"] is None
        if total > 0:
            assert Decimal(repr(r["idle_ratio_pct"])) == half_up(idle / total * 100, 2)
            assert Decimal(repr(r["productivity_pct"])) == half_up(productive / total * 100, 2)
            assert r["is_high_idle_day"] == int(idle / total > Decimal("0.30"))
        else:
            assert (r["idle_ratio_pct"], r["productivity_pct"], r["is_high_idle_day"]) == (0.0, 0.0, 0)
        assert r["is_active_day"] == int(total > 0)


daily_inputs = st.lists(
    st.tuples(st.sampled_from(["U1", "U2", None]), st.sampled_from(["A", "B"]), st.integers(0, 40),
              st.integers(0, 1200).map(lambda c: c / 100), st.integers(0, 800).map(lambda c: c / 100)),
    min_size=1, max_size=30, unique_by=lambda t: (t[0], t[1], t[2]))


@SETTINGS
@given(rows=daily_inputs)
def test_l7d_trends_and_ranks_match_brute_force(spark, rows):
    data = [(START + dt.timedelta(days=d), u, a, total, prod) for u, a, d, total, prod in rows]
    df = daily_rows(spark, data)
    out = add_productivity_ranks(add_trends(add_active_days_l7d(df))).collect()
    got = {(r["user_id"], r["account_id"], r["date"]): r for r in out}
    assert len(got) == len(data)

    active_days = defaultdict(set)
    for date, u, a, total, prod in data:
        if total > 0 and u is not None:
            active_days[u].add(date)
    series = defaultdict(list)
    for date, u, a, total, prod in data:
        series[u].append((date, a, dec(total)))
    groups = defaultdict(list)
    for date, u, a, total, prod in data:
        groups[(a, date)].append(dec(prod))

    for (u, a, date), r in got.items():
        want = 0 if u is None else sum(1 for d in active_days[u] if date - dt.timedelta(days=6) <= d <= date)
        assert r["active_days_l7d"] == want
        rows_u = sorted(series[u])
        i = next(k for k, x in enumerate(rows_u) if x[0] == date and x[1] == a)
        lag = rows_u[i - 7][2] if i >= 7 else None
        assert (None if r["total_hours_last_week"] is None else dec(r["total_hours_last_week"])) == lag
        if lag is not None and lag > 0:
            change = (rows_u[i][2] - lag) / lag * 100
            want_change = change.copy_sign(1).quantize(Decimal("0.01"), ROUND_HALF_UP).copy_sign(change)
            assert Decimal(repr(r["wow_change_pct"])) == want_change
        else:
            assert r["wow_change_pct"] is None
        window7 = [x[2] for x in rows_u[max(0, i - 6):i + 1]]
        assert Decimal(repr(r["total_hours_7d_avg"])) == half_up(sum(window7) / len(window7), 2)
        window30 = [x[2] for x in rows_u[max(0, i - 29):i + 1]]
        assert Decimal(repr(r["total_hours_30d_avg"])) == half_up(sum(window30) / len(window30), 2)
        values = groups[(a, date)]
        mine = dec(r["productive_hours"])
        assert r["productivity_rank"] == 1 + sum(1 for v in values if v > mine)
        below, n = sum(1 for v in values if v < mine), len(values)
        pr = Decimal(below) / (n - 1) if n > 1 else Decimal(0)
        assert Decimal(repr(r["productivity_percentile"])) == half_up(pr, 3)


activity_days = st.lists(
    st.tuples(st.sampled_from(["U1", "U2", "U3", "U4"]), st.sampled_from(["A", "B"]), st.integers(0, 120)),
    min_size=1, max_size=40, unique=True)


@SETTINGS
@given(rows=activity_days)
def test_retention_cohorts_match_brute_force(spark, rows):
    from workpulse.operators.cohorts import retention_cohorts

    data = [(START + dt.timedelta(days=d), u, a, 1.0) for u, a, d in rows]
    got = {(r["cohort_week"], r["account_id"], r["weeks_since_cohort"]): r
           for r in retention_cohorts(daily_rows(spark, data)).collect()}

    def monday(d):
        return d - dt.timedelta(days=d.weekday())

    weeks = defaultdict(set)
    for date, u, a, _ in data:
        weeks[(u, a)].add(monday(date))
    cells = defaultdict(set)
    for (u, a), ws in weeks.items():
        first = min(ws)
        for w in ws:
            k = (w - first).days // 7
            if k <= 12:
                cells[(first, a, k)].add(u)
    assert set(got) == set(cells)
    for (cw, a, k), users in cells.items():
        r = got[(cw, a, k)]
        size = len(cells[(cw, a, 0)])
        assert (r["retained_users"], r["cohort_size"]) == (len(users), size)
        assert Decimal(repr(r["retention_pct"])) == half_up(Decimal(len(users) * 100) / size, 2)
        earlier = [j for j in range(k) if (cw, a, j) in cells]
        if earlier:
            diff = Decimal((len(users) - len(cells[(cw, a, max(earlier))])) * 100) / size
            want = abs(diff).quantize(Decimal("0.01"), ROUND_HALF_UP).copy_sign(diff)
            assert Decimal(repr(r["retention_drop_pct"])) == want
        else:
            assert r["retention_drop_pct"] is None


@SETTINGS
@given(rows=session_rows)
def test_app_productivity_matches_brute_force(spark, rows):
    from workpulse.operators.apps import app_productivity

    account = {"USR0001": "ACC001", "USR0002": "ACC001", "USR0003": "ACC002"}
    sessions = [session(f"S{i}", user=u, account=account[u], day=START + dt.timedelta(days=d), minutes=m,
                        activity=a, app=app, project=p)
                for i, (u, d, m, a, app, p) in enumerate(rows)]
    f = frames(spark, sessions)
    e = enrich_sessions(f["sessions"], f["users"], f["accounts"], f["apps"], f["projects"])
    got = {(r["account_id"], r["date"], r["app_id"]): r for r in app_productivity(e, "2025-08-21", 90).collect()}

    cells = defaultdict(list)
    for u, d, m, a, app, p in rows:
        if Decimal(1) <= dec(m) <= Decimal(480):
            cells[(account[u], START + dt.timedelta(days=d), app)].append((u, dec(m)))
    assert set(got) == set(cells)
    hours = {k: sum((half_up(m / 60, 2) for _, m in v), Decimal(0)) for k, v in cells.items()}
    for (acct, day, app), items in cells.items():
        r = got[(acct, day, app)]
        assert (r["session_count"], r["unique_users"]) == (len(items), len({u for u, _ in items}))
        assert Decimal(repr(r["total_hours"])) == hours[(acct, day, app)]
        mean = sum((m for _, m in items), Decimal(0)) / len(items)
        assert Decimal(repr(r["avg_session_minutes"])) == half_up(mean, 1)
        peers = {k: h for k, h in hours.items() if k[0] == acct and k[1] == day}
        day_total = sum(peers.values(), Decimal(0))
        mine = hours[(acct, day, app)]
        if day_total > 0:
            assert Decimal(repr(r["pct_of_total_time"])) == half_up(mine / day_total * 100, 2)
        else:
            assert r["pct_of_total_time"] is None
        order = sorted(peers, key=lambda k: (-peers[k], k[2]))
        assert r["overall_rank"] == order.index((acct, day, app)) + 1
        same_class = [k for k in order if CLASS[k[2]] == CLASS[app]]
        assert r["rank_in_classification"] == same_class.index((acct, day, app)) + 1


metric_days = st.lists(
    st.tuples(st.sampled_from(["U1", "U2", "U3", "U4", "U5"]), st.sampled_from(["A", "B"]), st.integers(0, 30),
              st.integers(0, 900).map(lambda c: c / 100), st.integers(0, 900).map(lambda c: c / 100)),
    min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1], t[2]))


@SETTINGS
@given(rows=metric_days, as_of_day=st.integers(0, 35))
def test_metrics_match_brute_force(spark, rows, as_of_day):
    from workpulse.operators.metrics import account_churn_risk, active_users_l7d, avg_productive_hours

    as_of = START + dt.timedelta(days=as_of_day)
    data = [(START + dt.timedelta(days=d), u, a, total, prod) for u, a, d, total, prod in rows]
    df = daily_rows(spark, data)
    active = [(d, u, a) for d, u, a, total, _ in data if total > 0]
    in_l7d = [(d, u, a) for d, u, a in active if as_of - dt.timedelta(days=6) <= d <= as_of]

    got = {(r["scope"], r["account_id"]): r["active_users"] for r in active_users_l7d(df, as_of).collect()}
    want = {("account", a): len({u for _, u, x in in_l7d if x == a}) for a in {a for _, _, a in in_l7d}}
    if in_l7d:
        want[("all", None)] = len({u for _, u, _ in in_l7d})
    assert got == want

    churn = {r["account_id"]: r for r in account_churn_risk(df, as_of).collect()}
    last = {}
    for d, u, a in active:
        if d <= as_of:
            last[(a, u)] = max(d, last.get((a, u), d))
    assert set(churn) == {a for a, _ in last}
    for acct, r in churn.items():
        ever = [d for (a, _), d in last.items() if a == acct]
        inactive = sum(1 for d in ever if d < as_of - dt.timedelta(days=6))
        share = Decimal(inactive) / len(ever)
        assert (r["ever_active_users"], r["inactive_l7d_users"]) == (len(ever), inactive)
        assert Decimal(repr(r["churn_pct"])) == half_up(share * 100, 2)
        want_risk = "High" if share >= Decimal("0.50") else "Medium" if share >= Decimal("0.25") else "Low"
        assert r["churn_risk"] == want_risk

    weekly = {(r["account_id"], r["period_start"]): r for r in avg_productive_hours(df).collect()}
    cells = defaultdict(lambda: (set(), Decimal(0)))
    for d, u, a, _, prod in data:
        users, total = cells[(a, d - dt.timedelta(days=d.weekday()))]
        cells[(a, d - dt.timedelta(days=d.weekday()))] = (users | {u}, total + dec(prod))
    assert set(weekly) == set(cells)
    for key, (users, total) in cells.items():
        r = weekly[key]
        assert (r["users"], Decimal(repr(r["productive_hours"]))) == (len(users), total)
        assert Decimal(repr(r["avg_productive_hours"])) == half_up(total / len(users), 2)


@SETTINGS
@given(rows=session_rows, first=st.integers(0, 10), span=st.integers(0, 20))
def test_utilization_matches_brute_force(spark, rows, first, span):
    from workpulse.operators.metrics import utilization_rate

    account = {"USR0001": "ACC001", "USR0002": "ACC001", "USR0003": "ACC002"}
    sessions = [session(f"S{i}", user=u, account=account[u], day=START + dt.timedelta(days=d), minutes=m,
                        activity=a, app=app, project=p)
                for i, (u, d, m, a, app, p) in enumerate(rows)]
    f = frames(spark, sessions)
    d = daily_user_metrics(enrich_sessions(f["sessions"], f["users"], f["accounts"], f["apps"], f["projects"]))
    lo, hi = START + dt.timedelta(days=first), START + dt.timedelta(days=first + span)
    got = {r["account_id"]: r for r in utilization_rate(d, f["users"], lo.isoformat(), hi.isoformat()).collect()}
    weekdays = sum(1 for i in range(span + 1) if (lo + dt.timedelta(days=i)).weekday() < 5)
    users_per_account = {"ACC001": 2, "ACC002": 2}  # tests.fixtures.USERS, 40 h/week each
    for acct, n in users_per_account.items():
        used = sum((half_up(dec(m) / 60, 2) for u, day, m, *_ in rows
                    if account[u] == acct and lo <= START + dt.timedelta(days=day) <= hi
                    and Decimal(1) <= dec(m) <= Decimal(480)), Decimal(0))
        capacity = Decimal(n * 40 * weekdays) / 5
        r = got[acct]
        assert Decimal(repr(r["used_hours"])) == used and Decimal(repr(r["capacity_hours"])) == capacity
        if capacity > 0:
            assert Decimal(repr(r["utilization_pct"])) == half_up(used / capacity * 100, 2)
        else:
            assert r["utilization_pct"] is None


@SETTINGS
@given(rows=session_rows, as_of_day=st.integers(0, 25))
def test_engagement_distribution_and_allocation_match_brute_force(spark, rows, as_of_day):
    from workpulse.operators.allocation import project_allocation
    from workpulse.operators.metrics import engagement_distribution

    account = {"USR0001": "ACC001", "USR0002": "ACC001", "USR0003": "ACC002"}
    sessions = [session(f"S{i}", user=u, account=account[u], day=START + dt.timedelta(days=d), minutes=m,
                        activity=a, app=app, project=p)
                for i, (u, d, m, a, app, p) in enumerate(rows)]
    f = frames(spark, sessions)
    e = enrich_sessions(f["sessions"], f["users"], f["accounts"], f["apps"], f["projects"])
    valid = [(u, START + dt.timedelta(days=d), dec(m), p) for u, d, m, a, app, p in rows
             if Decimal(1) <= dec(m) <= Decimal(480)]

    # M2: every user of the dimension (4 users in the fixture), tier from active days in the last 7
    as_of = START + dt.timedelta(days=as_of_day)
    dist = {r["engagement_tier"]: r for r in engagement_distribution(
        daily_user_metrics(e), f["users"], as_of).collect()}
    days = {u: {d for x, d, _, _ in valid if x == u and as_of - dt.timedelta(days=6) <= d <= as_of}
            for u in ["USR0001", "USR0002", "USR0003", "USR0004"]}
    tiers = defaultdict(int)
    for n in (len(v) for v in days.values()):
        tiers["Highly Active" if n >= 5 else "Moderately Active" if n >= 3 else "Low Activity" if n >= 1
              else "Inactive"] += 1
    assert {k: r["users"] for k, r in dist.items()} == dict(tiers)
    for k, r in dist.items():
        assert Decimal(repr(r["pct_users"])) == half_up(Decimal(tiers[k] * 100) / 4, 2)

    # M7: valid sessions per (account, project), shares and rank inside the account
    got = {(r["account_id"], r["project_id"]): r for r in project_allocation(e).collect()}
    cells = defaultdict(list)
    for u, _, m, p in valid:
        cells[(account[u], p)].append((u, half_up(m / 60, 2)))
    assert set(got) == set(cells)
    hours = {k: sum((h for _, h in v), Decimal(0)) for k, v in cells.items()}
    for (acct, proj), items in cells.items():
        r = got[(acct, proj)]
        mine = hours[(acct, proj)]
        acct_total = sum((h for k, h in hours.items() if k[0] == acct), Decimal(0))
        assert (r["session_count"], r["unique_users"]) == (len(items), len({u for u, _ in items}))
        assert r["project_name"] == ("unallocated" if proj is None else "Harbour Survey")
        if acct_total > 0:
            assert Decimal(repr(r["pct_of_account_hours"])) == half_up(mine / acct_total * 100, 2)
        else:
            assert r["pct_of_account_hours"] is None
        if proj is None:
            assert r["pct_of_budget"] is None
        else:
            assert Decimal(repr(r["pct_of_budget"])) == half_up(mine / 100 * 100, 2)
        assert r["project_rank"] == 1 + sum(1 for k, h in hours.items() if k[0] == acct and h > mine)
