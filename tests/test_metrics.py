"""Hand-computed answers for the headline metrics and project allocation."""

from __future__ import annotations

import datetime as dt

from tests.fixtures import D, daily_rows, frames, session
from workpulse.operators.allocation import project_allocation
from workpulse.operators.cohorts import retention_cohorts
from workpulse.operators.daily import daily_user_metrics
from workpulse.operators.enrich import enrich_sessions
from workpulse.operators.metrics import (
    account_churn_risk,
    active_users_l7d,
    avg_productive_hours,
    utilization_rate,
    weekdays_between,
    weekly_retention_rate,
)

AS_OF = D(2025, 8, 31)  # a Sunday


def test_active_users_per_account_and_overall(spark):
    rows = [(AS_OF, "U1", "A", 1.0), (AS_OF - dt.timedelta(days=6), "U1", "B", 1.0),
            (AS_OF - dt.timedelta(days=7), "U2", "A", 1.0), (AS_OF, "U3", "B", 0.0)]
    out = {(r["scope"], r["account_id"]): r["active_users"]
           for r in active_users_l7d(daily_rows(spark, rows), AS_OF).collect()}
    # U1 counted in A and B but once overall; U2 is 7 days back; U3 has no active day
    assert out == {("account", "A"): 1, ("account", "B"): 1, ("all", None): 1}


def test_churn_bands(spark):
    old = AS_OF - dt.timedelta(days=20)
    rows = []
    # account A: 2 of 4 inactive -> 50 % High; B: 1 of 4 -> 25 % Medium; C: 1 of 5 -> Low
    for acct, n, inactive in (("A", 4, 2), ("B", 4, 1), ("C", 5, 1)):
        for i in range(n):
            day = old if i < inactive else AS_OF - dt.timedelta(days=6)
            rows.append((day, f"{acct}{i}", acct, 1.0))
    rows.append((AS_OF + dt.timedelta(days=1), "C9", "C", 1.0))  # after as_of: ignored
    out = {r["account_id"]: r for r in account_churn_risk(daily_rows(spark, rows), AS_OF).collect()}
    assert (out["A"]["churn_pct"], out["A"]["churn_risk"]) == (50.0, "High")
    assert (out["B"]["churn_pct"], out["B"]["churn_risk"]) == (25.0, "Medium")
    assert (out["C"]["ever_active_users"], out["C"]["churn_pct"], out["C"]["churn_risk"]) == (5, 20.0, "Low")


def test_retention_rate_counts_only_cohorts_that_reached_the_week(spark):
    # cohort 1 starts 2025-08-04 (weeks 0-3 started by as_of), 2 users; cohort 2 starts 2025-08-25
    c1, c2 = D(2025, 8, 4), D(2025, 8, 25)
    rows = [(c1, "U1", "A", 1.0), (c1, "U2", "A", 1.0), (c1 + dt.timedelta(weeks=1), "U1", "A", 1.0),
            (c2, "U3", "A", 1.0)]
    out = {r["weeks_since_cohort"]: r for r in
           weekly_retention_rate(retention_cohorts(daily_rows(spark, rows)), AS_OF).collect()}
    assert (out[0]["cohorts"], out[0]["cohort_users"], out[0]["retained_users"]) == (2, 3, 3)
    # week 1: only cohort 1 has reached it (cohort 2's week 1 starts 2025-09-01 > as_of)
    assert (out[1]["cohorts"], out[1]["cohort_users"], out[1]["retained_users"]) == (1, 2, 1)
    assert out[1]["retention_rate_pct"] == 50.0
    assert sorted(out) == [0, 1, 2, 3]  # cohort 1's week 4 starts 2025-09-01, after as_of
    assert out[3]["retained_users"] == 0 and out[3]["retention_rate_pct"] == 0.0


def test_weekdays_and_utilization(spark):
    assert weekdays_between(dt.date(2024, 1, 1), dt.date(2024, 1, 30)) == 22
    assert weekdays_between(dt.date(2025, 8, 2), dt.date(2025, 8, 3)) == 0
    f = frames(spark, [session("S1", minutes=480.0), session("S2", minutes=240.0, day=D(2025, 8, 5))])
    d = daily_user_metrics(enrich_sessions(f["sessions"], f["users"], f["accounts"], f["apps"], f["projects"]))
    out = {r["account_id"]: r for r in utilization_rate(d, f["users"], "2025-08-04", "2025-08-08").collect()}
    # ACC001: 2 users x 40 h / 5 x 5 weekdays = 80 h capacity, 12 h used
    assert (out["ACC001"]["users"], out["ACC001"]["capacity_hours"], out["ACC001"]["used_hours"]) == (2, 80.0, 12.0)
    assert out["ACC001"]["utilization_pct"] == 15.0
    assert (out["ACC002"]["used_hours"], out["ACC002"]["utilization_pct"]) == (0.0, 0.0)


def test_avg_productive_hours_per_week(spark):
    mon = D(2025, 8, 4)
    rows = [(mon, "U1", "A", 3.0, 3.0), (mon + dt.timedelta(days=6), "U1", "A", 2.0, 1.0),
            (mon, "U2", "A", 2.0, 0.5), (mon + dt.timedelta(days=7), "U2", "A", 1.0, 1.0)]
    out = {(r["account_id"], r["period_start"]): r for r in avg_productive_hours(daily_rows(spark, rows)).collect()}
    wk = out[("A", mon)]
    assert (wk["users"], wk["productive_hours"], wk["avg_productive_hours"]) == (2, 4.5, 2.25)
    assert out[("A", mon + dt.timedelta(days=7))]["users"] == 1


def test_project_allocation(spark):
    rows = [session("S1", minutes=120.0, project="PRJ001"), session("S2", minutes=60.0, project=None),
            session("S3", minutes=60.0, project="PRJ002", user="USR0002"),
            session("S4", minutes=600.0, project="PRJ002")]  # invalid: too long
    f = frames(spark, rows)
    e = enrich_sessions(f["sessions"], f["users"], f["accounts"], f["apps"], f["projects"])
    out = {r["project_name"]: r for r in project_allocation(e).collect()}
    assert out["Harbour Survey"]["total_hours"] == 2.0
    assert out["Harbour Survey"]["pct_of_account_hours"] == 50.0
    assert out["Harbour Survey"]["pct_of_budget"] == 2.0  # 2 h of 100
    assert out["Harbour Survey"]["project_rank"] == 1
    assert out["unallocated"]["project_id"] is None and out["unallocated"]["project_rank"] == 2
    assert out["Bridge Audit"]["session_count"] == 1 and out["Bridge Audit"]["project_rank"] == 2
    assert out["Bridge Audit"]["pct_of_budget"] == 2.0  # 1 h of 50
