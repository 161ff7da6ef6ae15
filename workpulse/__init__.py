"""workpulse: work-activity analytics as composable Spark DataFrame operators.

Layers (all ``DataFrame -> DataFrame``):

* ``sources``   raw schemas, CSV loading, table publishing, the test-data adapter
* ``functions`` column expressions: exact rounding, dates, flags, tiers
* ``operators`` enrich, daily rollup, trends, engagement, ranks, app productivity,
                retention cohorts, project allocation, metrics, data quality
* ``plans``     the staging/analytics layer rebuild and the registered query catalog
"""

from workpulse.operators.allocation import project_allocation
from workpulse.operators.apps import app_productivity
from workpulse.operators.cohorts import cohort_sizes, retention_cohorts, user_cohorts, weekly_activity
from workpulse.operators.daily import daily_user_metrics
from workpulse.operators.engagement import add_active_days_l7d, add_engagement
from workpulse.operators.enrich import enrich_sessions, session_flags, session_measures
from workpulse.operators.metrics import (
    account_churn_risk,
    active_users_l7d,
    avg_productive_hours,
    engagement_distribution,
    utilization_rate,
    weekly_retention_rate,
)
from workpulse.operators.quality import dedupe_sessions, duplicate_sessions, layer_summary, session_quality
from workpulse.operators.ranks import add_productivity_ranks
from workpulse.operators.trends import add_trends
from workpulse.operators.user_activity import user_activity_metrics
from workpulse.session import ensure_checkpoint_dir, get_spark, materialize

__all__ = [
    "account_churn_risk", "active_users_l7d", "add_active_days_l7d", "add_engagement",
    "add_productivity_ranks", "add_trends", "app_productivity", "avg_productive_hours",
    "cohort_sizes", "daily_user_metrics", "dedupe_sessions", "duplicate_sessions",
    "engagement_distribution", "enrich_sessions", "ensure_checkpoint_dir", "get_spark",
    "layer_summary", "materialize", "project_allocation", "retention_cohorts", "session_flags",
    "session_measures", "session_quality", "user_activity_metrics", "user_cohorts",
    "utilization_rate", "weekly_activity", "weekly_retention_rate",
]
