"""Write PLANS.md: physical plans (Spark's own explain output) of the main operators at sf0.1.

Usage: python -m tests.dump_plans [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import re
import sys
import tempfile

sys.path.insert(0, ".")

from __spark_entry__ import queries  # noqa: E402
from workpulse.operators.apps import app_productivity  # noqa: E402
from workpulse.operators.daily import daily_user_metrics  # noqa: E402
from workpulse.operators.user_activity import user_activity_metrics  # noqa: E402
from workpulse.plans.catalog import AS_OF, LOOKBACK_DAYS, enriched  # noqa: E402
from workpulse.session import get_spark  # noqa: E402
from workpulse.sources import publish_table  # noqa: E402


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = re.sub(r"#\d+L?", "", buf.getvalue())  # expression ids only add noise
    text = re.sub(r", \[plan_id=\d+\]", "", text)
    text = re.sub(r"file:/\S+?/(\w+\.parquet|staging_\w+)", r"\1", text)
    width = 220
    return "\n".join(line if len(line) <= width else line[:width] + " ..."
                     for line in text.strip().splitlines())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_spark(master="local[8]", shuffle_partitions=16)
    out = tempfile.mkdtemp(prefix="wp-plans-", dir="/tmp")
    publish_table(enriched(spark, sf_dir), f"{out}/staging_enriched_sessions", "staging_enriched_sessions")
    e = spark.read.parquet(f"{out}/staging_enriched_sessions")
    publish_table(daily_user_metrics(e), f"{out}/staging_daily_user_metrics", "staging_daily_user_metrics")
    d = spark.read.parquet(f"{out}/staging_daily_user_metrics")
    sections = [
        ("Daily rollup from the published enriched table (layer rebuild)", daily_user_metrics(e)),
        ("User activity from the published daily table (layer rebuild)",
         user_activity_metrics(d, AS_OF, LOOKBACK_DAYS)),
        ("App productivity from the published enriched table (layer rebuild)",
         app_productivity(e, AS_OF, LOOKBACK_DAYS)),
    ] + [(f"Registered query `{q}` (from the raw test tables)", queries()[q](spark, sf_dir))
         for q in ("enriched_sessions", "daily_user_metrics", "retention_cohorts",
                   "dedupe_sessions", "project_allocation")]
    for q in ("productivity_rank", "user_activity_metrics"):
        ran = queries()[q](spark, sf_dir)
        ran.collect()  # which exchanges are shared is known once the plan has run
        sections.append((f"Registered query `{q}`, as it ran (one scan of the events, one reused exchange)", ran))
    lines = ["# Physical plans", "",
             f"Spark's `explain()` output at `{sf_dir}` (AQE initial plans: sort-merge joins over small",
             "sides become broadcast joins at run time; `SubqueryAdaptiveBroadcast dynamicpruning` entries",
             "are dropped at run time when no broadcast can be reused). Expression ids, file paths and",
             "long lines are shortened.", ""]
    for title, df in sections:
        lines += [f"## {title}", "", "```", plan(df), "```", ""]
    with open("PLANS.md", "w") as f:
        f.write("\n".join(lines))
    spark.stop()


if __name__ == "__main__":
    main()
