"""Plan invariants for scale: no cartesian / nested-loop joins, pruned scans."""

import re

import pytest

import __spark_entry__ as E

from sf_dirs import SF

KEYS = [
    "avg_balance_by_job", "group_rates", "crosstab_contact_y", "top_jobs_profile", "balance_anomalies",
    "iqr_outliers", "histogram_balance", "threshold_table", "classification_report", "subgroup_audit",
    "ranking_metrics", "lift_table", "mann_whitney_balance", "chi_square_contact_y", "quality_summary",
]


@pytest.mark.parametrize("key", KEYS)
def test_no_cartesian_and_pruned_scan(spark, key):
    df = E.queries()[key](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", plan), key
    formatted = df._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    widths = [s.count(":") for s in re.findall(r"ReadSchema: struct<([^>]*)>", formatted)]
    # reports read a few columns of the 18-column contacts table, never all of it
    assert all(w < 18 for w in widths), (key, widths)
