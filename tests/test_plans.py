"""Plan-shape regression guards for the registered queries (sf 0.001)."""
import re

import pytest

from allelic.plans.registry import queries
from tests.conftest import SF001

QS = queries()
# column-pruned scans instead of a shuffle or sort of the whole input: range and bin counts, rows and their total,
# newest times and the tail they reach, extremes per key and the rows that reach them, members of a trio,
# a sink's base and later partials
SCANS = {"metric_snapshot": 2, "position_histogram": 2, "boxplot_stats": 2, "family_stats": 2, "mutation_rate_history": 2, "latest_by_key": 2,
         "sample_first_per_batch": 2, "batch_metrics_sample": 3, "trio_join": 3, "mendelian_consistency": 3}
# these store range-sorted rows, or write a sink's partials, when they are called
EAGER = {"downsample_last_n", "task_time_series", "zscore_anomaly", "zscore_anomaly_readme", "chromosome_order", "metric_snapshot", "live_hotspots"}


@pytest.fixture
def static_plans(spark):
    # AQE applies exchange and subquery reuse only at run time; inspect the
    # static plan, where reuse is already visible
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", sorted(QS))
def test_raw_table_scanned_once(spark, static_plans, name):
    plan = QS[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    scans = len(re.findall(r"FileScan parquet", plan))
    assert scans <= SCANS.get(name, 1), f"{name} scans the input {scans} times"
    # no cartesian products or nested-loop joins anywhere
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_building_queries_runs_no_job(spark):
    sc = spark.sparkContext
    sc.setJobGroup("building", "no job may run")
    try:
        for name in sorted(set(QS) - EAGER):
            QS[name](spark, SF001)
            assert not sc.statusTracker().getJobIdsForGroup("building"), name
    finally:
        sc._jsc.clearJobGroup()


def test_histogram_exchanges(spark, static_plans):
    plan = QS["position_histogram"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange (?:hash|Single)", plan)) <= 3


def test_top_k_limits_groups_before_the_shuffle(spark, static_plans):
    plan = QS["hotspots_per_member"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit.*Partial", plan)


@pytest.mark.parametrize("name", ["latest_by_key", "batch_metrics_sample", "sample_first_per_batch", "trio_join",
                                  "mendelian_consistency", "genetic_similarity"])
def test_first_rows_sort_no_raw_rows(spark, static_plans, name):
    plan = QS[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "HashAggregate" in plan
