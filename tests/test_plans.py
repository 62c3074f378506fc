"""Properties of the physical plans that decide how the operators scale."""

import os
import re

import pytest

import __spark_entry__ as entry_module
from conftest import TESTDATA
from stayrate.operators import rollups, skew, staging
from stayrate.sources import star

SF = os.path.join(TESTDATA, "sf0.001")
# write files while they are defined, as reading them back is what they are about
WRITES = {
    "exported_marts", "export_digest", "csv_users", "csv_transactions", "csv_events", "sketch_errors",
    "bucketed_user_summary", "incremental_rollup", "streamed_events_once", "streamed_lapses",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The plan after adaptive execution."""
    query = df._jdf.queryExecution()
    query.executedPlan().executeCollect()
    return query.executedPlan().toString().split("\n+- == Initial Plan ==")[0]


def scans(text, table):
    """Scans of one of the Parquet tables."""
    return len(re.findall(rf"FileScan parquet .*{table}\.parquet", text))


@pytest.fixture(scope="module")
def tables(spark):
    return entry_module.Tables(spark, SF)


@pytest.mark.parametrize("name", sorted(set(entry_module._QUERIES) - WRITES))
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(entry_module.queries()[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "MapPartitions"):
        assert node not in text


def test_summary_reads_events_once(tables):
    text = plan(tables.summary)
    assert scans(text, "events") == 1
    assert text.count("Window") == 0


def test_stacked_cohort_costs_no_extra_scan(tables):
    cohort = plan(tables.cohort)
    stacked = plan(entry_module.cohorts.churn_cohort_stacked(tables.cohort))
    for table in ("events", "orders", "customer"):
        assert scans(cohort, table) >= scans(stacked, table)


def test_only_used_columns_are_read(tables):
    text = plan(entry_module.segments.value_counts(tables.tx, "product"))
    assert "ReadSchema: struct<o_orderstatus:string>" in text


def test_profile_lookup_reaches_every_scan(tables):
    text = plan(rollups.user_profile(tables.summary, 42))
    keys = {"customer": "c_custkey", "orders": "o_custkey", "events": "user_id"}
    for table, key in keys.items():
        lines = [x for x in text.splitlines() if f"{table}.parquet" in x]
        assert lines and all(f"EqualTo({key},42)" in x for x in lines)


def test_ingest_window_is_pushed_down(spark, tables, tmp_path):
    path = str(tmp_path / "events")
    tables.events.write.parquet(path)
    text = plan(staging.ingest_window(spark.read.parquet(path), "2024-01-31", 5))
    assert "GreaterThanOrEqual(event_date,2024-01-26)" in text


def test_funnel_without_hot_users_shuffles_once(tables):
    steps = [("Login", 0), ("View_Portfolio", 1), ("Deposit", 2)]
    text = final_plan(entry_module.funnel.step_times(tables.events, steps))
    assert "Union" not in text  # the hot branch is gone
    assert scans(text, "events") == 1
    assert text.count("Exchange hashpartitioning(user_id") == 1


def test_lookup_reads_facts_once(spark, tables):
    events = star.read_star(spark, SF, "events").select("event_id", "user_id")
    users = tables.users.select("user_id", "account_type")
    text = final_plan(skew.attach(events, users, "user_id"))
    assert scans(text, "events") == 1 and "Union" not in text


def test_hot_keys_count_once(spark):
    """The threshold's total comes from the shuffle the counts come from."""
    events = star.read_star(spark, SF, "events")
    text = final_plan(skew.hot_keys(events, "user_id", 1))
    assert text.count("ColumnarToRow") == 1 and "ReusedExchange" in text


def test_hot_keys_are_bounded(spark, monkeypatch):
    events = star.read_star(spark, SF, "events")
    monkeypatch.setattr(skew, "MAX_HOT_KEYS", 14)
    assert 0 < skew.hot_keys(events, "user_id", 1).count() <= 14


def test_paths_shuffle_users_once(tables):
    """The window's partitioning also serves the count per user and path."""
    text = final_plan(entry_module.paths.paths_to(tables.events, ["Withdrawal"], 3))
    assert "Union" not in text
    assert re.findall(r"Exchange hashpartitioning\((\w+)#\d+L?, 8\)", text) == ["path", "user_id"]


def test_combinations_read_events_once(tables):
    text = final_plan(
        entry_module.segments.segment_combinations(tables.events, tables.users, ("platform", "account_type"))
    )
    assert scans(text, "events") == 1 and text.count("Expand") == 1


def test_paths_run_no_job_when_they_are_defined(spark, tables):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("defined", "")
    entry_module.paths.paths_to(tables.events, ["Withdrawal"], 3)
    entry_module.quality.quality_report(tables.lazy())
    found = tracker.getJobIdsForGroup("defined")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(found) == []
