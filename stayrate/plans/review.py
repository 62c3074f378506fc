"""The review report: the metrics an analyst reads after a run, each as a small table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stayrate.operators.cohorts import cohort_at, flow_by_product_type
from stayrate.operators.segments import churn_by, headline, step_reach, value_counts
from stayrate.sources.sinks import MART_ORDER, preview

STEPS = ("Login", "View_Portfolio", "Deposit", "Withdrawal")


def review(tables: dict[str, DataFrame], months=()) -> dict[str, DataFrame]:
    """Report tables by title. ``tables`` as returned by the mart build."""
    summary, cohort = tables["mart_user_summary"], tables["mart_churn_cohort"]
    flows, events = tables["mart_transaction_summary"], tables["stg_events"]
    return {
        "headline": headline(summary),
        "churn_types": value_counts(summary, "churn_type"),
        "churn_by_age_group": churn_by(summary, "age_group"),
        "churn_by_channel": churn_by(summary, "acquisition_channel"),
        "churn_by_account_type": churn_by(summary, "account_type"),
        "churn_by_state": churn_by(summary, "state", top=10),
        "cohorts": cohort_at(cohort, *months) if months else cohort,
        "transaction_summary_head": preview(flows, 5, *MART_ORDER["mart_transaction_summary"]),
        "flow_by_product_type": flow_by_product_type(flows),
        "event_types": value_counts(events, "event_type"),
        "step_reach": step_reach(events, tables["stg_users"], "account_type", "Login", STEPS),
    }
