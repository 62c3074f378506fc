"""The full run: raw tables to staging, marts, checks and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayrate.functions.churn import INACTIVE_DAYS
from stayrate.operators.cohorts import churn_cohort, churn_cohort_stacked, transaction_summary
from stayrate.operators.quality import quality_report, stopping
from stayrate.operators.rollups import user_summary
from stayrate.operators.staging import stage
from stayrate.sources.raw import read_raw
from stayrate.sources.sinks import (
    export_marts,
    materialise,
    publish_view,
    verify_contents,
    verify_outputs,
)


def lazy_marts(
    staged: dict[str, DataFrame], as_of, inactive_days: int = INACTIVE_DAYS
) -> dict[str, DataFrame]:
    """The staging tables and marts by name, defined only: nothing is written or published."""
    summary = user_summary(**staged, as_of=as_of, inactive_days=inactive_days)
    cohort = churn_cohort(summary)
    return {f"stg_{name}": df for name, df in staged.items()} | {
        "mart_user_summary": summary,
        "mart_churn_cohort": cohort,
        "mart_churn_cohort_stacked": churn_cohort_stacked(cohort),
        "mart_transaction_summary": transaction_summary(staged["transactions"]),
    }


def build_marts(
    raw: dict[str, DataFrame], folder: str, as_of, inactive_days: int = INACTIVE_DAYS
) -> dict[str, DataFrame]:
    """Staging as views, marts as Parquet tables below ``folder``; returns all by name.

    The user mart is written once and read back by everything that needs it; the stacked cohort
    comes from the written cohort.
    """
    staged = stage(raw)
    tables = {f"stg_{name}": publish_view(f"stg_{name}", df) for name, df in staged.items()}

    def mart(name: str, df: DataFrame) -> DataFrame:
        tables[name] = materialise(name, df, folder)
        return tables[name]

    summary = mart("mart_user_summary", user_summary(**staged, as_of=as_of, inactive_days=inactive_days))
    cohort = mart("mart_churn_cohort", churn_cohort(summary))
    mart("mart_churn_cohort_stacked", churn_cohort_stacked(cohort))
    mart("mart_transaction_summary", transaction_summary(staged["transactions"]))
    return tables


def marts_only(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: df for name, df in tables.items() if name.startswith("mart_")}


def run(
    spark: SparkSession,
    raw_folder: str,
    mart_folder: str,
    export_folder: str,
    as_of,
    inactive_days: int = INACTIVE_DAYS,
    fmt: str = "csv",
) -> dict[str, DataFrame]:
    """Read, build, check, export and verify.

    A failed check stops the run before the export, unless it only reports (``quality.REPORTED``).
    The exports must hold the rows of the marts, value by value.
    """
    tables = build_marts(read_raw(spark, raw_folder, fmt), mart_folder, as_of, inactive_days)
    failed = stopping(quality_report(tables, inactive_days)).collect()
    if failed:
        names = ", ".join(f"{r.check_name} ({r.violations})" for r in failed)
        raise ValueError(f"quality checks failed: {names}")
    exports = export_marts(marts_only(tables), export_folder)
    verify_outputs(spark, exports)
    verify_contents(spark, exports, marts_only(tables))
    return tables
