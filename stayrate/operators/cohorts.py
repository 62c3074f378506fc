"""Signup cohorts and the monthly transaction summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.functions import churn
from stayrate.functions.calendar import date_of, month_start
from stayrate.functions.numbers import cents, safe_rate, sum_cents, sum_money


def churn_cohort(summary: DataFrame) -> DataFrame:
    """Per signup month: users, churned, retained, and both churn kinds with their rates.

    A user can be Explicit without being churned, so the two kinds need not add up to churned.
    """
    counted = summary.groupBy(month_start(F.col("signup_date")).alias("cohort_month")).agg(
        F.count(F.lit(1)).alias("total_users"),
        F.sum("churned").alias("churned_users"),
        F.count_if(F.col("churn_type") == churn.EXPLICIT).alias("explicit_churners"),
        F.count_if(F.col("churn_type") == churn.SILENT).alias("silent_churners"),
    )
    total = F.col("total_users")
    return counted.select(
        "cohort_month",
        "total_users",
        "churned_users",
        (total - F.col("churned_users")).alias("retained_users"),
        safe_rate(F.col("churned_users"), total).alias("churn_rate_pct"),
        "explicit_churners",
        "silent_churners",
        safe_rate(F.col("explicit_churners"), total).alias("explicit_churn_rate_pct"),
        safe_rate(F.col("silent_churners"), total).alias("silent_churn_rate_pct"),
    )


def churn_cohort_stacked(cohort: DataFrame) -> DataFrame:
    """Two rows per cohort, Churned and Retained, each with the cohort's churn rate.

    An unpivot reads the cohort once; a union of two selects would compute it twice.
    """
    return cohort.select(
        "cohort_month",
        F.col("churned_users").alias("Churned"),
        F.col("retained_users").alias("Retained"),
        "churn_rate_pct",
    ).unpivot(["cohort_month", "churn_rate_pct"], ["Churned", "Retained"], "status", "users").select(
        "cohort_month", "status", "users", "churn_rate_pct"
    )


def cohort_at(cohort: DataFrame, *months) -> DataFrame:
    """The rows of chosen cohort months."""
    return cohort.where(F.col("cohort_month").isin([date_of(m) for m in months])).select(
        "cohort_month", "churn_rate_pct", "churned_users", "retained_users", "total_users"
    )


def transaction_summary(transactions: DataFrame) -> DataFrame:
    """Per month, product and type: count, deposited, withdrawn, round-ups and net flow."""
    amount = cents(F.col("amount_usd"))
    month = month_start(F.col("transaction_date")).alias("transaction_month")
    return transactions.groupBy(month, "product", "transaction_type").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        sum_cents(churn.deposited(amount)).alias("total_deposited"),
        sum_cents(churn.withdrawn(amount)).alias("total_withdrawn"),
        sum_money(F.col("round_up")).alias("total_round_ups"),
        sum_cents(amount).alias("net_flow"),
    )


def flow_by_product_type(tx_summary: DataFrame) -> DataFrame:
    """The summary with its months added up."""
    return tx_summary.groupBy("product", "transaction_type").agg(
        F.sum("transaction_count").alias("transaction_count"),
        sum_money(F.col("net_flow")).alias("net_flow"),
    )
