"""Data-quality checks. Each returns what violates it; an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.functions import churn
from stayrate.functions.calendar import date_of
from stayrate.functions.numbers import safe_rate
from stayrate.functions.transactions import ROUND_UP, WITHDRAWAL
from stayrate.operators.rollups import cancelled_users
from stayrate.operators.segments import facts_with

# The closed sets of values in the raw tables.
DOMAINS = {
    "users": {
        "acquisition_channel": ("Organic", "Referral", "Paid Social", "Email", "App Store"),
        "account_type": ("Banking", "Invest", "Both"),
        "state": ("CA", "TX", "NY", "FL", "IL", "WA", "CO", "GA", "OH", "AZ"),
        "age_group": ("18-24", "25-34", "35-44", "45-54", "55+"),
    },
    "transactions": {
        "transaction_type": ("Round-Up", "One-Time Deposit", "Recurring Deposit", "Withdrawal"),
        "product": ("Banking", "Invest"),
    },
    "events": {
        "event_type": (
            "Login", "Deposit", "Withdrawal", "View_Portfolio", "View_Statement", "Cancel_Account",
        ),
        "platform": ("iOS", "Android", "Web"),
    },
}

# Columns that must be unique or filled, per table.
UNIQUE = {
    "stg_users": "user_id",
    "stg_transactions": "transaction_id",
    "stg_events": "event_id",
    "mart_user_summary": "user_id",
}
NOT_NULL = {
    "stg_users": ("user_id", "signup_date", "acquisition_channel", "account_type"),
    "stg_transactions": ("transaction_id", "user_id", "transaction_date"),
    "stg_events": ("event_id", "user_id", "event_date"),
    "mart_user_summary": ("user_id",),
    "mart_churn_cohort": ("cohort_month",),
    "mart_churn_cohort_stacked": ("cohort_month",),
    "mart_transaction_summary": ("transaction_month",),
}


#: Checks by the start of their names that report and do not stop a run: facts of unknown users
#: are expected, count in the totals of all facts and drop out per user.
REPORTED = ("orphans:",)


def stopping(report: DataFrame) -> DataFrame:
    """The failed checks of a quality report that must stop a run."""
    reported = F.lit(False)
    for start in REPORTED:
        reported = reported | F.col("check_name").startswith(start)
    return report.where((F.col("status") == "fail") & ~reported)


def check_unique(df: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once; NULL keys are left to the not-null check."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where(F.col("n_rows") > 1)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its number of NULLs, all columns in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], list(columns), "column_name", "nulls")


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return null_counts(df, columns).where(F.col("nulls") > 0)


def explicit_without_cancel(summary: DataFrame, events: DataFrame) -> DataFrame:
    """Users labelled Explicit who have no cancellation event."""
    explicit = summary.where(F.col("churn_type") == churn.EXPLICIT)
    return explicit.join(cancelled_users(events), "user_id", "left_anti")


def check_churn_type(
    summary: DataFrame, events: DataFrame, inactive_days: int = churn.INACTIVE_DAYS
) -> DataFrame:
    """Users whose label contradicts the facts.

    A Silent user without any transaction has NULL days; that is a valid Silent label.
    """
    cancelled = cancelled_users(events).withColumn("cancelled", F.lit(True))
    label, days = F.col("churn_type"), F.col("days_since_last_transaction")
    issue = (
        F.when((label == churn.EXPLICIT) & F.col("cancelled").isNull(), "explicit_missing_event")
        .when((label == churn.SILENT) & (days <= inactive_days), "silent_too_recent")
        .when((label == churn.ACTIVE) & (F.col("churned") == 1), "active_marked_churned")
    )
    return (
        summary.join(cancelled, "user_id", "left")
        .withColumn("issue", issue)
        .where(F.col("issue").isNotNull())
        .select("user_id", "churn_type", "churned", "days_since_last_transaction", "issue")
    )


def check_churn_rate(cohort: DataFrame) -> DataFrame:
    """Cohorts whose stored rate is not the one their counts give (NULL counts as different)."""
    expected = safe_rate(F.col("churned_users"), F.col("total_users"))
    return (
        cohort.select("cohort_month", "total_users", "churned_users", "churn_rate_pct")
        .withColumn("expected_churn_rate_pct", expected)
        .where(
            (F.col("total_users") == 0)
            | ~F.col("churn_rate_pct").eqNullSafe(F.col("expected_churn_rate_pct"))
        )
    )


def check_orphans(facts: DataFrame, users: DataFrame) -> DataFrame:
    """User ids in the facts that no user has, with their number of fact rows.

    Facts are counted per user id before the anti join, so a frequent id shuffles as one row.
    """
    counts = (
        facts.where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return counts.join(users.select("user_id"), "user_id", "left_anti")


def check_domain(df: DataFrame, column: str, allowed: Sequence[str]) -> DataFrame:
    """Values outside the allowed set, with their number of rows; NULL is not a value."""
    outside = df.where(~F.col(column).isin(list(allowed)))
    return outside.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))


def check_product_matches_account(transactions: DataFrame, users: DataFrame) -> DataFrame:
    """Transactions in a product that the user's account type does not include."""
    joined = facts_with(transactions, users, "account_type")
    single = F.col("account_type").isin("Banking", "Invest")
    return joined.where(single & (F.col("product") != F.col("account_type"))).select(
        "transaction_id", "user_id", "product", "account_type"
    )


def check_activity_bounds(
    facts: DataFrame,
    users: DataFrame,
    key: str,
    date: str,
    as_of,
) -> DataFrame:
    """Facts dated before the user's signup or after ``as_of``."""
    joined = facts_with(facts.select(key, "user_id", date), users, "signup_date")
    issue = F.when(F.col(date) < F.col("signup_date"), "before_signup").when(
        F.col(date) > date_of(as_of), "after_as_of"
    )
    return joined.withColumn("issue", issue).where(F.col("issue").isNotNull())


def check_amount_rules(
    transactions: DataFrame,
    round_up_range: tuple[float, float] = (0.01, 3.00),
    other_range: tuple[float, float] = (5.00, 250.00),
) -> DataFrame:
    """Transactions whose amount, sign or round-up contradicts their type."""

    def within(bounds):
        low, high = (F.lit(str(b)).cast("decimal(18,2)") for b in bounds)
        return F.abs("amount_usd").between(low, high)

    is_round_up = F.col("transaction_type") == ROUND_UP
    is_withdrawal = F.col("transaction_type") == WITHDRAWAL
    in_range = F.when(is_round_up, within(round_up_range)).otherwise(within(other_range))
    right_sign = F.when(is_withdrawal, F.col("amount_usd") < 0).otherwise(F.col("amount_usd") > 0)
    issue = (
        F.when(~right_sign, "wrong_sign")
        .when(~in_range, "amount_out_of_range")
        .when(~is_round_up & (F.col("round_up") != 0), "unexpected_round_up")
    )
    return (
        transactions.select(
            "transaction_id", "transaction_type", "amount_usd", "round_up", issue.alias("issue")
        )
        .where(F.col("issue").isNotNull())
    )


def quality_report(
    tables: Mapping[str, DataFrame], inactive_days: int = churn.INACTIVE_DAYS
) -> DataFrame:
    """One row per check: name, number of violations, pass or fail.

    ``tables`` holds the staging tables and marts by name; marts should be read from where they
    were written, as several checks use them. All NULL counts of a table come from one pass.
    ``stopping`` tells which violations a run must not pass.
    """

    def counted(name: str, violations: DataFrame) -> DataFrame:
        return violations.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("check_name"), "violations"
        )

    rows = [counted(f"unique:{t}.{k}", check_unique(tables[t], k)) for t, k in UNIQUE.items()]
    for table, columns in NOT_NULL.items():
        nulls = null_counts(tables[table], columns)
        name = F.concat(F.lit(f"not_null:{table}."), F.col("column_name"))
        rows.append(nulls.select(name.alias("check_name"), F.col("nulls").alias("violations")))
    summary, events = tables["mart_user_summary"], tables["stg_events"]
    cohort = tables["mart_churn_cohort"]
    rows.append(counted("churn_type_logic", check_churn_type(summary, events, inactive_days)))
    rows.append(counted("churn_rate_consistency", check_churn_rate(cohort)))
    for table in ("stg_transactions", "stg_events"):
        rows.append(counted(f"orphans:{table}", check_orphans(tables[table], tables["stg_users"])))

    report = rows[0]
    for row in rows[1:]:
        report = report.unionByName(row)
    status = F.when(F.col("violations") == 0, "pass").otherwise("fail")
    return report.withColumn("status", status)
