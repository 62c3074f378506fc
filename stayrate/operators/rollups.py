"""Per-user rollups and the user summary mart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.functions import churn
from stayrate.functions.numbers import MONEY, cents, mean, sum_cents, sum_money


def tx_rollup(transactions: DataFrame) -> DataFrame:
    """Per user: counts, flows and date range. ``running_balance`` is the plain total."""
    amount = cents(F.col("amount_usd"))
    return transactions.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        sum_cents(churn.deposited(amount)).alias("total_deposited"),
        sum_cents(churn.withdrawn(amount)).alias("total_withdrawn"),
        sum_money(F.col("round_up")).alias("total_round_ups"),
        sum_cents(amount).alias("running_balance"),
        F.min("transaction_date").alias("first_transaction_date"),
        F.max("transaction_date").alias("last_transaction_date"),
    )


def event_rollup(events: DataFrame) -> DataFrame:
    """Per user: count, last date, mean session, and whether the user ever cancelled.

    The cancel flag rides on the same pass, so the events are scanned and shuffled once.
    """
    session = F.col("session_duration_sec")
    is_cancel = F.col("event_type") == churn.CANCEL_EVENT
    return events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("total_events"),
        F.max("event_date").alias("last_event_date"),
        mean(F.sum(session), F.count(session)).alias("avg_session_duration_sec"),
        F.coalesce(F.bool_or(is_cancel), F.lit(False)).alias("has_cancel"),
    )


def cancelled_users(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == churn.CANCEL_EVENT).select("user_id").distinct()


def last_transaction(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("user_id").agg(
        F.max("transaction_date").alias("last_transaction_date")
    )


def user_summary(
    users: DataFrame,
    transactions: DataFrame,
    events: DataFrame,
    as_of,
    inactive_days: int = churn.INACTIVE_DAYS,
) -> DataFrame:
    """One row per user: profile, churn flag and label, transaction and event metrics.

    Facts are reduced to a row per user before they meet the users; the three inputs of the
    joins are then partitioned alike, and facts of unknown users drop out.
    """
    joined = (
        users.join(tx_rollup(transactions), "user_id", "left")
        .join(event_rollup(events), "user_id", "left")
        .withColumn("days", churn.days_since(F.col("last_transaction_date"), as_of))
    )
    days = F.col("days")

    def or_zero(name: str, kind: str):
        return F.coalesce(F.col(name), F.lit(0)).cast(kind).alias(name)

    return joined.select(
        "user_id",
        "signup_date",
        "acquisition_channel",
        "account_type",
        "state",
        "age_group",
        churn.churned(days, inactive_days).alias("churned"),
        churn.churn_type(F.col("has_cancel"), days, inactive_days).alias("churn_type"),
        or_zero("total_transactions", "bigint"),
        or_zero("total_deposited", MONEY),
        or_zero("total_withdrawn", MONEY),
        or_zero("total_round_ups", MONEY),
        or_zero("running_balance", MONEY),
        "first_transaction_date",
        "last_transaction_date",
        days.alias("days_since_last_transaction"),
        or_zero("total_events", "bigint"),
        "last_event_date",
        or_zero("avg_session_duration_sec", "double"),
    )


def user_profile(summary: DataFrame, user_id: int) -> DataFrame:
    """One user's row. On the lazy summary the filter reaches every scan below the joins."""
    return summary.where(F.col("user_id") == user_id)
