"""Users a retention action would address."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.functions.calendar import date_of, epoch_millis, instant


def inactive_users(
    events: DataFrame, users: DataFrame, as_of, days: int = 14, event_type: str | None = "Login"
) -> DataFrame:
    """Users whose last matching event up to ``as_of`` is more than ``days`` before ``as_of`` (status lapsed) or
    who never had one (status never)."""
    matching = events if event_type is None else events.where(F.col("event_type") == event_type)
    until = matching.where(F.col("event_date") <= date_of(as_of))
    last = until.groupBy("user_id").agg(F.max("event_date").alias("last_event_date"))
    idle = F.datediff(date_of(as_of), F.col("last_event_date"))
    return (
        users.select("user_id")
        .join(last, "user_id", "left")
        .withColumn("days_inactive", idle)
        .where(F.col("last_event_date").isNull() | (F.col("days_inactive") > days))
        .withColumn(
            "status", F.when(F.col("last_event_date").isNull(), "never").otherwise("lapsed")
        )
    )


def stalled_at(
    events: DataFrame, from_step: str, to_step: str, as_of, hours: int = 48
) -> DataFrame:
    """Users whose latest ``from_step`` has no ``to_step`` after it and is at least ``hours`` old.

    Two conditional maxima decide it, so a user's events never meet in one place.
    """
    kind, ts = F.col("event_type"), F.col("event_ts")
    latest = (
        events.where(kind.isin(from_step, to_step) & (ts <= instant(as_of)))
        .where(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(
            F.max(F.when(kind == from_step, ts)).alias("stalled_since"),
            F.max(F.when(kind == to_step, ts)).alias("last_to"),
        )
    )
    since = F.col("stalled_since")
    waited = epoch_millis(instant(as_of)) - epoch_millis(since)
    open_step = since.isNotNull() & (F.col("last_to").isNull() | (F.col("last_to") <= since))
    return latest.where(open_step & (waited >= hours * 3_600_000)).select(
        "user_id",
        "stalled_since",
        F.call_function("div", waited, F.lit(3_600_000)).alias("hours_stalled"),
    )


def favourite_deposit(transactions: DataFrame) -> DataFrame:
    """Each user's most frequent deposit amount; among equals the smallest.

    Counts per (user, amount), then the smallest amount per (user, count), then the one with the
    largest count: hash aggregates, combined map-side, without a window over a user's deposits.
    """
    counts = (
        transactions.where((F.col("amount_usd") > 0) & F.col("user_id").isNotNull())
        .groupBy("user_id", "amount_usd")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    smallest = counts.groupBy("user_id", "n").agg(F.min("amount_usd").alias("amount_usd"))
    return smallest.groupBy("user_id").agg(
        F.max_by("amount_usd", "n").alias("favourite_amount"), F.max("n").alias("times")
    )
