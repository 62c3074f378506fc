"""Retention grids, activity per user and the share of active users."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayrate.functions.calendar import date_of, period_start, periods_between
from stayrate.functions.numbers import safe_rate, safe_ratio


def _matching(events: DataFrame, event_type: str | None) -> DataFrame:
    known = events.where(F.col("user_id").isNotNull())
    return known if event_type is None else known.where(F.col("event_type") == event_type)


def first_activity(events: DataFrame) -> DataFrame:
    """Each user's first event date as a signup date, for data without one."""
    return _matching(events, None).groupBy("user_id").agg(F.min("event_date").alias("signup_date"))


def retention(
    events: DataFrame,
    users: DataFrame,
    as_of,
    grain: str = "month",
    event_type: str | None = None,
    by: str | None = None,
) -> DataFrame:
    """Cohort grid: users of a signup period active in each later period.

    Every (cohort, period) up to ``as_of`` has a row, 0 where nobody returned. ``by`` names a
    user column that splits the cohorts. Events are reduced to one row per user and period
    before they meet the users, so no user is larger than the calendar.
    """
    extra = [] if by is None else [by]
    keys = ["cohort", *extra]
    cohorts = users.where(F.col("signup_date").isNotNull())
    if by is not None:
        cohorts = cohorts.where(F.col(by).isNotNull())
    cohorts = cohorts.select(
        "user_id", period_start(F.col("signup_date"), grain).alias("cohort"), *extra
    )
    active = (
        _matching(events, event_type)
        .where(F.col("event_date") <= date_of(as_of))
        .select("user_id", period_start(F.col("event_date"), grain).alias("active"))
        .distinct()
    )
    cells = (
        active.join(cohorts, "user_id")
        .withColumn("period", periods_between(F.col("cohort"), F.col("active"), grain))
        .where(F.col("period") >= 0)
        .groupBy(*keys, "period")
        .agg(F.count(F.lit(1)).alias("users"))
    )
    last = periods_between(F.col("cohort"), period_start(date_of(as_of), grain), grain)
    grid = (
        cohorts.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("cohort_size"))
        .where(last >= 0)
        .withColumn("period", F.explode(F.sequence(F.lit(0), last)))
    )
    users_back = F.coalesce(F.col("users"), F.lit(0))
    return grid.join(cells, [*keys, "period"], "left").select(
        *keys,
        "period",
        "cohort_size",
        users_back.alias("users"),
        safe_rate(users_back, F.col("cohort_size"), 2).alias("pct"),
    )


def events_per_user(
    events: DataFrame,
    summary: DataFrame,
    group: str,
    event_type: str | None = None,
    grain: str = "month",
) -> DataFrame:
    """Events per active user, for each period and group of users (churned, churn_type …)."""
    per_user = (
        _matching(events, event_type)
        .groupBy("user_id", period_start(F.col("event_date"), grain).alias("period_start"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    counted = (
        per_user.join(summary.select("user_id", group), "user_id")
        .groupBy("period_start", group)
        .agg(F.sum("n").alias("events"), F.count(F.lit(1)).alias("users"))
    )
    average = safe_ratio(F.col("events"), F.col("users"), 2)
    return counted.withColumn("events_per_user", average)


def crossover(series: DataFrame, period: str, group: str, value: str, a, b) -> DataFrame:
    """The first period in which group ``a`` exceeds group ``b`` after having been at or below it.

    ``series`` has one row per period and group; a missing group counts as 0. The two groups are
    pivoted to one row per period, so the ordered window runs over the calendar, not over facts.
    """
    by_period = series.groupBy(period).agg(
        F.coalesce(F.max(F.when(F.col(group) == a, F.col(value))), F.lit(0.0)).alias("value_a"),
        F.coalesce(F.max(F.when(F.col(group) == b, F.col(value))), F.lit(0.0)).alias("value_b"),
    )
    over = F.col("value_a") > F.col("value_b")
    in_order = Window.orderBy(period)
    return (
        by_period.withColumn("was_over", F.lag(over).over(in_order))
        .where(over & ~F.col("was_over"))
        .select(period, "value_a", "value_b")
        .orderBy(period)
        .limit(1)
    )


def active_share(
    events: DataFrame, users: DataFrame, grain: str = "month", event_type: str | None = None
) -> DataFrame:
    """Per period: active users as a share of all users who signed up so far.

    The running total runs over one row per period.
    """
    known = users.where(F.col("signup_date").isNotNull())
    signups = known.groupBy(
        period_start(F.col("signup_date"), grain).alias("period_start")
    ).agg(F.count(F.lit(1)).alias("signed_up"))
    active = (
        _matching(events, event_type)
        .select("user_id", period_start(F.col("event_date"), grain).alias("period_start"))
        .distinct()
        .join(known.select("user_id"), "user_id", "left_semi")
        .groupBy("period_start")
        .agg(F.count(F.lit(1)).alias("active_users"))
    )
    both = signups.unionByName(active, allowMissingColumns=True)
    per_period = both.groupBy("period_start").agg(
        F.coalesce(F.sum("active_users"), F.lit(0)).alias("active_users"),
        F.coalesce(F.sum("signed_up"), F.lit(0)).alias("signed_up"),
    )
    so_far = F.sum("signed_up").over(Window.orderBy("period_start"))
    return per_period.select(
        "period_start", "active_users", so_far.alias("users_so_far")
    ).withColumn("active_pct", safe_rate(F.col("active_users"), F.col("users_so_far"), 2))
