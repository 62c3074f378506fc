"""Headline churn, churn by segment, value counts, step reach and segment counts."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.functions.numbers import mean, safe_rate
from stayrate.operators.skew import attach

SEGMENTS = ("age_group", "acquisition_channel", "account_type", "state")


def headline(summary: DataFrame) -> DataFrame:
    """Users, churned users and churn percentage as one row."""
    counted = summary.agg(
        F.count(F.lit(1)).alias("total_users"),
        F.coalesce(F.sum("churned"), F.lit(0)).cast("bigint").alias("churned_users"),
    )
    rate = safe_rate(F.col("churned_users"), F.col("total_users"), 2)
    return counted.withColumn("churn_pct", rate)


def churn_by(summary: DataFrame, dim: str, top: int | None = None) -> DataFrame:
    """Churn per value of one dimension, highest rate first; NULL values are left out."""
    counted = (
        summary.where(F.col(dim).isNotNull())
        .groupBy(dim)
        .agg(F.sum("churned").alias("churned_users"), F.count("churned").alias("total_users"))
    )
    rate = safe_rate(F.col("churned_users"), F.col("total_users"), 2)
    ordered = counted.withColumn("churn_pct", rate).orderBy(F.desc("churn_pct"), dim)
    return ordered if top is None else ordered.limit(top)


def churn_by_each(summary: DataFrame, dims: Sequence[str] = SEGMENTS) -> DataFrame:
    """``churn_by`` for several dimensions in one pass over the summary."""
    long = summary.select("churned", *dims).unpivot("churned", list(dims), "dimension", "segment")
    counted = (
        long.where(F.col("segment").isNotNull())
        .groupBy("dimension", "segment")
        .agg(F.sum("churned").alias("churned_users"), F.count("churned").alias("total_users"))
    )
    rate = safe_rate(F.col("churned_users"), F.col("total_users"), 2)
    return counted.withColumn("churn_pct", rate)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, ties by value; NULLs are left out."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column)
    return counts.agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), column)


def facts_with(facts: DataFrame, users: DataFrame, *columns: str) -> DataFrame:
    """Each fact row with attributes of its user; NULL for unknown users."""
    return attach(facts, users.select("user_id", *columns), "user_id")


def step_reach(
    events: DataFrame, users: DataFrame, segment: str, base: str, steps: Sequence[str]
) -> DataFrame:
    """Users per segment who ever did each step, and their share of the base step's users.

    Steps are not ordered, so a share may exceed 100. Each user is first reduced to one row of
    flags: the segment groups are few and large, and this way they only receive counts.
    """
    wanted = list(dict.fromkeys([base, *steps]))
    kind = F.col("event_type")
    per_user = (
        events.where(kind.isin(wanted))
        .groupBy("user_id")
        .agg(*[F.max(F.when(kind == s, 1).otherwise(0)).alias(s) for s in wanted])
    )
    reached = (
        users.where(F.col(segment).isNotNull())
        .select("user_id", segment)
        .join(per_user, "user_id")
        .groupBy(segment)
        .agg(*[F.sum(s).alias(s) for s in wanted])
    )
    rows = [
        F.struct(
            F.lit(s).alias("step"),
            F.col(s).alias("users"),
            safe_rate(F.col(s), F.col(base), 2).alias("pct_of_base"),
        )
        for s in wanted
    ]
    return reached.select(segment, F.inline(F.array(*rows)))


def segment_counts(events: DataFrame, users: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Events and distinct users per event type and value of each dimension.

    ``dims`` may name event columns (such as platform) and user columns. Events are counted per
    user first, with the event's own value where the dimension is one of events. A row of that
    count is one distinct user, so the few large groups at the end only add up numbers.
    """
    event_dims = [d for d in dims if d in events.columns]
    user_dims = [d for d in dims if d not in event_dims]
    known = events.where(F.col("user_id").isNotNull())
    n = F.count(F.lit(1)).alias("n")
    keys = ["dimension", "segment", "event_type"]
    parts = []
    if event_dims:
        long = known.unpivot(["user_id", "event_type"], event_dims, "dimension", "segment")
        parts.append(long.groupBy(*keys, "user_id").agg(n))
    if user_dims:
        per_user = known.groupBy("user_id", "event_type").agg(n)
        joined = per_user.join(users.select("user_id", *user_dims), "user_id")
        parts.append(joined.unpivot(["user_id", "event_type", "n"], user_dims, *keys[:2]))
    totals = [
        part.where(F.col("segment").isNotNull())
        .groupBy(*keys)
        .agg(F.sum("n").alias("events"), F.count(F.lit(1)).alias("users"))
        for part in parts
    ]
    return totals[0] if len(totals) == 1 else totals[0].unionByName(totals[1])


def segment_combinations(
    events: DataFrame,
    users: DataFrame,
    dims: Sequence[str],
    sets: Sequence[Sequence[str]] | None = None,
) -> DataFrame:
    """Events and distinct users per event type and combination of dimension values.

    ``sets`` names the combinations, by default every non-empty one of ``dims``; they may hold event
    and user columns. ``combination`` tells the rows apart, as ``platform & account_type``;
    dimensions outside of it are NULL. Events are counted per user and own value first, so events
    are read once and grouping sets expand these counts instead of events. A user with several
    values of an event dimension counts once where that dimension is left out. Rows without a value
    for a dimension of the combination, and events of unknown users where it has user columns, are
    left out.
    """
    if sets is None:
        sets = [c for n in range(1, len(dims) + 1) for c in combinations(dims, n)]
    sets = list(dict.fromkeys(tuple(d for d in dims if d in s) for s in sets))
    if not all(sets):
        raise ValueError("a combination needs at least one of the dimensions")
    event_dims = [d for d in dims if d in events.columns]
    user_dims = [d for d in dims if d not in event_dims]
    counted = (
        events.where(F.col("user_id").isNotNull())
        .groupBy("user_id", "event_type", *event_dims)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if user_dims:
        counted = counted.join(users.select("user_id", *user_dims), "user_id", "left")
    grouped = counted.groupingSets([["event_type", *s] for s in sets], "event_type", *dims).agg(
        F.sum("n").alias("events"),
        F.count_distinct("user_id").alias("users"),
        *(F.grouping(d).alias(f"{d}_left_out") for d in dims),
    )
    present = F.lit(True)
    for d in dims:
        present = present & ((F.col(f"{d}_left_out") == 1) | F.col(d).isNotNull())
    name = F.concat_ws(" & ", *(F.when(F.col(f"{d}_left_out") == 0, d) for d in dims))
    return grouped.where(present).select(
        name.alias("combination"), "event_type", *dims, "events", "users"
    )


def session_stats(events: DataFrame, summary: DataFrame) -> DataFrame:
    """Events and mean session length per event type and churn flag."""
    session = F.col("session_duration_sec")
    per_user = events.groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(session).alias("total"),
        F.count(session).alias("timed"),
    )
    return (
        per_user.join(summary.select("user_id", "churned"), "user_id")
        .groupBy("event_type", "churned")
        .agg(
            F.sum("n").alias("events"),
            mean(F.sum("total"), F.sum("timed")).alias("avg_session_duration_sec"),
        )
    )
