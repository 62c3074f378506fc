"""Ordered conversion funnels.

A funnel is anchored at a user's first event of the first step (t1). A later step is reached at
the earliest event of its type after the step it follows, at most ``within`` after t1.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayrate.functions.numbers import safe_rate
from stayrate.operators.skew import ROWS_PER_TASK, hot_keys, only_hot, without_hot


def _step_time(kind: int, after: str, within: dt.timedelta | None, strict: bool) -> Column:
    """Earliest time of ``kind`` after the step time column ``after``, inside the window."""
    ts = F.col("event_ts")
    follows = ts > F.col(after) if strict else ts >= F.col(after)
    if within is not None:
        follows = follows & (ts <= F.col("t1") + F.lit(within))
    return F.min(F.when((F.col("kind") == kind) & follows, ts))


def _times_by_window(events: DataFrame, steps, within, strict) -> DataFrame:
    """Users of bounded size: one shuffle by user, then each step is a minimum per user."""
    user = Window.partitionBy("user_id")
    first = F.min(F.when(F.col("kind") == steps[0][0], F.col("event_ts")))
    timed = events.withColumn("t1", first.over(user)).where(F.col("t1").isNotNull())
    for i, (kind, after) in enumerate(steps[1:], start=2):
        step = _step_time(kind, f"t{after}", within, strict)
        timed = timed.withColumn(f"t{i}", step.over(user))
    times = [f"t{i}" for i in range(1, len(steps) + 1)]
    return timed.groupBy("user_id").agg(*[F.min(t).alias(t) for t in times])


def _times_by_rounds(events: DataFrame, steps, within, strict) -> DataFrame:
    """Hot users: one map-side combined minimum per step. The step times found so far, one row
    per hot user, are broadcast to the events, which are never brought together by user."""
    first = events.where(F.col("kind") == steps[0][0])
    times = first.groupBy("user_id").agg(F.min("event_ts").alias("t1"))
    for i, (kind, after) in enumerate(steps[1:], start=2):
        step = _step_time(kind, f"t{after}", within, strict).alias(f"t{i}")
        known = [f"t{j}" for j in range(1, i)]
        times = events.join(F.broadcast(times), "user_id").groupBy("user_id", *known).agg(step)
    return times


def step_times(
    events: DataFrame,
    steps: Sequence[tuple[str, int]],
    within: dt.timedelta | None = None,
    strict: bool = True,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``user_id, t1 … tn``: when each user with a first step reached each step.

    ``steps`` lists (event type, number of the step it follows); the first one follows none.
    ``strict`` demands a later timestamp; use False for data that only has dates.
    """
    kinds = list(dict.fromkeys(kind for kind, _ in steps))
    # Numbers instead of type names keep the shuffled rows short.
    number = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("event_type"))
    timed = F.col("event_ts").isNotNull()  # before the split, so that both branches agree
    relevant = events.where(F.col("event_type").isin(kinds) & timed).select(
        "user_id", "event_ts", number.cast("int").alias("kind")
    )
    numbered = [(kinds.index(kind) + 1, after) for kind, after in steps]
    hot = hot_keys(relevant, "user_id", rows_per_task)
    regular = _times_by_window(without_hot(relevant, hot, "user_id"), numbered, within, strict)
    big = _times_by_rounds(only_hot(relevant, hot, "user_id"), numbered, within, strict)
    return regular.unionByName(big)


def _report(
    times: DataFrame,
    labels: Sequence[str],
    previous: Sequence[int],
    users: DataFrame | None,
    segment: str | None,
) -> DataFrame:
    """Users per step (and segment) with shares of the first and of the preceding step."""
    names = [f"t{i}" for i in range(1, len(labels) + 1)]
    counts = [F.count(t).alias(t) for t in names]
    if segment is None:
        reached = times.agg(*counts)
    else:
        members = users.where(F.col(segment).isNotNull()).select("user_id", segment)
        reached = times.join(members, "user_id").groupBy(segment).agg(*counts)
    rows = [
        F.struct(
            F.lit(i + 1).alias("step_no"),
            F.lit(label).alias("step"),
            F.col(names[i]).alias("users"),
            safe_rate(F.col(names[i]), F.col("t1"), 2).alias("pct_of_first"),
            safe_rate(F.col(names[i]), F.col(names[previous[i]]), 2).alias("pct_of_previous"),
        )
        for i, label in enumerate(labels)
    ]
    keep = [] if segment is None else [segment]
    return reached.select(*keep, F.inline(F.array(*rows)))


def funnel(
    events: DataFrame,
    steps: Sequence[str],
    within: dt.timedelta | None = None,
    users: DataFrame | None = None,
    segment: str | None = None,
    strict: bool = True,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Steps in sequence: each follows the one before."""
    chain = [(kind, i) for i, kind in enumerate(steps)]
    times = step_times(events, chain, within, strict, rows_per_task)
    previous = [max(i - 1, 0) for i in range(len(steps))]
    return _report(times, steps, previous, users, segment)


def branch_funnel(
    events: DataFrame,
    base: str,
    branches: Sequence[str],
    within: dt.timedelta | None = None,
    users: DataFrame | None = None,
    segment: str | None = None,
    strict: bool = True,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Alternatives after one base step: each branch follows the base, all in one pass."""
    tree = [(base, 0)] + [(kind, 1) for kind in branches]
    times = step_times(events, tree, within, strict, rows_per_task)
    return _report(times, [base, *branches], [0] * len(tree), users, segment)
