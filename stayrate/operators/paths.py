"""Event sequences that lead to a target event.

A path is the target's type preceded by up to ``depth`` earlier event types of the same user,
in order of time, ties by event id.

Hot users are cut into consecutive slices that are windowed apart. Inside a slice a target
with ``depth`` predecessors is complete. The others are settled in a second window over the
slice edges only, that is the first and last ``depth`` rows of each slice: walking back from an
early row, one meets the slice's own first rows, then the last rows of the slice before, and so
on, all of which are edge rows. The result is the same as with one window per user.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayrate.operators.skew import ROWS_PER_TASK, hot_keys, only_hot, without_hot

FACT = ("user_id", "event_id", "event_ts", "event_type")


def _sliced(events: DataFrame, slices: int | None = None) -> DataFrame:
    """Rows with the number of the range partition they sort into.

    The ranges are balanced over (user, time, id), so neither a burst nor many events on one
    date makes a large slice. There are as many as shuffle partitions unless their number is given,
    and those are sized to fit a task; adaptive execution merges small neighbours into one range.
    """
    order = ("user_id", "event_ts", "event_id")
    ranged = events.repartitionByRange(*([] if slices is None else [slices]), *order)
    return ranged.withColumn("slice", F.spark_partition_id())


def _with_previous(events: DataFrame, depth: int, *parts: str) -> DataFrame:
    """Adds the types of the ``depth`` rows before, oldest first, and the row's place."""
    order = Window.partitionBy(*parts).orderBy("event_ts", "event_id")
    kind = F.col("event_type")
    before = [F.lag(kind, i).over(order) for i in range(depth, 0, -1)]
    return events.select(
        "*",
        F.concat_ws(" > ", *before, kind).alias("path"),
        (F.row_number().over(order) <= depth).alias("in_head"),
        F.lead(kind, depth).over(order).isNull().alias("in_tail"),
    )


def _ends_by_user(
    events: DataFrame, targets: Sequence[str], depth: int, rows_per_task: int
) -> tuple[DataFrame, DataFrame]:
    """Paths of regular users, still partitioned by user, and paths of hot users."""
    events = events.select(*FACT)
    is_target = F.col("event_type").isin(list(targets))
    hot = hot_keys(events, "user_id", rows_per_task)

    regular = _with_previous(without_hot(events, hot, "user_id"), depth, "user_id")
    regular = regular.where(is_target).select("user_id", "event_id", "path")

    of_hot = only_hot(events, hot, "user_id")
    inner = _with_previous(_sliced(of_hot), depth, "user_id", "slice")
    is_edge = F.col("in_head") | F.col("in_tail")
    # All edges of a user share one window; finished targets ride along in their own slice.
    kept = inner.where(is_edge | is_target).select(
        *FACT,
        F.col("path").alias("own_path"),
        F.col("in_head").alias("unfinished"),
        F.when(~is_edge, F.col("slice")).alias("part"),
    )
    across = F.when(F.col("unfinished"), F.col("path")).otherwise(F.col("own_path"))
    big = _with_previous(kept, depth, "user_id", "part").where(is_target)
    return regular, big.select("user_id", "event_id", across.alias("path"))


def path_ends(
    events: DataFrame,
    targets: Sequence[str],
    depth: int,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """``user_id, event_id, path`` for every target event."""
    regular, big = _ends_by_user(events, targets, depth, rows_per_task)
    return regular.unionByName(big)


def paths_to(
    events: DataFrame,
    targets: Sequence[str],
    depth: int = 3,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """How often each path led to a target, and for how many users.

    Counting per user comes before the union: regular rows already lie together by user, so this
    step shuffles nothing and only path totals travel.
    """
    regular, big = (
        ends.groupBy("user_id", "path").agg(F.count(F.lit(1)).alias("n"))
        for ends in _ends_by_user(events, targets, depth, rows_per_task)
    )
    return (
        regular.unionByName(big)
        .groupBy("path")
        .agg(F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("users"))
    )
