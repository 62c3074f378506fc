"""Sessions: runs of a user's events with pauses shorter than a gap.

Events are merged twice. First within short stretches of time per user, where a user of any size is
spread over many tasks and what is left of a stretch is at most one partial session per gap. Then
the partial sessions of a user are merged; their number is bounded by the time covered and the gap,
however many events the user has.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayrate.functions.calendar import epoch_millis

#: Gaps in a stretch of the first merging step.
STRETCH = 48


def _partial(events: DataFrame, gap_minutes: int) -> DataFrame:
    """Sessions inside stretches of ``STRETCH`` gaps: map-side merged, no user in one task."""
    stretch = F.call_function(
        "div", epoch_millis(F.col("event_ts")), F.lit(STRETCH * gap_minutes * 60_000).cast("bigint")
    )
    placed = events.where(F.col("user_id").isNotNull() & F.col("event_ts").isNotNull())
    window = F.session_window("event_ts", f"{gap_minutes} minutes")
    return (
        placed.select("user_id", "event_ts", "event_type", stretch.alias("stretch"))
        .groupBy("user_id", "stretch", window)
        .agg(
            F.min("event_ts").alias("began"),
            F.max("event_ts").alias("ended"),
            F.count(F.lit(1)).alias("n"),
        )
        .select("user_id", "began", "ended", "n")
    )


def sessions(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """One row per session: user_id, session_no, session_start, session_end, events, minutes.

    An event belongs to the session before it if it follows within ``gap_minutes``, the gap itself
    included. ``session_end`` is the last event's time; ``session_no`` counts a user's sessions from
    1. Events without user or time belong to none.
    """
    user = Window.partitionBy("user_id").orderBy("began")
    follows = F.col("began") <= F.col("before") + F.expr(f"INTERVAL '{gap_minutes}' MINUTE")
    # Partial sessions of one user do not overlap, so the one before ended last.
    marked = _partial(events, gap_minutes).withColumn("before", F.lag("ended").over(user))
    number = F.sum(F.when(follows, 0).otherwise(1)).over(user).cast("int")
    merged = (
        marked.withColumn("session_no", number)
        .groupBy("user_id", "session_no")
        .agg(
            F.min("began").alias("session_start"),
            F.max("ended").alias("session_end"),
            F.sum("n").alias("events"),
        )
    )
    length = epoch_millis(F.col("session_end")) - epoch_millis(F.col("session_start"))
    minutes = F.call_function("div", length, F.lit(60_000).cast("bigint"))
    return merged.withColumn("minutes", minutes)


def sessions_per_day(events: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """Per user and day on which sessions begin: sessions, events in them, minutes of the longest."""
    day = F.col("session_start").cast("date").alias("session_day")
    return (
        sessions(events, gap_minutes)
        .groupBy("user_id", day)
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.sum("events").alias("events"),
            F.max("minutes").alias("longest_minutes"),
        )
    )
