"""Users who stop coming, reported by a stream as soon as its clock says so.

Per user the state is one date, the last one with a matching event, and a timer at the midnight from
which the user counts as inactive. When the watermark passes the timer, the user is reported once;
a later event starts a new wait. Up to any date that the watermark has passed, the users reported
and not seen again are those that ``inactive_users`` finds as lapsed in the events of that time.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from stayrate.functions.calendar import stream_clock
from stayrate.operators.staging import stg_events

LAPSE = "user_id bigint, last_event_date date, lapsed_on date"
EPOCH = dt.date(1970, 1, 1)
DAY_MS = 86_400_000


def lapses(
    raw_events: DataFrame, days: int = 14, event_type: str | None = "Login", late: str = "1 day"
) -> DataFrame:
    """(user_id, last_event_date, lapsed_on) when more than ``days`` days have passed without a
    matching event. Events without user or time set no timer; those beyond ``late`` come too late.
    """
    events = stg_events(raw_events)
    if event_type is not None:
        # Other events move the clock of the stream, too, but nobody's timer.
        events = events.withColumn("matches", F.col("event_type").eqNullSafe(event_type))
    else:
        events = events.withColumn("matches", F.lit(True))
    timed = events.where(F.col("user_id").isNotNull()).select(
        "user_id", stream_clock(F.col("event_ts")).alias("clock"), "matches", F.unix_date(F.col("event_date")).alias("day")
    )

    def advance(
        key: tuple, parts: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (last,) = state.get
            state.remove()
            dates = [EPOCH + dt.timedelta(days=d) for d in (last, last + days + 1)]
            yield pd.DataFrame([(key[0], *dates)], columns=["user_id", "last_event_date", "lapsed_on"])
            return
        last = state.get[0] if state.exists else None
        for part in parts:
            seen = part.loc[part["matches"], "day"].dropna()
            if len(seen):
                last = int(seen.max()) if last is None else max(last, int(seen.max()))
        if last is not None:
            state.update((last,))
            # A timer must lie ahead of the clock; one that is due fires with the next batch.
            due = (last + days + 1) * DAY_MS
            state.setTimeoutTimestamp(max(due, state.getCurrentWatermarkMs() + 1))

    return (
        timed.withWatermark("clock", late)
        .groupBy("user_id")
        .applyInPandasWithState(
            advance, LAPSE, "day int", "append", GroupStateTimeout.EventTimeTimeout
        )
    )
