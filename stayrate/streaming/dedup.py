"""Events of a stream once each, also when they are sent again or arrive late.

The state holds the event ids seen within the watermark, so it is bounded by the events of the last
``late`` interval and not by the stream. A repeated event is dropped if it comes at most ``late``
after its first copy, in event time. Events that are older than the watermark when they arrive are
dropped by the engine: ``late`` must cover the longest delay that senders promise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stayrate.functions.calendar import stream_clock
from stayrate.operators.staging import stg_events


def once_each(raw_events: DataFrame, late: str = "7 days") -> DataFrame:
    """Staged events without repeated event ids.

    Rows without an event id count as repeated only if they are equal in all columns.
    """
    events = stg_events(raw_events)
    unnamed = F.when(F.col("event_id").isNull(), F.xxhash64(*events.columns))
    clock = stream_clock(F.col("event_ts"))
    marked = events.withColumns({"_unnamed": unnamed, "_clock": clock}).withWatermark("_clock", late)
    once = marked.dropDuplicatesWithinWatermark(["event_id", "_unnamed"])
    return once.drop("_unnamed", "_clock")


def start_table(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived to Parquet files, then stop; run it again for what arrives later."""
    return (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
