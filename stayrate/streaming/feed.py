"""Event payloads from a folder that raw event files keep arriving in.

Staging, the age filter and the payload are row-wise, so the batch operators run unchanged on a
stream. There is no state and no shuffle; the file sink's log writes each input row once even
when a run is repeated after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stayrate.operators.payload import event_payload, json_lines
from stayrate.operators.staging import ingest_window, stg_events
from stayrate.sources.raw import CSV_OPTIONS, RAW_SCHEMAS


def read_event_stream(
    spark: SparkSession, folder: str, fmt: str = "csv", schema=None, files_per_batch: int = 1000
) -> DataFrame:
    reader = (
        spark.readStream.format(fmt)
        .schema(schema or RAW_SCHEMAS["events"])
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    return reader.load(folder)


def payload_stream(raw_events: DataFrame, as_of=None, days: int = 365) -> DataFrame:
    events = stg_events(raw_events)
    if as_of is not None:
        events = ingest_window(events, as_of, days)
    return json_lines(event_payload(events))


def start_feed(payloads: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Deliver everything that has arrived, then stop; run it again for what arrives later.

    ``checkpoint`` must lie in storage that outlives the run.
    """
    return (
        payloads.writeStream.format("text")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )
