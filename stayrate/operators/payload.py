"""Payload tables for a product-analytics receiver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.functions.calendar import epoch_millis
from stayrate.functions.churn import ACTIVE
from stayrate.operators.numbering import with_batches

# Most rows per request, for user properties and for events.
USERS_PER_REQUEST, EVENTS_PER_REQUEST = 100, 500
JSON_OPTIONS = {"ignoreNullFields": "false"}


def user_key(user_id):
    return F.concat(F.lit("user_"), user_id.cast("string"))


def identify_payload(summary: DataFrame) -> DataFrame:
    """User key and the properties to set, as a nested ``$set`` struct."""
    properties = F.struct(
        "signup_date",
        "acquisition_channel",
        "account_type",
        "state",
        "age_group",
        F.col("churned").cast("boolean").alias("churned"),
        F.coalesce("churn_type", F.lit(ACTIVE)).alias("churn_type"),
    )
    return summary.select(
        user_key(F.col("user_id")).alias("user_id"),
        F.struct(properties.alias("$set")).alias("user_properties"),
    )


def event_payload(events: DataFrame) -> DataFrame:
    """Every event with user key, epoch milliseconds and nested properties.

    ``insert_id`` is the event id: a receiver can recognise an event that is sent again.
    """
    properties = F.struct(
        "platform", F.col("session_duration_sec").cast("bigint").alias("session_duration_sec")
    )
    return events.select(
        user_key(F.col("user_id")).alias("user_id"),
        "event_type",
        epoch_millis(F.col("event_ts")).alias("time"),
        "platform",
        properties.alias("event_properties"),
        F.col("event_id").cast("string").alias("insert_id"),
    )


def json_lines(payload: DataFrame) -> DataFrame:
    """One JSON text per row."""
    return payload.select(F.to_json(F.struct("*"), JSON_OPTIONS).alias("value"))


def request_bodies(
    payload: DataFrame, key: str, size: int, seed: str | None = None
) -> DataFrame:
    """One row per request: its number, its rows and their JSON array.

    A group never exceeds ``size`` rows, so collecting it into one array is bounded. With a ``seed``
    which rows share a request follows from the MD5 of their keys, so a repeated run, here or
    elsewhere, sends the same bodies.
    """
    row = F.struct(*payload.columns)
    return (
        with_batches(payload, key, size, seed=seed)
        .groupBy("batch_no")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sort_array(F.collect_list(row)).alias("rows"))
        .select("batch_no", "n_rows", F.to_json("rows", JSON_OPTIONS).alias("body"))
    )


def identify_requests(summary: DataFrame, seed: str | None = None) -> DataFrame:
    """Bodies that set the properties of all users, at most 100 users each."""
    return request_bodies(identify_payload(summary), "user_id", USERS_PER_REQUEST, seed)


def event_requests(events: DataFrame, seed: str | None = None) -> DataFrame:
    """Bodies that deliver all events, at most 500 events each."""
    return request_bodies(event_payload(events), "insert_id", EVENTS_PER_REQUEST, seed)
