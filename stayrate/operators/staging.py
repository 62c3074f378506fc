"""Typed staging tables: select, rename to lower case, cast dates and money."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.functions.numbers import MONEY


def stg_users(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "cast(User_ID AS bigint) AS user_id",
        "cast(Signup_Date AS date) AS signup_date",
        "Acquisition_Channel AS acquisition_channel",
        "Account_Type AS account_type",
        "State AS state",
        "Age_Group AS age_group",
    )


def stg_transactions(raw: DataFrame) -> DataFrame:
    return raw.selectExpr(
        "cast(Transaction_ID AS bigint) AS transaction_id",
        "cast(User_ID AS bigint) AS user_id",
        "cast(Transaction_Date AS date) AS transaction_date",
        f"cast(Amount_USD AS {MONEY}) AS amount_usd",
        "Transaction_Type AS transaction_type",
        "Product AS product",
        f"cast(Round_Up AS {MONEY}) AS round_up",
    )


def stg_events(raw: DataFrame) -> DataFrame:
    """``event_ts`` is the source's timestamp if it has one (``Event_Ts``), else midnight."""
    has_time = "event_ts" in {c.lower() for c in raw.columns}
    ts = "Event_Ts" if has_time else "cast(Event_Date AS date)"
    return raw.selectExpr(
        "cast(Event_ID AS bigint) AS event_id",
        "cast(User_ID AS bigint) AS user_id",
        "cast(Event_Date AS date) AS event_date",
        f"cast({ts} AS timestamp_ntz) AS event_ts",
        "Event_Type AS event_type",
        "Platform AS platform",
        "Session_Duration_Sec AS session_duration_sec",
    )


STAGING = {"users": stg_users, "transactions": stg_transactions, "events": stg_events}


def stage(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: STAGING[name](df) for name, df in raw.items()}


def events_of_type(events: DataFrame, *types: str) -> DataFrame:
    return events.where(F.col("event_type").isin(*types))


def ingest_window(events: DataFrame, as_of, days: int = 365) -> DataFrame:
    """Events not older than ``days`` before ``as_of``; a plain filter, so it reaches the scan."""
    oldest = F.date_sub(F.lit(str(as_of)).cast("date"), days)
    return events.where(F.col("event_date") >= oldest)


def append_events(events: DataFrame, more: DataFrame) -> DataFrame:
    return events.unionByName(more)
