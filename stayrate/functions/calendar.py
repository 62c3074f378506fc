"""Calendar periods and epoch time, independent of the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAINS = ("day", "week", "month")


def date_of(value: str | dt.date | Column) -> Column:
    if isinstance(value, Column):
        return value.cast("date")
    return F.lit(str(value)).cast("date")


def instant(value: str | dt.datetime | Column) -> Column:
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def period_start(day: Column, grain: str) -> Column:
    """First day of the day / week (from Monday) / month that ``day`` lies in."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, not {grain!r}")
    return day.cast("date") if grain == "day" else F.trunc(day, grain)


def periods_between(start: Column, end: Column, grain: str) -> Column:
    """Whole periods from one period start to another."""
    if grain == "month":
        return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    days = F.datediff(end, start)
    return days if grain == "day" else F.call_function("div", days, F.lit(7)).cast("int")


def epoch_micros(ts: Column) -> Column:
    """Microseconds since 1970-01-01, reading the zone-less timestamp as UTC."""
    ts = ts.cast("timestamp_ntz")
    minutes = F.hour(ts) * 60 + F.minute(ts)
    second = F.extract(F.lit("SECOND"), ts)
    return (
        F.unix_date(ts.cast("date")).cast("bigint") * 86_400_000_000
        + minutes.cast("bigint") * 60_000_000
        + (second * 1_000_000).cast("bigint")
    )


def epoch_millis(ts: Column) -> Column:
    """Milliseconds since 1970-01-01, reading the zone-less timestamp as UTC.

    Built from date and clock parts, as a cast to TIMESTAMP would apply the session time zone.
    """
    ts = ts.cast("timestamp_ntz")
    clock = F.hour(ts) * 3_600_000 + F.minute(ts) * 60_000
    second = F.extract(F.lit("SECOND"), ts)
    return (
        F.unix_date(ts.cast("date")).cast("bigint") * 86_400_000
        + clock
        + F.floor(second * 1000).cast("bigint")
    )


def stream_clock(ts: Column) -> Column:
    """The zone-less timestamp, read as UTC, in the type that watermarks need."""
    return F.timestamp_micros(epoch_micros(ts))
