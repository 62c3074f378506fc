"""Rollups that grow with their input: one partial aggregate per user and day, kept as partitions.

An arrival of events is stored by day. Only the days it touches are added up again, from the stored
events of these days alone, and replace their partitions; all other days stay as they are. A period
or the whole history is then merged from the partial rows, which are far fewer than events. An
arrival that is stored again under its name replaces itself, so a failed run can be repeated.

Each day also keeps mergeable sketches (distinct users, session lengths) per event type. Sketches
of any days are merged in one pass; the days' events are not read again.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.functions import churn
from stayrate.functions.calendar import date_of
from stayrate.functions.numbers import mean

DAY = "event_date"
#: HyperLogLog with 2^12 registers: a standard error of 1.6 %.
HLL_BITS = 12
#: Quantile sketches of 16 KB at most: ranks are off by about 0.3 %.
KLL_K = 800


def daily_rollup(events: DataFrame) -> DataFrame:
    """Per user and day what ``merged`` needs; additive, so parts of a day may be added up too."""
    session = F.col("session_duration_sec")
    return events.groupBy("user_id", DAY).agg(
        F.count(F.lit(1)).alias("events"),
        F.sum(session).alias("session_total"),
        F.count(session).alias("timed"),
        F.coalesce(F.bool_or(F.col("event_type") == churn.CANCEL_EVENT), F.lit(False)).alias(
            "has_cancel"
        ),
    )


def merged(daily: DataFrame) -> DataFrame:
    """The rollup per user that all events of these days would give."""
    return daily.groupBy("user_id").agg(
        F.sum("events").alias("total_events"),
        F.max(DAY).alias("last_event_date"),
        mean(F.sum("session_total"), F.sum("timed")).alias("avg_session_duration_sec"),
        F.coalesce(F.bool_or("has_cancel"), F.lit(False)).alias("has_cancel"),
    )


def daily_sketches(events: DataFrame) -> DataFrame:
    """Per day and event type: events, a sketch of users and one of session lengths.

    Sketches are built per task and merged, so days of any size are added up map-side.
    """
    return events.groupBy(DAY, "event_type").agg(
        F.count(F.lit(1)).alias("events"),
        F.hll_sketch_agg("user_id", F.lit(HLL_BITS)).alias("users"),
        F.kll_sketch_agg_double(F.col("session_duration_sec").cast("double"), F.lit(KLL_K)).alias(
            "sessions"
        ),
    )


def from_sketches(sketches: DataFrame, shares=(0.5, 0.9, 0.99)) -> DataFrame:
    """Per event type over all given days: events, users (about), session lengths at ``shares``."""
    found = sketches.groupBy("event_type").agg(
        F.sum("events").alias("events"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"),
        F.kll_merge_agg_double("sessions", F.lit(KLL_K)).alias("sessions"),
    )
    at = {
        f"session_p{round(share * 100)}": F.kll_sketch_get_quantile_double("sessions", F.lit(share))
        for share in shares
    }
    return found.select("event_type", "events", "users", *(c.alias(n) for n, c in at.items()))


class DailyStore:
    """Events by day and arrival, and their daily rollups and sketches, below one folder.

    The folder must be reachable by all executors.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def _path(self, name: str) -> str:
        return os.path.join(self.folder, name)

    def _replace(self, df: DataFrame, name: str, *parts: str) -> None:
        """Write ``df`` in place of the partitions it has rows for, and of no others."""
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*parts).parquet(self._path(name))

    def _touched(self, days: list) -> Column:
        known = [d for d in days if d is not None]
        found = F.col(DAY).isin(known) if known else F.lit(False)
        return found | F.col(DAY).isNull() if None in days else found

    def arrive(self, events: DataFrame, arrival: str) -> list:
        """Store an arrival and renew the days it touches, which are returned.

        The days are the only thing that comes to the driver. Late events renew their old days.
        """
        self._replace(events.withColumn("arrival", F.lit(arrival)), "events", DAY, "arrival")
        own = self.events().where(F.col("arrival") == arrival)
        days = [r[0] for r in own.select(DAY).distinct().collect()]
        touched = self.events().where(self._touched(days))
        self._replace(daily_rollup(touched), "rollup", DAY)
        self._replace(daily_sketches(touched), "sketches", DAY)
        return sorted(days, key=lambda d: (d is not None, d))

    def _read(self, name: str) -> DataFrame:
        try:
            return self.spark.read.parquet(self._path(name)).withColumn(DAY, F.col(DAY).cast("date"))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                raise FileNotFoundError(f"nothing has arrived in {self.folder}") from error
            raise

    def events(self) -> DataFrame:
        return self._read("events")

    def rollup(self) -> DataFrame:
        """Per user over all days; equals the rollup of all events that have arrived."""
        return merged(self._read("rollup"))

    def period(self, first, last) -> DataFrame:
        """Per event type from the sketches of the days from ``first`` to ``last``; only these
        partitions are read."""
        days = F.col(DAY).between(date_of(first), date_of(last))
        return from_sketches(self._read("sketches").where(days))
