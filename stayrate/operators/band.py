"""Band joins: pairs of rows of one key whose times lie within a band, without comparing all pairs.

Time is cut into buckets as wide as the band. A right row stands in its own bucket, a left row asks
for the two or three buckets its band can reach, and rows meet on (key, bucket). A key of any size
is thereby spread over the buckets of its time; only pairs of neighbouring buckets are tested.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.functions.calendar import epoch_micros


def _bucket(micros: Column, width: int) -> Column:
    """Floor division, also before 1970."""
    return F.call_function("div", micros - F.pmod(micros, F.lit(width)), F.lit(width))


def band_pairs(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    before_minutes: int = 0,
    after_minutes: int = 0,
) -> DataFrame:
    """Pairs (left_row, right_row), both structs, of equal key whose right time lies between
    ``before_minutes`` before and ``after_minutes`` after the left time, both ends included.

    Every pair comes once. Rows without key or time have no pairs.
    """
    before, after = before_minutes * 60_000_000, after_minutes * 60_000_000
    if before < 0 or after < 0 or before + after == 0:
        raise ValueError("the band needs a width, and its ends cannot be negative")
    width = before + after

    def timed(df: DataFrame, time: str, row: str) -> DataFrame:
        known = df.where(F.col(key).isNotNull() & F.col(time).isNotNull())
        return known.select(
            F.col(key), epoch_micros(F.col(time)).alias(f"{row}_at"), F.struct("*").alias(row)
        )

    lefts = timed(left, left_time, "left_row")
    at = F.col("left_row_at")
    reach = F.sequence(_bucket(at - before, width), _bucket(at + after, width))
    asked = lefts.withColumn("bucket", F.explode(reach))
    rights = timed(right, right_time, "right_row")
    rights = rights.withColumn("bucket", _bucket(F.col("right_row_at"), width))
    apart = F.col("right_row_at") - F.col("left_row_at")
    met = asked.join(rights, [key, "bucket"]).where(apart.between(-before, after))
    return met.select("left_row", "right_row")


def followed_within(
    events: DataFrame, first: str, then: str, minutes: int
) -> DataFrame:
    """Per event of type ``then``: how many events of type ``first`` of the same user lie up to
    ``minutes`` before it, and the latest of them. Events without any are left out."""
    columns = ("event_id", "user_id", "event_ts")
    thens = events.where(F.col("event_type") == then).select(*columns)
    firsts = events.where(F.col("event_type") == first).select(*columns)
    pairs = band_pairs(thens, firsts, "user_id", "event_ts", "event_ts", before_minutes=minutes)
    return pairs.groupBy(F.col("left_row.event_id").alias("event_id")).agg(
        F.max("left_row.user_id").alias("user_id"),
        F.count(F.lit(1)).alias("n_before"),
        F.max("right_row.event_ts").alias("latest_before"),
    )
