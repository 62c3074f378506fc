"""As-of joins: to each row the latest row of another table, of the same key, at or before its time.

Both tables are put under one another and the last row of the other table is carried forward by a
window, so nothing is compared in pairs. Keys with too many rows for one task are cut into ranges of
time: inside a range the window works as for any key, and a range that begins without a row of the
other table takes the last one of the ranges before it, of which there is one row per range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stayrate.operators.skew import ROWS_PER_TASK, hot_keys, only_hot, without_hot

_CARRIED = ("_found", "_at")


def _under_one_another(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, order: str, columns
) -> DataFrame:
    """Rows (key, _ts, _side, _order, _row, _found, _at): right rows sort before left ones."""
    kind = left.select(F.struct("*").alias("r")).schema["r"].dataType
    found = F.struct(*columns)
    found_kind = right.select(found.alias("f")).schema["f"].dataType
    order_kind = right.schema[order].dataType
    ts = right.schema[right_time].dataType
    rights = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(key),
        F.col(right_time).cast("timestamp_ntz").alias("_ts"),
        F.lit(0).alias("_side"),
        F.col(order).alias("_order"),
        F.lit(None).cast(kind).alias("_row"),
        found.alias("_found"),
        F.col(right_time).cast(ts).alias("_at"),
    )
    lefts = left.select(
        F.col(key),
        F.col(left_time).cast("timestamp_ntz").alias("_ts"),
        F.lit(1).alias("_side"),
        F.lit(None).cast(order_kind).alias("_order"),
        F.struct("*").alias("_row"),
        F.lit(None).cast(found_kind).alias("_found"),
        F.lit(None).cast(ts).alias("_at"),
    )
    return rights.unionByName(lefts)


def _carried(rows: DataFrame, key: str, *parts: str) -> DataFrame:
    """The last right row at or before each row, inside the given parts of a key."""
    order = Window.partitionBy(key, *parts).orderBy("_ts", "_side", "_order")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = [F.last(c, ignorenulls=True).over(so_far).alias(f"{c}_last") for c in _CARRIED]
    return rows.select("*", *last)


def _over_ranges(rows: DataFrame, key: str) -> DataFrame:
    """``_carried`` for hot keys, cut into balanced ranges of (key, time)."""
    order = (key, "_ts", "_side", "_order")
    ranged = rows.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id())
    inside = _carried(ranged, key, "_slice")
    # Per key and range the last right row in it; then that of all ranges before.
    place = F.struct("_ts", "_order")
    ends = ranged.where("_side = 0").groupBy(key, "_slice").agg(
        *(F.max_by(c, place).alias(f"{c}_end") for c in _CARRIED)
    )
    present = ranged.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = present.join(ends, [key, "_slice"], "left").select(
        key,
        "_slice",
        *(F.last(f"{c}_end", ignorenulls=True).over(earlier).alias(f"{c}_before") for c in _CARRIED),
    )
    joined = inside.where("_side = 1").join(before, [key, "_slice"], "left")
    settled = [F.coalesce(f"{c}_last", f"{c}_before").alias(f"{c}_last") for c in _CARRIED]
    return joined.select(key, "_ts", "_side", "_row", *settled)


def as_of(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    order: str,
    columns: Sequence[str],
    within: str | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Every left row once, with ``columns`` of the latest right row at or before its time.

    Right rows of one time are told apart by ``order``, the greatest counts. ``within`` (an interval
    such as ``'2 hours'``) leaves out right rows that are older. Without a right row, key or time
    the columns are NULL; right rows without key or time fit nothing. Dates count as midnight.
    ``columns`` must not be columns of ``left``.
    """
    both = _under_one_another(left, right, key, left_time, right_time, order, list(columns))
    known = both.where(F.col(key).isNotNull() & F.col("_ts").isNotNull())
    hot = hot_keys(known, key, rows_per_task)
    regular = _carried(without_hot(known, hot, key), key).where("_side = 1")
    big = _over_ranges(only_hot(known, hot, key), key)
    lost = both.where(F.col(key).isNull() | F.col("_ts").isNull())
    lost = lost.withColumns({f"{c}_last": F.col(c) for c in _CARRIED})
    wanted = ["_ts", "_row", "_found_last", "_at_last"]
    rows = regular.select(*wanted).unionByName(big.select(*wanted)).unionByName(lost.select(*wanted))
    found = F.col("_found_last")
    if within is not None:
        since = F.col("_ts") - F.expr(f"INTERVAL {within}")
        found = F.when(F.col("_at_last").cast("timestamp_ntz") >= since, found)
    return rows.select("_row.*", found.alias("_f")).select("*", *(F.col(f"_f.{c}") for c in columns)).drop("_f")
