"""Dense row numbers and exact samples without a global sort.

Rows are ordered by a 60-bit hash of their key, which spreads any key evenly, and then by the key.
The first bits of the hash make 65,536 ranges. Each range is cut into as many buckets as its counted
rows need, so a bucket holds about ``ROWS_PER_BUCKET`` rows however many there are. The rows before a
range are added up over one row per range, those before a bucket inside its range, and rows are
numbered inside their bucket in parallel. Keys must be unique; rows without a key are placed by a
hash of the whole row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: 16^4 ranges; their totals are one small table, whatever the data.
DIGITS = 4
HASH_BITS = 60
ROWS_PER_BUCKET = 100_000


def _md5_bits(key: Column, seed: str) -> Column:
    """Reproducible in any system that has MD5: the first 15 hex digits as a number."""
    md5 = F.md5(F.concat(key.cast("string"), F.lit(seed)))
    return F.conv(F.substring(md5, 1, 15), 16, 10).cast("bigint")


def _fast_bits(*columns: str) -> Column:
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def _hashed(df: DataFrame, key: str, bits: Column, digits: int) -> DataFrame:
    bits = F.when(F.col(key).isNull(), _fast_bits(*df.columns)).otherwise(bits)
    range_no = F.shiftright("_hash", HASH_BITS - 4 * digits).cast("int")
    return df.withColumn("_hash", bits).withColumn("_range", range_no)


def _ranges(hashed: DataFrame, rows_per_bucket: int) -> DataFrame:
    """Per range: the number of rows in earlier ranges, the total of all, its number of buckets."""
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_range").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    counts = hashed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    return counts.select(
        "_range",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(everything).alias("_total"),
        F.ceil(F.col("_n") / rows_per_bucket).alias("_buckets"),
    )


def _placed(hashed: DataFrame, digits: int, rows_per_bucket: int) -> DataFrame:
    """Rows with their bucket inside the range, and the rows before the range and of all."""
    inner = F.col("_hash").bitwiseAND(F.lit((1 << (HASH_BITS - 4 * digits)) - 1))
    # The 31 leading of the remaining bits, so that the product stays below 2^63.
    spare = max(0, HASH_BITS - 4 * digits - 31)
    share = F.shiftright(inner, spare) * F.col("_buckets")
    bucket = F.shiftright(share, HASH_BITS - 4 * digits - spare).cast("int")
    ranges = F.broadcast(_ranges(hashed, rows_per_bucket))
    return hashed.join(ranges, "_range").withColumn("_bucket", bucket)


def _numbered(placed: DataFrame, key: str, name: str) -> DataFrame:
    """Rows in a range's earlier buckets are counted by one window over its bucket totals."""
    whole = Window.partitionBy("_range").orderBy("_bucket")
    totals = placed.groupBy("_range", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = F.sum("_n").over(whole.rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(
        "_range", "_bucket", F.coalesce(earlier, F.lit(0)).alias("_inside")
    )
    inside = F.row_number().over(Window.partitionBy("_range", "_bucket").orderBy("_hash", key))
    found = placed.join(offsets, ["_range", "_bucket"])
    return found.withColumn(name, F.col("_before") + F.col("_inside") + inside)


def with_position(
    df: DataFrame,
    key: str,
    name: str = "position",
    digits: int = DIGITS,
    seed: str | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Adds the row's number 1 … n in hash order; with a ``seed``, in the order of its MD5, which
    other systems can repeat."""
    bits = _fast_bits(key) if seed is None else _md5_bits(F.col(key), seed)
    placed = _placed(_hashed(df, key, bits, digits), digits, rows_per_bucket)
    return _numbered(placed, key, name).select(*df.columns, name)


def sample_fraction(
    df: DataFrame,
    key: str,
    fraction: float,
    seed: str = "",
    name: str = "position",
    digits: int = DIGITS,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Exactly ``max(1, int(n * fraction))`` rows without replacement (none if n = 0), numbered.

    The sample is the first rows in the order of the seeded MD5, hence repeatable here and
    elsewhere. Ranges behind the last chosen row are dropped before the shuffle.
    """
    hashed = _hashed(df, key, _md5_bits(F.col(key), seed), digits)
    wanted = F.greatest(F.floor(F.col("_total") * F.lit(float(fraction))), F.lit(1))
    placed = _placed(hashed, digits, rows_per_bucket).where(F.col("_before") < wanted)
    chosen = _numbered(placed, key, name).where(F.col(name) <= wanted)
    return chosen.select(*df.columns, name)


def with_batches(
    df: DataFrame, key: str, size: int, digits: int = DIGITS, seed: str | None = None
) -> DataFrame:
    """Adds ``batch_no`` 0, 1, …: every batch has ``size`` rows, only the last may have fewer."""
    numbered = with_position(df, key, "_position", digits, seed)
    batch = F.call_function("div", F.col("_position") - 1, F.lit(size).cast("bigint"))
    return numbered.withColumn("batch_no", batch).drop("_position")
