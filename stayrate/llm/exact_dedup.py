"""Exact duplicates by skew-safe combining, with built-in expressions only.

1. Local: every task combines its own equal texts (partial aggregation).
2. Salted: digest groups are combined per salt, the salt being the input partition, so a text that
   fills a third of the table reaches each salt task at most once per input task.
3. Global: the salt winners of a digest are combined. Rows find their winner by salt, too.

The text itself is a grouping key of every stage, so it is the full content that is compared, not
the digest. Rows are matched to their group by digest, a second hash and the length; should two
different texts ever share all three, the job stops instead of merging them.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayrate.llm.common import staged, text_of

KEY = ("digest", "check", "size")
#: A text is large if it has more than one in so many rows; there are at most as many such texts,
#: whatever the table, so their keys are broadcast.
LARGE = 4096


def normalised(text_col: str) -> Column:
    """The text with A-Z lower-cased; null counts as empty."""
    return F.translate(text_of(text_col), string.ascii_uppercase, string.ascii_lowercase)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    content = F.col("content")
    return docs.select(F.col(id_col).alias("id"), normalised(text_col).alias("content")).select(
        "id",
        "content",
        F.unhex(F.sha2(content.cast("binary"), 256)).alias("digest"),
        F.xxhash64(content).alias("check"),
        F.length(content).alias("size"),
    )


def winners(docs: DataFrame, id_col: str, text_col: str, salts: int) -> DataFrame:
    """One row per distinct text: its key, the largest id and the number of rows."""
    best = F.max("id").alias("id"), F.sum("n").alias("n")
    salted = (
        _keyed(docs, id_col, text_col)
        .withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        .groupBy(*KEY, "content", "salt")
        .agg(F.max("id").alias("id"), F.count(F.lit(1)).alias("n"))
    )
    merged = salted.groupBy(*KEY, "content").agg(*best)
    clash = F.raise_error(F.lit("two texts share digest, second hash and length"))
    return merged.groupBy(*KEY).agg(
        F.max("id").alias("keep_id"),
        F.sum("n").alias("group_size"),
        F.count(F.lit(1)).alias("texts"),
    ).withColumn("group_size", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(clash))


def _salted(rows: DataFrame, best: DataFrame, salts: int) -> tuple[DataFrame, DataFrame]:
    """Rows of large texts dealt to salts, and the winners of these texts once per salt.

    Joined on key and salt, no task receives more than its share of a text that fills much of the
    table. Such rows are alike and small when compressed, so their bytes would not show it.
    """
    share = best.agg(F.sum("group_size") / LARGE).scalar()
    is_large = F.col("group_size") > share
    large = best.where(is_large).select(*KEY, F.lit(True).alias("large"))
    salt = F.when(F.col("large"), F.pmod(F.xxhash64("id"), F.lit(salts))).otherwise(0)
    dealt = rows.join(F.broadcast(large), list(KEY), "left").withColumn("salt", salt.cast("int"))
    every = F.when(is_large, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    return dealt.drop("large"), best.withColumn("salt", F.explode(every))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    The row with the largest id of each text is kept. A null text equals the empty one. Rows equal
    in id and text are told apart only by their number: one of them is kept. Null ids lose to any
    other; a group of null ids only keeps one row, with a null keep_id. Other columns are ignored.
    """
    rows = _keyed(docs, id_col, text_col).groupBy(*KEY, "id").agg(F.count(F.lit(1)).alias("n"))
    best = staged(winners(docs, id_col, text_col, salts), "winners")
    rows, best = _salted(rows, best, salts)
    found = rows.join(best, [*KEY, "salt"])
    each = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return each.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_exact(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 64
) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns (one of rows equal in id and text)."""
    names = docs.columns
    best = winners(docs, id_col, text_col, salts).select(
        *(F.col(k).alias(f"_{k}") for k in KEY), F.struct("keep_id").alias("_id")
    )
    content = normalised(text_col)
    keyed = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("_row"),
        F.struct(F.col(id_col).alias("keep_id")).alias("_id"),  # a struct: nulls are equal
        F.unhex(F.sha2(content.cast("binary"), 256)).alias("_digest"),
        F.xxhash64(content).alias("_check"),
        F.length(content).alias("_size"),
    )
    on = [*(f"_{k}" for k in KEY), "_id"]
    kept = keyed.join(best, on, "left_semi")
    one = kept.groupBy(*on).agg(F.min("_row").alias("_row"))
    return one.select("_row.*")
