"""What a table contains, as a few numbers per column that do not depend on the order of its rows.

A column's digest adds up a 60-bit hash of every value as DECIMAL, so equal rows count as often as
they occur and parts can be added in any order. The column ``*`` holds the digest of whole rows: it
also differs when values change places between rows. The hash is the start of an MD5 of the value
written as text, so other systems can check it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW = "*"
NULL = "\\N"


def as_text(column: str, kind: T.DataType) -> Column:
    """A value as text that all systems write alike; fractions count in millionths."""
    value = F.col(f"`{column}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = F.floor(value * 1e6 + 0.5)
    return value.cast("string")


def _hash(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")


def content_digest(df: DataFrame) -> DataFrame:
    """One row per column and one for whole rows: column_name, n_rows, n_nulls, digest (text).

    All columns come from one pass over the table. An empty table has the digest 0.
    """
    texts = {f.name: as_text(f.name, f.dataType) for f in df.schema}
    whole = F.concat_ws("|", *(F.coalesce(t, F.lit(NULL)) for t in texts.values()))
    sums, n = [], len(texts)
    for i, text in enumerate([*texts.values(), whole]):
        sums += [F.sum(_hash(text)).alias(f"d{i}"), F.count_if(text.isNull()).alias(f"n{i}")]
    totals = df.agg(F.count(F.lit(1)).alias("n_rows"), *sums)
    zero = F.lit(0).cast("decimal(38,0)")
    rows = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(f"n{i}").alias("n_nulls"),
            F.coalesce(F.col(f"d{i}"), zero).cast("string").alias("digest"),
        )
        for i, name in enumerate([*texts, ROW])
    ]
    return totals.select("n_rows", F.inline(F.array(*rows))).select(
        "column_name", "n_rows", "n_nulls", "digest"
    )


def digests(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``content_digest`` of several tables, with ``table_name``."""
    parts = [
        content_digest(df).select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def differences(expected: Mapping[str, DataFrame], found: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, column_name) in which two sets of tables do not hold the same rows.

    A table or column that only one side has counts as different.
    """
    keys = ["table_name", "column_name"]
    a, b = (
        digests(t).select(*keys, F.struct("n_rows", "n_nulls", "digest").alias(side))
        for t, side in ((expected, "a"), (found, "b"))
    )
    return a.join(b, keys, "full").where(~F.col("a").eqNullSafe(F.col("b"))).select(*keys)
