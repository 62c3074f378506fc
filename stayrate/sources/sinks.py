"""Views, mart tables, CSV exports and the check that they are there."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.sources.digest import differences
from stayrate.sources.raw import CSV_OPTIONS

# Mart names with the row order of their exports ("-" means descending).
MART_ORDER = {
    "mart_user_summary": ("user_id",),
    "mart_churn_cohort": ("cohort_month",),
    "mart_churn_cohort_stacked": ("cohort_month", "-status"),
    "mart_transaction_summary": ("transaction_month", "product", "transaction_type"),
}


def sort_keys(keys):
    return [F.desc(k[1:]) if k.startswith("-") else F.asc(k) for k in keys]


def publish_view(name: str, df: DataFrame) -> DataFrame:
    """Staging tables stay views: nothing is stored, the reader's pruning reaches the source."""
    df.createOrReplaceTempView(name)
    return df


def materialise(name: str, df: DataFrame, folder: str) -> DataFrame:
    """Write a mart as Parquet and read it back.

    The file cuts the lineage: later marts neither recompute it nor depend on executors that
    computed it.
    """
    path = os.path.join(folder, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_marts(marts: dict[str, DataFrame], folder: str) -> dict[str, str]:
    """Write each mart as CSV with header in its row order.

    The sort is a range shuffle, so part files are ordered among themselves and written in
    parallel; the user mart is never squeezed into one file.
    """
    paths = {}
    for name, df in marts.items():
        paths[name] = os.path.join(folder, f"{name}.csv")
        ordered = df.orderBy(*sort_keys(MART_ORDER[name])) if name in MART_ORDER else df
        ordered.write.mode("overwrite").option("header", True).csv(paths[name])
    return paths


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows"
        )
        for name, df in tables.items()
    ]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


def preview(df: DataFrame, n: int, *keys: str) -> DataFrame:
    """The first ``n`` rows by ``keys``: a top-n, not a full sort."""
    return df.orderBy(*sort_keys(keys)).limit(n)


def exported_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    return row_counts({name: spark.read.option("header", True).csv(p) for name, p in paths.items()})


def verify_outputs(spark: SparkSession, paths: dict[str, str]) -> None:
    """Fail unless every export can be read back and has rows."""
    try:
        counts = exported_counts(spark, paths)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"an expected output is missing: {error}") from error
        raise
    empty = [row.table_name for row in counts.collect() if not row.n_rows]
    if empty:
        raise ValueError(f"outputs without rows: {', '.join(sorted(empty))}")


def read_exports(
    spark: SparkSession, paths: dict[str, str], marts: dict[str, DataFrame]
) -> dict[str, DataFrame]:
    """The exports with the types of the marts they were written from."""
    return {
        name: spark.read.schema(marts[name].schema).options(**CSV_OPTIONS).csv(path)
        for name, path in paths.items()
    }


def verify_contents(
    spark: SparkSession, paths: dict[str, str], marts: dict[str, DataFrame]
) -> None:
    """Fail unless every export holds exactly the rows of its mart, in whatever order.

    One pass over each mart and each export; what comes to the driver is a row per column.
    """
    changed = differences(marts, read_exports(spark, paths, marts)).collect()
    if changed:
        names = ", ".join(sorted(f"{r.table_name}.{r.column_name}" for r in changed))
        raise ValueError(f"exports differ from their marts: {names}")


def materialise_bucketed(
    name: str, df: DataFrame, folder: str, key: str, buckets: int | None = None
) -> DataFrame:
    """Write a table hashed into buckets by ``key``, sorted by it inside each, and read it back.

    Tables with the same key and number of buckets join and group by it without a shuffle, once
    for every job that reads them. ``buckets`` defaults to the session's shuffle partitions, so a
    bucket is as large as a partition of a shuffle of that table would be. ``name`` must be new in
    the session's catalog; the files lie below ``folder``. The rows are dealt by key before they are
    written, so there is one file per bucket and not one per bucket and task.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = os.path.join(folder, name)
    dealt = df.repartition(count, F.col(key))
    writer = dealt.write.format("parquet").bucketBy(count, key).sortBy(key)
    writer.option("path", path).saveAsTable(name)
    return spark.table(name)
