"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.session import run_folder

#: ASCII white space and its complement, the "words" of every contract.
SPACE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts lineage, survives executors."""
    path = run_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(name: str) -> Column:
    """A text column whose nulls count as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
