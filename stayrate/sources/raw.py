"""Raw users, transactions and events from CSV or Parquet."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Raw column names and types. Schemas are stated, not inferred: inference costs a
# pass over the text and would make money a double.
RAW_SCHEMAS = {
    "users": T.StructType(
        [
            T.StructField("User_ID", T.LongType()),
            T.StructField("Signup_Date", T.DateType()),
            T.StructField("Acquisition_Channel", T.StringType()),
            T.StructField("Account_Type", T.StringType()),
            T.StructField("State", T.StringType()),
            T.StructField("Age_Group", T.StringType()),
        ]
    ),
    "transactions": T.StructType(
        [
            T.StructField("Transaction_ID", T.LongType()),
            T.StructField("User_ID", T.LongType()),
            T.StructField("Transaction_Date", T.DateType()),
            T.StructField("Amount_USD", T.DecimalType(18, 2)),
            T.StructField("Transaction_Type", T.StringType()),
            T.StructField("Product", T.StringType()),
            T.StructField("Round_Up", T.DecimalType(18, 2)),
        ]
    ),
    "events": T.StructType(
        [
            T.StructField("Event_ID", T.LongType()),
            T.StructField("User_ID", T.LongType()),
            T.StructField("Event_Date", T.DateType()),
            T.StructField("Event_Type", T.StringType()),
            T.StructField("Platform", T.StringType()),
            T.StructField("Session_Duration_Sec", T.LongType()),
        ]
    ),
}


#: For files and streams alike: headers are checked, malformed rows stop the job.
CSV_OPTIONS = {"header": True, "enforceSchema": False, "mode": "FAILFAST"}


def read_table(spark: SparkSession, name: str, path: str, fmt: str = "csv") -> DataFrame:
    """One raw table. A missing path raises FileNotFoundError naming table and path.

    CSV headers are checked against the schema, and a malformed row fails the job: dropping it
    or reading it as NULLs would silently change every number computed from it.
    """
    try:
        if fmt == "csv":
            return spark.read.schema(RAW_SCHEMAS[name]).options(**CSV_OPTIONS).csv(path)
        if fmt == "parquet":
            return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"table '{name}' not found: {path}") from error
        raise
    raise ValueError(f"fmt must be csv or parquet, not {fmt!r}")


def read_raw(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """All raw tables of a folder: ``users.csv``, ``transactions.csv``, ``events.csv`` (or
    ``.parquet``), each a file or a folder of part files."""
    return {
        name: read_table(spark, name, os.path.join(folder, f"{name}.{fmt}"), fmt)
        for name in RAW_SCHEMAS
    }
