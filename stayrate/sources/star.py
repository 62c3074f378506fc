"""Stand-in raw tables from the star-schema Parquet tables.

customer / orders / events hold no account types, ages or platforms, so those columns are derived
from keys and existing columns. The rows are all of the source rows; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayrate.functions.numbers import MONEY
from stayrate.functions.transactions import round_up, signed_amount

# How source codes map to the domain's values.
ACCOUNT_TYPES = ("Banking", "Invest", "Both")
AGE_GROUPS = ("18-24", "25-34", "35-44", "45-54", "55+")
PLATFORMS = ("iOS", "Android", "Web")
TRANSACTION_TYPES = {
    "1-URGENT": "One-Time Deposit",
    "2-HIGH": "Recurring Deposit",
    "3-MEDIUM": "Withdrawal",
    "4-NOT SPECIFIED": "Round-Up",
    "5-LOW": "Round-Up",
}
EVENT_TYPES = {
    "signup": "Login",
    "view": "View_Portfolio",
    "purchase": "Deposit",
    "click": "Withdrawal",
}
CANCEL_ABOVE = 200


# The columns used, with their stored types. A stated schema saves the job that
# would read file footers to infer it.
SCHEMAS = {
    "customer": "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def read_star(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: tuple[str, ...], key: str) -> str:
    """SQL that spreads values over a key."""
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast(pmod({key}, {len(values)}) as int) + 1)"


def _map(values: dict[str, str], code: str, otherwise: str = "NULL") -> str:
    """SQL that translates codes."""
    branches = " ".join(f"WHEN {code} = '{a}' THEN '{b}'" for a, b in values.items())
    return f"CASE {branches} ELSE {otherwise} END"


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer with its nation; the signup date is the customer's first order date."""
    first_order = (
        read_star(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").alias("first_order"))
    )
    nation = read_star(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
    return (
        read_star(spark, sf_dir, "customer")
        .join(first_order, "c_custkey", "left")
        .join(nation, "c_nationkey", "left")
        .selectExpr(
            "c_custkey AS User_ID",
            "cast(first_order AS date) AS Signup_Date",
            "c_mktsegment AS Acquisition_Channel",
            f"{_pick(ACCOUNT_TYPES, 'c_custkey')} AS Account_Type",
            "n_name AS State",
            f"{_pick(AGE_GROUPS, 'c_custkey')} AS Age_Group",
        )
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders; the priority gives the type, the type the sign and the round-up."""
    kind, price = F.col("Transaction_Type"), F.col("price")
    orders = read_star(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS Transaction_ID",
        "o_custkey AS User_ID",
        "cast(o_orderdate AS date) AS Transaction_Date",
        f"cast(o_totalprice AS {MONEY}) AS price",
        f"{_map(TRANSACTION_TYPES, 'o_orderpriority')} AS Transaction_Type",
        "CASE WHEN o_orderstatus = 'F' THEN 'Banking' ELSE 'Invest' END AS Product",
    )
    return orders.select(
        "Transaction_ID",
        "User_ID",
        "Transaction_Date",
        signed_amount(kind, price).alias("Amount_USD"),
        kind,
        "Product",
        round_up(kind, price).alias("Round_Up"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events; errors with a large value stand for cancellations, the others for statement views."""
    error = f"CASE WHEN value > {CANCEL_ABOVE} THEN 'Cancel_Account' ELSE 'View_Statement' END"
    return read_star(spark, sf_dir, "events").selectExpr(
        "event_id AS Event_ID",
        "user_id AS User_ID",
        "cast(ts AS date) AS Event_Date",
        "ts AS Event_Ts",
        f"{_map(EVENT_TYPES, 'event_type', error)} AS Event_Type",
        f"{_pick(PLATFORMS, 'event_id')} AS Platform",
        "cast(value AS decimal(12,2)) AS Session_Duration_Sec",
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "users": raw_users(spark, sf_dir),
        "transactions": raw_transactions(spark, sf_dir),
        "events": raw_events(spark, sf_dir),
    }
