"""Users about to be lost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayrate.functions.calendar import date_of
from stayrate.functions.churn import INACTIVE_DAYS
from stayrate.operators.rollups import last_transaction

def churn_candidates(
    transactions: DataFrame, as_of, inactive_days: int = INACTIVE_DAYS
) -> DataFrame:
    """Users whose last transaction is more than ``inactive_days`` ago. Users who never made one
    are not candidates, although the churn flag counts them."""
    cutoff = F.date_sub(date_of(as_of), inactive_days)
    return last_transaction(transactions.where(F.col("user_id").isNotNull())).where(
        F.col("last_transaction_date") < cutoff
    )
