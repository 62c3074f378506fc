"""Churn flag, churn label and the flow split they are reported with."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayrate.functions.calendar import date_of

# Labels and the cancelling event, as stored in the tables.
CANCEL_EVENT = "Cancel_Account"
EXPLICIT, SILENT, ACTIVE = "Explicit", "Silent", "Active"
INACTIVE_DAYS = 90


def deposited(amount: Column) -> Column:
    return F.when(amount > 0, amount).otherwise(0)


def withdrawn(amount: Column) -> Column:
    return F.when(amount < 0, F.abs(amount)).otherwise(0)


def days_since(last: Column, as_of) -> Column:
    """Days from ``last`` to ``as_of``; negative for later dates, NULL without a date."""
    return F.datediff(date_of(as_of), last)


def is_inactive(days: Column, inactive_days: int = INACTIVE_DAYS) -> Column:
    """No transaction at all, or strictly more than ``inactive_days`` ago."""
    return days.isNull() | (days > inactive_days)


def churned(days: Column, inactive_days: int = INACTIVE_DAYS) -> Column:
    return F.when(is_inactive(days, inactive_days), 1).otherwise(0)


def churn_type(has_cancel: Column, days: Column, inactive_days: int = INACTIVE_DAYS) -> Column:
    """A cancellation wins even over recent transactions, then inactivity, else active."""
    return (
        F.when(has_cancel, EXPLICIT)
        .when(is_inactive(days, inactive_days), SILENT)
        .otherwise(ACTIVE)
    )
