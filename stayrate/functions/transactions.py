"""Value rules of single transactions and of a user's activity window."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayrate.functions.calendar import date_of
from stayrate.functions.numbers import money

# Transaction types with a rule of their own.
WITHDRAWAL, ROUND_UP = "Withdrawal", "Round-Up"


def signed_amount(transaction_type: Column, amount: Column) -> Column:
    return F.when(transaction_type == WITHDRAWAL, -amount).otherwise(amount)


def round_up(transaction_type: Column, amount: Column) -> Column:
    """Spare change to the next whole dollar on Round-Up rows, else 0."""
    amount = money(amount)
    return money(F.when(transaction_type == ROUND_UP, F.ceil(amount) - amount).otherwise(0))
