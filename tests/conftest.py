import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stayrate.session import build_session

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as a sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def day(text):
    return dt.date.fromisoformat(text)


USERS = (
    "user_id bigint, signup_date date, acquisition_channel string, account_type string, "
    "state string, age_group string"
)
TX = (
    "transaction_id bigint, user_id bigint, transaction_date date, amount_usd decimal(18,2), "
    "transaction_type string, product string, round_up decimal(18,2)"
)
EVENTS = (
    "event_id bigint, user_id bigint, event_date date, event_ts timestamp_ntz, "
    "event_type string, platform string, session_duration_sec bigint"
)


@pytest.fixture
def make(spark):
    """Staging tables from short tuples."""

    class Make:
        def users(self, *entries):
            """(user_id, signup_date, **overrides)"""
            full = []
            for entry in entries:
                user_id, signup, *rest = entry
                base = {"channel": "Email", "account": "Both", "state": "CA", "age": "18-24"}
                base.update(rest[0] if rest else {})
                signup = day(signup) if signup else None
                full.append(
                    (user_id, signup, base["channel"], base["account"], base["state"], base["age"])
                )
            return spark.createDataFrame(full, USERS)

        def tx(self, *entries):
            """(user_id, date, amount, type, product, round_up), the last three optional"""
            from decimal import Decimal

            full = []
            for i, (user_id, date, amount, *rest) in enumerate(entries, start=1):
                kind, product, up = (list(rest) + ["One-Time Deposit", "Banking", "0"][len(rest):])
                amount = None if amount is None else Decimal(str(amount))
                full.append(
                    (i, user_id, day(date), amount, kind, product,
                     None if up is None else Decimal(str(up)))
                )
            return spark.createDataFrame(full, TX)

        def events(self, *entries):
            """(user_id, timestamp or date, type, session), the last one optional"""
            full = []
            for i, (user_id, when, kind, *rest) in enumerate(entries, start=1):
                ts = dt.datetime.fromisoformat(when)
                session = rest[0] if rest else 60
                full.append((i, user_id, ts.date(), ts, kind, "Web", session))
            return spark.createDataFrame(full, EVENTS)

    return Make()
