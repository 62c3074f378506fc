"""Segments, retention, engagement and triggers."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from stayrate.operators import retention, segments, staging, triggers


@pytest.fixture
def summary(spark):
    entries = [
        (1, 1, "Explicit", "CA", "Email"), (2, 0, "Active", "CA", "Email"), (3, 1, "Silent", "TX", None),
        (4, 0, "Active", "NY", "Organic"), (5, 0, "Active", None, "Organic"), (6, 0, None, "CA", "Organic"),
    ]
    return spark.createDataFrame(
        entries, "user_id bigint, churned int, churn_type string, state string, acquisition_channel string"
    )


def test_churn_by(summary):
    got = [tuple(r) for r in segments.churn_by(summary, "state").collect()]
    assert got == [("TX", 1, 1, 100.0), ("CA", 1, 3, 33.33), ("NY", 0, 1, 0.0)]
    assert [r.state for r in segments.churn_by(summary, "state", top=2).collect()] == ["TX", "CA"]
    each = segments.churn_by_each(summary, ["state", "acquisition_channel"])
    assert rows(each.where("dimension = 'state'").drop("dimension")) == sorted(got, key=repr)
    assert rows(each.where("dimension = 'acquisition_channel'"), "segment") == [("Email",), ("Organic",)]


def test_headline_of_no_users(summary):
    assert rows(segments.headline(summary.limit(0))) == [(0, 0, None)]


def test_value_counts(summary):
    got = [tuple(r) for r in segments.value_counts(summary, "churn_type").collect()]
    assert got == [("Active", 3), ("Explicit", 1), ("Silent", 1)]


def test_step_reach(make):
    users = make.users(
        (1, "2025-01-01"), (2, "2025-01-01"), (3, "2025-01-01", {"account": "Invest"}),
        (4, "2025-01-01", {"account": None}),
    )
    events = make.events(
        (1, "2025-01-02", "Login"), (1, "2025-01-01", "Deposit"), (1, "2025-01-02", "Deposit"),
        (2, "2025-01-02", "Deposit"),  # deposit without login
        (3, "2025-01-02", "Deposit"), (4, "2025-01-02", "Login"), (9, "2025-01-02", "Login"),
    )
    got = segments.step_reach(events, users, "account_type", "Login", ["Deposit", "Withdrawal"])
    assert rows(got) == [
        ("Both", "Deposit", 2, 200.0), ("Both", "Login", 1, 100.0), ("Both", "Withdrawal", 0, 0.0),
        ("Invest", "Deposit", 1, None), ("Invest", "Login", 0, None), ("Invest", "Withdrawal", 0, None),
    ]


def test_segment_counts_and_sessions(make, summary):
    users = make.users((1, "2025-01-01"), (2, "2025-01-01", {"account": "Invest"}))
    events = make.events(
        (1, "2025-01-01", "Login", 10), (1, "2025-01-02", "Login", 20), (2, "2025-01-01", "Login", 40),
        (9, "2025-01-01", "Login", 99),
    )
    got = segments.segment_counts(events, users, ["platform", "account_type"])
    assert rows(got) == [
        ("account_type", "Both", "Login", 2, 1), ("account_type", "Invest", "Login", 1, 1),
        ("platform", "Web", "Login", 4, 3),
    ]
    assert rows(segments.session_stats(events, summary)) == [("Login", 0, 1, 40.0), ("Login", 1, 2, 15.0)]


def test_retention_grid(make):
    users = make.users((1, "2025-01-15"), (2, "2025-01-31"), (3, "2025-02-01"), (4, "2025-04-01"))
    events = make.events(
        (1, "2025-01-01", "Login"),  # signup month, though before the day
        (1, "2025-03-31", "Login"), (1, "2025-03-01", "Login"), (2, "2025-03-02", "Deposit"),
        (3, "2025-01-31", "Login"),  # before signup
        (3, "2025-03-05", "Login"), (1, "2025-04-02", "Login"),  # after as_of
    )
    got = retention.retention(events, users, "2025-03-31", "month")
    jan, feb = day("2025-01-01"), day("2025-02-01")
    assert sorted(rows(got)) == [
        (jan, 0, 2, 1, 50.0), (jan, 1, 2, 0, 0.0), (jan, 2, 2, 2, 100.0),
        (feb, 0, 1, 0, 0.0), (feb, 1, 1, 1, 100.0),
    ]
    logins = retention.retention(events, users, "2025-03-31", "month", "Login", "account_type")
    assert (jan, "Both", 2, 2, 1, 50.0) in rows(logins)


def test_first_activity(make):
    events = make.events((1, "2025-01-03", "Login"), (1, "2025-01-02", "Login"), (None, "2025-01-01", "Login"))
    assert rows(retention.first_activity(events)) == [(1, day("2025-01-02"))]


def test_events_per_user_and_crossover(make, summary):
    events = make.events(
        (1, "2025-01-01", "Login"), (1, "2025-01-02", "Login"), (1, "2025-01-03", "Login"),
        (3, "2025-01-03", "Login"), (2, "2025-01-03", "Login"),  # January: churned 2.0, retained 1.0
        (2, "2025-02-01", "Login"), (2, "2025-02-02", "Login"), (1, "2025-02-02", "Deposit"),
        (2, "2025-03-01", "Login"), (2, "2025-03-02", "Login"), (1, "2025-03-02", "Login"),
    )
    series = retention.events_per_user(events, summary, "churned", "Login", "month")
    assert rows(series) == [
        (day("2025-01-01"), 0, 1, 1, 1.0), (day("2025-01-01"), 1, 4, 2, 2.0),
        (day("2025-02-01"), 0, 2, 1, 2.0), (day("2025-03-01"), 0, 2, 1, 2.0),
        (day("2025-03-01"), 1, 1, 1, 1.0),
    ]

    def cross(a, b):
        return rows(retention.crossover(series, "period_start", "churned", "events_per_user", a, b))

    assert cross(0, 1) == [(day("2025-02-01"), 2.0, 0.0)]
    assert cross(1, 0) == []  # ahead from the start, never overtakes


def test_active_share(make):
    users = make.users((1, "2025-01-15"), (2, "2025-02-10"), (3, "2025-04-10"))
    events = make.events(
        (1, "2025-01-20", "Login"), (1, "2025-01-21", "Login"), (1, "2025-03-01", "Login"),
        (2, "2025-03-01", "Login"), (9, "2025-03-01", "Login"),
    )
    assert sorted(rows(retention.active_share(events, users))) == [
        (day("2025-01-01"), 1, 1, 100.0), (day("2025-02-01"), 0, 2, 0.0),
        (day("2025-03-01"), 2, 2, 100.0), (day("2025-04-01"), 0, 3, 0.0),
    ]


def test_inactive_users(make):
    users = make.users((1, "2025-01-01"), (2, "2025-01-01"), (3, "2025-01-01"))
    events = make.events((1, "2025-01-16", "Login"), (2, "2025-01-17", "Login"), (1, "2025-01-30", "Deposit"))
    assert rows(triggers.inactive_users(events, users, "2025-01-31", 14)) == [
        (1, day("2025-01-16"), 15, "lapsed"), (3, None, None, "never"),
    ]
    assert rows(triggers.inactive_users(events, users, "2025-01-31", 14, None), "user_id") == [(3,)]
    later = make.events((1, "2025-01-01", "Login"), (1, "2025-03-01", "Login"))
    found = triggers.inactive_users(later, users.where("user_id = 1"), "2025-02-01", 14)
    assert rows(found) == [(1, day("2025-01-01"), 31, "lapsed")]


def test_stalled_users(make):
    events = make.events(
        (1, "2025-01-01 10:00:00", "Login"), (1, "2025-01-01 09:00:00", "Deposit"),
        (2, "2025-01-01 10:00:00", "Login"), (2, "2025-01-01 11:00:00", "Deposit"),
        (3, "2025-01-01 12:00:00", "Login"),  # exactly 48 hours
        (4, "2025-01-01 12:00:01", "Login"),
        (5, "2025-01-01 10:00:00", "Login"), (5, "2025-01-04 10:00:00", "Deposit"),  # after as_of
        (6, "2025-01-01 10:00:00", "Deposit"),
    )
    got = triggers.stalled_at(events, "Login", "Deposit", "2025-01-03 12:00:00", 48)
    at_ten = dt.datetime(2025, 1, 1, 10)
    assert rows(got) == [
        (1, at_ten, 50), (3, dt.datetime(2025, 1, 1, 12), 48), (5, at_ten, 50),
    ]


def test_favourite_deposit(make):
    tx = make.tx(
        (1, "2025-01-01", 20), (1, "2025-01-02", 20), (1, "2025-01-03", 5), (1, "2025-01-03", -7),
        (2, "2025-01-01", 9), (2, "2025-01-01", 8), (3, "2025-01-01", -8),
    )
    assert rows(triggers.favourite_deposit(tx)) == [(1, Decimal("20.00"), 2), (2, Decimal("8.00"), 1)]


def test_ingest_window(make):
    events = make.events((1, "2025-01-01", "Login"), (1, "2025-01-02", "Login"), (1, "2026-03-02", "Login"))
    assert rows(staging.ingest_window(events, "2026-01-02"), "event_id") == [(2,), (3,)]


def test_facts_with(make):
    users = make.users((1, "2025-01-01"))
    events = make.events((1, "2025-01-01", "Login"), (2, "2025-01-01", "Login"), (None, "2025-01-01", "Login"))
    got = segments.facts_with(events, users, "account_type")
    assert rows(got, "event_id", "account_type") == [(1, "Both"), (2, None), (3, None)]
    assert rows(staging.events_of_type(events, "Login", "Deposit"), "event_id") == [(1,), (2,), (3,)]


def test_segment_combinations(make):
    users = make.users((1, "2025-01-01"), (2, "2025-01-01", {"account": "Invest"}), (3, "2025-01-01", {"account": None}))
    events = make.events(
        (1, "2025-01-01", "Login"), (1, "2025-01-02", "Login"), (2, "2025-01-02", "Login"),
        (3, "2025-01-02", "Login"), (9, "2025-01-02", "Deposit"), (None, "2025-01-02", "Login"),
    )
    mixed = events.withColumn("platform", F.expr("if(event_id in (2, 5), 'iOS', platform)"))
    got = rows(segments.segment_combinations(mixed, users, ("platform", "account_type")))
    assert got == sorted([
        # user 1 has two platforms and counts once where the platform is left out
        ("account_type", "Login", None, "Both", 2, 1), ("account_type", "Login", None, "Invest", 1, 1),
        ("platform", "Deposit", "iOS", None, 1, 1),  # an unknown user has a platform, but no account
        ("platform", "Login", "Web", None, 3, 3), ("platform", "Login", "iOS", None, 1, 1),
        ("platform & account_type", "Login", "Web", "Both", 1, 1),
        ("platform & account_type", "Login", "Web", "Invest", 1, 1),
        ("platform & account_type", "Login", "iOS", "Both", 1, 1),
    ], key=repr)
    one = segments.segment_combinations(mixed, users, ("platform", "account_type"), [("account_type", "platform")])
    assert rows(one) == [r for r in got if "&" in r[0]]
    assert segments.segment_combinations(mixed.limit(0), users, ("platform",)).count() == 0
    with pytest.raises(ValueError, match="at least one"):
        segments.segment_combinations(mixed, users, ("platform",), [()])
