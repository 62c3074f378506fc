"""Rollups, labels, cohorts and the transaction summary on the hand-made edge cases."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import day, rows

from stayrate.operators import cohorts, rollups, segments

AS_OF = "2026-05-05"


@pytest.fixture
def edge(make):
    signup = "2025-06-14"
    users = make.users(*[(i, signup) for i in range(1, 11)])
    tx = make.tx(
        (1, "2026-02-04", 10),  # 90 days
        (2, "2026-02-03", 10),  # 91 days
        # 3: none
        (4, "2025-07-01", 10),  # cancelled, inactive
        (5, "2026-05-01", 10),  # cancelled, still active
        # 6: cancel event only
        (7, "2026-04-01", 10),  # several cancel events
        (8, "2026-05-10", 10),  # in the future
        (9, "2026-04-01", 0),
        (9, "2026-04-02", None, "One-Time Deposit", "Banking", None),
        (10, "2026-03-01", 20.5),
        (10, "2026-03-05", "-5.25", "Withdrawal"),
        (10, "2026-03-03", "1.40", "Round-Up", "Banking", "0.60"),
        (99, "2026-04-01", 500),  # unknown user
        (None, "2026-04-01", 700),
    )
    events = make.events(
        (4, "2025-07-01", "Cancel_Account"),
        (5, "2025-07-01", "Cancel_Account"),
        (6, "2025-07-01", "Cancel_Account"),
        (7, "2025-07-01", "Cancel_Account"),
        (7, "2025-07-02", "Cancel_Account"),
        (10, "2026-03-01", "Login", 100),
        (10, "2026-03-09", "Deposit", 51),
        (10, "2026-03-02", "Deposit", None),
        (99, "2026-03-01", "Login"),
        (None, "2026-03-01", "Cancel_Account"),
    )
    return users, tx, events


def test_labels(edge):
    summary = rollups.user_summary(*edge, as_of=AS_OF)
    got = rows(summary, "user_id", "churned", "churn_type", "days_since_last_transaction")
    assert sorted(got) == [
        (1, 0, "Active", 90),
        (2, 1, "Silent", 91),
        (3, 1, "Silent", None),
        (4, 1, "Explicit", 308),
        (5, 0, "Explicit", 4),
        (6, 1, "Explicit", None),
        (7, 0, "Explicit", 34),
        (8, 0, "Active", -5),
        (9, 0, "Active", 33),
        (10, 0, "Active", 61),
    ]
    assert len(summary.columns) == 19


def test_metrics(edge):
    by_user = {r.user_id: r for r in rollups.user_summary(*edge, as_of=AS_OF).collect()}
    money = ("total_deposited", "total_withdrawn", "total_round_ups", "running_balance")
    assert [by_user[10][m] for m in money] == [
        Decimal("21.90"), Decimal("5.25"), Decimal("0.60"), Decimal("16.65"),
    ]
    assert by_user[10].total_transactions == 3
    assert by_user[10].first_transaction_date == day("2026-03-01")
    assert by_user[10].last_transaction_date == day("2026-03-05")
    assert by_user[10].total_events == 3
    assert by_user[10].last_event_date == day("2026-03-09")
    assert by_user[10].avg_session_duration_sec == 75.5
    assert by_user[9].total_transactions == 2  # zero and NULL amounts count, but add nothing
    assert [by_user[9][m] for m in money] == [0, 0, 0, 0]
    assert [by_user[3][m] for m in money] == [0, 0, 0, 0]
    assert by_user[3].first_transaction_date is None
    assert (by_user[1].total_events, by_user[1].last_event_date) == (0, None)
    assert by_user[1].avg_session_duration_sec == 0.0


def test_other_thresholds(edge):
    summary = rollups.user_summary(*edge, as_of=AS_OF, inactive_days=60)
    assert {r.user_id for r in summary.where("churned = 1").collect()} == {1, 2, 3, 4, 6, 10}


def test_cancelled_and_last_transaction(edge):
    _, tx, events = edge
    assert {r.user_id for r in rollups.cancelled_users(events).collect()} == {4, 5, 6, 7, None}
    last = {r.user_id: r.last_transaction_date for r in rollups.last_transaction(tx).collect()}
    assert last[10] == day("2026-03-05") and last[99] == day("2026-04-01")


def test_profile_is_one_user(edge):
    assert rows(rollups.user_profile(rollups.user_summary(*edge, as_of=AS_OF), 7), "user_id") == [(7,)]


def test_transaction_summary_keeps_unknown_users(edge):
    got = rows(cohorts.transaction_summary(edge[1]).where("transaction_month = '2026-04-01'"))
    zero = Decimal("0.00")
    assert got == [
        (day("2026-04-01"), "Banking", "One-Time Deposit", 5, Decimal("1210.00"), zero, zero,
         Decimal("1210.00")),
    ]


def test_flow_by_product_type(edge):
    flows = cohorts.flow_by_product_type(cohorts.transaction_summary(edge[1]))
    assert rows(flows) == [
        ("Banking", "One-Time Deposit", 11, Decimal("1280.50")),
        ("Banking", "Round-Up", 1, Decimal("1.40")),
        ("Banking", "Withdrawal", 1, Decimal("-5.25")),
    ]


def test_month_start_of_leap_day(make):
    summary = rollups.user_summary(
        make.users((1, "2024-02-29"), (2, "2024-02-01")), make.tx((1, "2024-03-01", 1)),
        make.events((1, "2024-03-01", "Login")), as_of="2024-03-02",
    )
    assert rows(cohorts.churn_cohort(summary), "cohort_month", "total_users") == [
        (day("2024-02-01"), 2)
    ]


# Published cohort results (month, users, explicit, silent, rates in percent).
PUBLISHED = [
    ("2025-05-01", 41, 2, 10, 29.3, 4.9, 24.4),
    ("2025-06-01", 40, 3, 6, 22.5, 7.5, 15.0),
    ("2025-07-01", 44, 3, 10, 29.5, 6.8, 22.7),
    ("2025-08-01", 42, 4, 5, 21.4, 9.5, 11.9),
    ("2025-09-01", 34, 3, 0, 8.8, 8.8, 0.0),
    ("2025-10-01", 37, 0, 2, 5.4, 0.0, 5.4),
    ("2025-11-01", 31, 0, 3, 9.7, 0.0, 9.7),
    ("2025-12-01", 49, 0, 1, 2.0, 0.0, 2.0),
    ("2026-01-01", 44, 0, 0, 0.0, 0.0, 0.0),
    ("2026-02-01", 40, 0, 0, 0.0, 0.0, 0.0),
    ("2026-03-01", 42, 0, 0, 0.0, 0.0, 0.0),
    ("2026-04-01", 52, 0, 0, 0.0, 0.0, 0.0),
    ("2026-05-01", 4, 0, 0, 0.0, 0.0, 0.0),
]


@pytest.fixture
def published(make):
    users, tx, events = [], [], []
    for month, total, explicit, silent, *_ in PUBLISHED:
        signup = day(month)
        for i in range(total):
            user_id = len(users) + 1001
            users.append((user_id, (signup + dt.timedelta(days=i % 4)).isoformat()))
            gone = i < explicit + silent
            tx.append((user_id, "2026-01-31" if gone else "2026-05-04", 5))
            kind = "Cancel_Account" if i < explicit else "Login"
            events.append((user_id, "2026-01-31", kind))
    return make.users(*users), make.tx(*tx), make.events(*events)


def test_published_cohorts(published):
    summary = rollups.user_summary(*published, as_of=AS_OF).cache()
    cohort = cohorts.churn_cohort(summary)
    expected = [
        (day(m), n, e + s, n - e - s, rate, e, s, e_rate, s_rate)
        for m, n, e, s, rate, e_rate, s_rate in PUBLISHED
    ]
    assert rows(cohort) == sorted(expected, key=repr)

    stacked = cohorts.churn_cohort_stacked(cohort)
    assert stacked.count() == 26
    assert rows(stacked.where("cohort_month = '2025-07-01'")) == [
        (day("2025-07-01"), "Churned", 13, 29.5), (day("2025-07-01"), "Retained", 31, 29.5),
    ]
    assert rows(segments.headline(summary)) == [(500, 52, 10.4)]
    assert rows(segments.value_counts(summary, "churn_type")) == [
        ("Active", 448), ("Explicit", 15), ("Silent", 37),
    ]
    assert rows(cohorts.cohort_at(cohort, "2025-05-01", "2026-05-01")) == [
        (day("2025-05-01"), 29.3, 12, 29, 41), (day("2026-05-01"), 0.0, 0, 4, 4),
    ]
    summary.unpersist()
