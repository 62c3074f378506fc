"""Funnels and paths against a plain reading of their definition, with and without hot users."""

import datetime as dt
import random
from collections import Counter

import pytest
from conftest import EVENTS, rows

from stayrate.operators import funnel, paths, skew

KINDS = ["Login", "View_Portfolio", "Deposit", "Withdrawal", "Cancel_Account"]
STEPS = ["Login", "View_Portfolio", "Deposit"]
START = dt.datetime(2025, 1, 1)


def history(seed, dates_only, users=120):
    """Random events with ties; some users have a few events, some have many."""
    rng = random.Random(seed)
    out, event_id = [], 0
    ids = list(range(5000))
    rng.shuffle(ids)
    for user in range(users):
        for _ in range(rng.choice([1, 3, 8, 30])):
            hours = rng.randrange(0, 24 * 12)
            ts = START + (dt.timedelta(days=hours // 24) if dates_only else dt.timedelta(hours=hours))
            out.append((ids[event_id], user, ts.date(), ts, rng.choice(KINDS), "Web", 1))
            event_id += 1
    out.append((ids[event_id], None, START.date(), START, "Login", "Web", 1))
    return out


def by_user(events):
    users = {}
    for event_id, user, _, ts, kind, *_ in events:
        if user is not None:
            users.setdefault(user, []).append((ts, event_id, kind))
    return {user: sorted(found) for user, found in users.items()}


def expected_times(events, steps, within, strict):
    out = {}
    for user, found in by_user(events).items():
        times = []
        for i, (kind, after) in enumerate(steps):
            ok = [ts for ts, _, k in found if k == kind]
            if i:
                since = times[after - 1]
                ok = [
                    ts for ts in ok
                    if since is not None
                    and (ts > since if strict else ts >= since)
                    and (within is None or ts <= times[0] + within)
                ]
            times.append(min(ok, default=None))
        if times[0] is not None:
            out[user] = tuple(times)
    return out


CHAIN = [(kind, i) for i, kind in enumerate(STEPS)]
TREE = [("Login", 0), ("Deposit", 1), ("Withdrawal", 1)]
REPEAT = [("Login", 0), ("Login", 1), ("Deposit", 2)]


@pytest.mark.parametrize("rows_per_task", [3, skew.ROWS_PER_TASK])
@pytest.mark.parametrize(
    "steps, within, strict, dates_only",
    [
        (CHAIN, None, True, False),
        (CHAIN, dt.timedelta(days=1), True, False),
        (CHAIN, dt.timedelta(days=2), False, True),
        (TREE, dt.timedelta(hours=30), True, False),
        (REPEAT, None, True, True),
    ],
)
def test_step_times(spark, steps, within, strict, dates_only, rows_per_task):
    events = history(7, dates_only)
    df = spark.createDataFrame(events, EVENTS)
    got = funnel.step_times(df, steps, within, strict, rows_per_task).collect()
    assert len(got) == len({r.user_id for r in got})
    assert {r.user_id: tuple(r)[1:] for r in got} == expected_times(events, steps, within, strict)


@pytest.mark.parametrize("rows_per_task", [1, skew.ROWS_PER_TASK])
def test_step_times_without_a_time(spark, rows_per_task):
    when = dt.datetime(2025, 1, 1, 10)
    rows_ = [(1, 1, None, None, "Login", "Web", 1), (2, 2, when.date(), when, "Login", "Web", 1),
             (3, 2, None, None, "View_Portfolio", "Web", 1)]
    df = spark.createDataFrame(rows_, EVENTS)
    got = funnel.step_times(df, CHAIN, None, True, rows_per_task).collect()
    assert [(r.user_id, r.t1, r.t2) for r in got] == [(2, when, None)]


def test_funnel_report(spark, make):
    events = make.events(
        (1, "2025-01-01 10:00:00", "Login"),
        (1, "2025-01-01 11:00:00", "View_Portfolio"),
        (1, "2025-01-01 12:00:00", "Deposit"),
        (2, "2025-01-01 10:00:00", "View_Portfolio"),
        (2, "2025-01-01 11:00:00", "Login"),
        (2, "2025-01-03 12:00:00", "View_Portfolio"),
        (3, "2025-01-01 10:00:00", "Deposit"),  # never logged in: not in the funnel
        (4, "2025-01-01 10:00:00", "Login"),  # NULL segment
    )
    users = make.users(
        (1, "2025-01-01"), (2, "2025-01-01", {"account": "Invest"}),
        (3, "2025-01-01", {"account": "Banking"}), (4, "2025-01-01", {"account": None}),
    )
    day = dt.timedelta(days=1)
    assert rows(funnel.funnel(events, STEPS, day)) == [
        (1, "Login", 3, 100.0, 100.0),
        (2, "View_Portfolio", 1, 33.33, 33.33),
        (3, "Deposit", 1, 33.33, 100.0),
    ]
    split = funnel.funnel(events, STEPS, day, users, "account_type")
    assert rows(split.where("account_type = 'Invest'")) == [
        ("Invest", 1, "Login", 1, 100.0, 100.0),
        ("Invest", 2, "View_Portfolio", 0, 0.0, 0.0),
        ("Invest", 3, "Deposit", 0, 0.0, None),
    ]
    assert {r.account_type for r in split.collect()} == {"Both", "Invest"}
    wide = funnel.funnel(events, STEPS)
    assert rows(wide, "users") == [(1,), (2,), (3,)]


def test_branches_share_the_base(make):
    events = make.events(
        (1, "2025-01-01 10:00:00", "Login"),
        (1, "2025-01-01 11:00:00", "Withdrawal"),
        (1, "2025-01-01 12:00:00", "Deposit"),
        (2, "2025-01-01 10:00:00", "Login"),
        (2, "2025-01-01 09:00:00", "Deposit"),
    )
    assert rows(funnel.branch_funnel(events, "Login", ["Deposit", "Withdrawal"])) == [
        (1, "Login", 2, 100.0, 100.0), (2, "Deposit", 1, 50.0, 50.0), (3, "Withdrawal", 1, 50.0, 50.0),
    ]


def test_empty_funnel(make):
    events = make.events((1, "2025-01-01", "Deposit"))
    assert rows(funnel.funnel(events, STEPS), "users", "pct_of_first") == [(0, None)] * 3


def expected_paths(events, targets, depth):
    out = {}
    for user, found in by_user(events).items():
        for i, (_, event_id, kind) in enumerate(found):
            if kind in targets:
                out[event_id] = " > ".join(k for *_, k in found[max(0, i - depth): i + 1])
    return out


@pytest.mark.parametrize("dates_only", [False, True])
@pytest.mark.parametrize("rows_per_task", [2, 7, skew.ROWS_PER_TASK])
@pytest.mark.parametrize("depth", [1, 3, 5])
def test_paths(spark, depth, rows_per_task, dates_only):
    events = history(depth, dates_only)
    df = spark.createDataFrame(events, EVENTS)
    targets = ["Withdrawal", "Cancel_Account"]
    expected = expected_paths(events, targets, depth)
    # as many slices as partitions, unless adaptive execution merges the small ones
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(rows_per_task == 7).lower())
    try:
        got = paths.path_ends(df, targets, depth, rows_per_task).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(expected)
    assert {r.event_id: r.path for r in got} == expected


def test_path_counts(spark):
    events = history(11, False)
    df = spark.createDataFrame(events, EVENTS)
    ends = expected_paths(events, ["Withdrawal"], 2)
    owner = {e[0]: e[1] for e in events}
    occurrences = Counter(ends.values())
    users = Counter(path for path, _ in {(p, owner[e]) for e, p in ends.items()})
    for limit in (4, skew.ROWS_PER_TASK):
        got = {r.path: (r.occurrences, r.users) for r in paths.paths_to(df, ["Withdrawal"], 2, limit).collect()}
        assert got == {path: (n, users[path]) for path, n in occurrences.items()}


@pytest.mark.parametrize("shape", ["even", "burst", "one date"])
def test_slices_are_balanced(spark, shape):
    """However a user's events lie in time, no slice comes near the user's size."""
    n, slices = 4000, 8
    minutes = {
        "even": lambda i: i, "burst": lambda i: 500_000 * (i == 0), "one date": lambda i: 0,
    }[shape]
    times = [START + dt.timedelta(minutes=minutes(i)) for i in range(n)]
    events = [(i, 1, ts.date(), ts, "Login", "Web", 1) for i, ts in enumerate(times)]
    df = paths._sliced(spark.createDataFrame(events, EVENTS), slices)
    sizes = [r["count"] for r in df.groupBy("slice").count().collect()]
    assert len(sizes) == slices and max(sizes) <= 2 * n / slices


def test_attach_keeps_every_fact(spark):
    facts = spark.createDataFrame(
        [(i, k) for i, k in enumerate([1, 1, 1, 1, 2, 3, 3, 3, 9, 9, 9, None, None, None])],
        "event_id bigint, user_id bigint",
    )
    users = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "user_id bigint, x string")
    got = skew.attach(facts, users, "user_id")
    assert sorted((r.event_id, r.user_id, r.x) for r in got.collect()) == [
        (0, 1, "a"), (1, 1, "a"), (2, 1, "a"), (3, 1, "a"), (4, 2, "b"), (5, 3, None), (6, 3, None),
        (7, 3, None), (8, 9, None), (9, 9, None), (10, 9, None), (11, None, None), (12, None, None),
        (13, None, None),
    ]
