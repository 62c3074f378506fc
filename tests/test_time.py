"""Sessions, as-of joins and band joins against plain loops, hot users included."""

import datetime as dt
import random

import pytest
from conftest import EVENTS, rows
from test_plans import final_plan, plan

from stayrate.operators import asof, band, sessions, skew

START = dt.datetime(2025, 1, 1)
RIGHT = "user_id bigint, right_id bigint, at timestamp_ntz, price decimal(9,2)"


def history(seed, n=400, hot=0.5, grain=60):
    """Events of a few users, of whom one has about half; many share a time."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        user = 1 if rng.random() < hot else rng.choice([2, 3, 4, None])
        ts = START + dt.timedelta(minutes=rng.randrange(0, 6000) // grain * grain)
        out.append((i, user, ts.date(), ts, rng.choice(["Login", "Deposit", "View"]), "Web", 1))
    return out


# -- sessions ---------------------------------------------------------------------------------
def plain_sessions(events, gap):
    out, users = [], {}
    for e in events:
        if e[1] is not None and e[3] is not None:
            users.setdefault(e[1], []).append(e[3])
    for user, times in users.items():
        found = []
        for ts in sorted(times):
            if found and ts - found[-1][1] <= gap:
                found[-1] = (found[-1][0], ts, found[-1][2] + 1)
            else:
                found.append((ts, ts, 1))
        out += [
            (user, i, a, b, n, int((b - a).total_seconds()) // 60) for i, (a, b, n) in enumerate(found, start=1)
        ]
    return sorted(out, key=repr)


@pytest.mark.parametrize("gap, grain", [(30, 1), (30, 30), (60, 60), (59, 60), (7, 1)])
def test_sessions(spark, gap, grain):
    events = history(gap, grain=grain) + [(9999, 5, None, None, "Login", "Web", 1)]
    df = spark.createDataFrame(events, EVENTS)
    assert rows(sessions.sessions(df, gap)) == plain_sessions(events, dt.timedelta(minutes=gap))


def test_pauses_of_exactly_the_gap_and_across_stretches(spark):
    """A pause of the gap itself joins, a microsecond more does not, at any place in time."""
    gap, tick = dt.timedelta(minutes=30), dt.timedelta(microseconds=1)
    for first in (dt.datetime(1969, 12, 31, 20), START, START + sessions.STRETCH * gap - 2 * gap):
        times = [first + i * gap for i in range(120)]
        times += [times[-1] + gap + tick, times[-1] + 2 * gap + 2 * tick]
        events = [(i, 1, t.date(), t, "Login", "Web", 1) for i, t in enumerate(times)]
        got = rows(sessions.sessions(spark.createDataFrame(events, EVENTS), 30), "events")
        assert got == [(1,), (1,), (120,)]


def test_sessions_per_day(make):
    events = make.events(
        (1, "2025-01-01 23:50", "Login"), (1, "2025-01-02 00:10", "Deposit"), (1, "2025-01-02 09:00", "Login"),
        (2, "2025-01-01", "Login"),
    )
    assert rows(sessions.sessions_per_day(events)) == [
        (1, dt.date(2025, 1, 1), 1, 2, 20), (1, dt.date(2025, 1, 2), 1, 1, 0), (2, dt.date(2025, 1, 1), 1, 1, 0),
    ]
    assert sessions.sessions(events.limit(0)).count() == 0


def test_hot_users_are_merged_before_they_meet(spark):
    """What reaches the task of a user is bounded by time and gap, not by its events."""
    events = spark.range(20_000).selectExpr(
        "id AS event_id", "1L AS user_id", "timestamp_ntz'2025-01-01' + make_dt_interval(0, 0, 0, id) AS event_ts",
        "'Login' AS event_type",
    )
    partial = sessions._partial(events, 1)
    assert partial.count() <= 20_000 / 60 / sessions.STRETCH + 2
    assert rows(sessions.sessions(events, 1), "events") == [(20_000,)]


# -- as-of ------------------------------------------------------------------------------------
def plain_as_of(events, others, within=None):
    out = {}
    for e in events:
        fitting = [
            r for r in others
            if e[1] is not None and e[3] is not None and r[0] == e[1] and r[2] is not None and r[2] <= e[3]
        ]
        best = max(fitting, key=lambda r: (r[2], r[1]), default=None)
        if best and within and best[2] < e[3] - within:
            best = None
        out[e[0]] = (best[1], best[3]) if best else (None, None)
    return out


@pytest.mark.parametrize("rows_per_task", [5, 60, skew.ROWS_PER_TASK])
@pytest.mark.parametrize("within", [None, "90 minutes"])
def test_as_of(spark, rows_per_task, within):
    from decimal import Decimal

    rng = random.Random(11)
    events = history(3) + [(9000, None, None, None, "Login", "Web", 1), (9001, 1, None, None, "Login", "Web", 1)]
    others = [
        (rng.choice([1, 1, 1, 2, 3, None]), i, START + dt.timedelta(minutes=rng.randrange(500, 5000) // 30 * 30), Decimal(i))
        for i in range(150)
    ] + [(1, 800, None, Decimal(1)), (1, 801, START + dt.timedelta(minutes=900), None)]
    left = spark.createDataFrame(events, EVENTS)
    right = spark.createDataFrame(others, RIGHT)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as many ranges as partitions
    try:
        df = asof.as_of(left, right, "user_id", "event_ts", "at", "right_id", ("right_id", "price"), within, rows_per_task)
        got = df.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert df.columns == [*left.columns, "right_id", "price"]
    limit = dt.timedelta(minutes=90) if within else None
    assert len(got) == len(events)
    assert {r.event_id: (r.right_id, r.price) for r in got} == plain_as_of(events, others, limit)


def test_as_of_without_rows(spark):
    left, right = spark.createDataFrame(history(1, 5), EVENTS), spark.createDataFrame([], RIGHT)
    args = ("user_id", "event_ts", "at", "right_id", ("price",))
    assert {r.price for r in asof.as_of(left, right, *args).collect()} == {None}
    assert asof.as_of(left.limit(0), right, *args).count() == 0


def test_as_of_compares_no_pairs(spark):
    left, right = spark.createDataFrame(history(1, 50), EVENTS), spark.createDataFrame([(1, 1, START, None)], RIGHT)
    text = plan(asof.as_of(left, right, "user_id", "event_ts", "at", "right_id", ("price",)))
    for node in ("CartesianProduct", "NestedLoop", "Python"):
        assert node not in text


# -- bands ------------------------------------------------------------------------------------
@pytest.mark.parametrize("before, after, grain", [(60, 0, 1), (0, 60, 60), (45, 90, 15), (1, 1, 1), (2000, 0, 60)])
def test_band_pairs(spark, before, after, grain):
    lefts, rights = history(5, 200, grain=grain), history(6, 200, grain=grain)
    lefts += [(900, 1, None, None, "Login", "Web", 1), (901, 2, None, dt.datetime(1969, 12, 31, 23, 59, 59, 999_999), "x", "Web", 1)]
    rights += [(902, 2, None, dt.datetime(1970, 1, 1), "x", "Web", 1)]
    a, b = spark.createDataFrame(lefts, EVENTS), spark.createDataFrame(rights, EVENTS)
    pairs = band.band_pairs(a, b, "user_id", "event_ts", "event_ts", before, after)
    got = rows(pairs, "left_row.event_id", "right_row.event_id")
    low, high = dt.timedelta(minutes=-before), dt.timedelta(minutes=after)
    assert got == sorted(
        ((x[0], y[0]) for x in lefts for y in rights
         if x[1] is not None and x[1] == y[1] and x[3] and y[3] and low <= y[3] - x[3] <= high), key=repr,
    )


def test_band_joins_meet_in_buckets(spark):
    df = spark.createDataFrame(history(5, 50), EVENTS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(band.band_pairs(df, df, "user_id", "event_ts", "event_ts", 60))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin [user_id" in text and "bucket#" in text
    for node in ("CartesianProduct", "NestedLoop"):
        assert node not in text
    with pytest.raises(ValueError, match="width"):
        band.band_pairs(df, df, "user_id", "event_ts", "event_ts")


def test_followed_within(make):
    events = make.events(
        (1, "2025-01-01 10:00", "Login"), (1, "2025-01-01 10:30", "Login"), (1, "2025-01-01 11:00", "Deposit"),
        (1, "2025-01-01 12:00", "Deposit"), (2, "2025-01-01 11:00", "Login"), (None, "2025-01-01 11:00", "Deposit"),
    )
    got = rows(band.followed_within(events, "Login", "Deposit", 60))
    assert got == [(3, 1, 2, dt.datetime(2025, 1, 1, 10, 30))]
    assert "Window" not in final_plan(band.followed_within(events, "Login", "Deposit", 60))
