"""Daily partial rollups and sketches, bucketed tables and the stateful streams."""

import datetime as dt
import os
import random

import pytest
from conftest import EVENTS, rows
from test_plans import plan

import __spark_entry__ as entry_module
from stayrate.operators import incremental, rollups, triggers
from stayrate.sources import raw, sinks
from stayrate.streaming import dedup, feed, lapses

START = dt.datetime(2025, 1, 1)


def some_events(seed, n, days=10, first=0):
    rng = random.Random(seed)
    out = []
    for i in range(first, first + n):
        ts = START + dt.timedelta(days=rng.randrange(days), minutes=rng.randrange(1440))
        kind = rng.choice(["Login", "Deposit", "Cancel_Account", None])
        out.append((i, rng.choice([1, 2, 3, None]), ts.date(), ts, kind, "Web", rng.choice([None, 10, 25])))
    return out


def files(folder):
    return {
        os.path.join(d, f): os.path.getmtime(os.path.join(d, f))
        for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")
    }


# -- incremental rollups ------------------------------------------------------------------------
def test_arrivals_add_up_to_the_full_rebuild(spark, tmp_path):
    store = incremental.DailyStore(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError, match="nothing has arrived"):
        store.rollup()
    parts = [some_events(1, 60, 4), some_events(2, 60, 10, 100), some_events(3, 20, 2, 200)]
    parts[2] += [(300, 1, None, None, "Login", "Web", 5)]  # without a date
    so_far = []
    for i, part in enumerate(parts):
        so_far += part
        days = store.arrive(spark.createDataFrame(part, EVENTS), f"arrival {i}")
        assert set(days) == {e[2] for e in part}
        whole = spark.createDataFrame(so_far, EVENTS)
        assert rows(store.rollup()) == rows(rollups.event_rollup(whole))


def test_late_events_rewrite_their_days_only(spark, tmp_path):
    store = incremental.DailyStore(spark, str(tmp_path))
    store.arrive(spark.createDataFrame(some_events(1, 200), EVENTS), "a")
    before = files(tmp_path / "rollup")
    late = [(900, 7, START.date(), START, "Login", "Web", 5)]
    assert store.arrive(spark.createDataFrame(late, EVENTS), "b") == [START.date()]
    after = files(tmp_path / "rollup")
    renewed = {f for f in after if before.get(f) != after[f]}
    assert renewed and all(f"event_date={START.date()}" in f for f in renewed)
    assert {f for f in before if "event_date=2025-01-01" not in f} <= set(after)


def test_repeated_arrival_replaces_itself(spark, tmp_path):
    store = incremental.DailyStore(spark, str(tmp_path))
    events = spark.createDataFrame(some_events(1, 50), EVENTS)
    for _ in range(2):
        store.arrive(events, "a")
    assert rows(store.rollup()) == rows(rollups.event_rollup(events))


def test_sketches_of_any_period(spark, tmp_path):
    events = spark.range(60_000).selectExpr(
        "id AS event_id", "(id * 7919) % 9000 AS user_id", "date_add(date'2025-01-01', cast(id % 6 as int)) AS event_date",
        "if(id % 3 = 0, 'Login', 'Deposit') AS event_type", "(id * 104729) % 5000 AS session_duration_sec",
    )
    store = incremental.DailyStore(spark, str(tmp_path))
    store.arrive(events.where("event_id % 2 = 0"), "a")
    store.arrive(events.where("event_id % 2 = 1"), "b")
    days = events.where("event_date BETWEEN '2025-01-02' AND '2025-01-04'")
    period = store.period("2025-01-02", "2025-01-04")
    assert "PartitionFilters: [isnotnull(event_date" in plan(period)
    found = {r.event_type: r for r in period.collect()}
    for kind, row in found.items():
        own = days.where(f"event_type = '{kind}'")
        users = own.select("user_id").distinct().count()
        assert row.events == own.count()
        assert abs(row.users - users) <= 0.06 * users  # almost four standard errors
        ordered = sorted(r[0] for r in own.select("session_duration_sec").collect())
        for share, value in ((0.5, row.session_p50), (0.9, row.session_p90), (0.99, row.session_p99)):
            low, high = (ordered[min(len(ordered) - 1, int(len(ordered) * max(0, x)))] for x in (share - 0.01, share + 0.01))
            assert low <= value <= high
    assert set(found) == {"Login", "Deposit"}


# -- bucketed tables ----------------------------------------------------------------------------
def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    tables = entry_module.Tables(spark, "/root/testdata/sf0.001")
    name = f"t{abs(hash(str(tmp_path)))}"
    parts = {"users": tables.users, "transactions": tables.tx, "events": tables.events}
    stored = {
        k: sinks.materialise_bucketed(f"{name}_{k}", df, str(tmp_path), "user_id", 4) for k, df in parts.items()
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(rollups.user_summary(**stored, as_of="2001-08-01"))
        assert "Exchange" not in text and text.count("SortMergeJoin") == 2 and "Bucketed: true" in text
        profile = stored["events"].where("user_id = 7")
        assert "SelectedBucketsCount: 1 out of 4" in plan(profile.groupBy("user_id").count())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows(rollups.user_summary(**stored, as_of="2001-08-01")) == rows(
        rollups.user_summary(**parts, as_of="2001-08-01")
    )
    # one file per bucket, whatever the number of tasks that write
    assert len(files(tmp_path / f"{name}_events")) <= 4
    for k in parts:
        spark.sql(f"DROP TABLE {name}_{k}")


# -- streams --------------------------------------------------------------------------------------
HEADER = "Event_ID,User_ID,Event_Date,Event_Type,Platform,Session_Duration_Sec"


class Folder:
    """A folder that event files arrive in, and a stream that is run after each."""

    def __init__(self, spark, path, rows_of):
        self.spark, self.path, self.rows_of = spark, path, rows_of
        (path / "in").mkdir()
        self.n = 0

    def arrive(self, *lines):
        self.n += 1
        (self.path / "in" / f"{self.n}.csv").write_text("\n".join([HEADER, *lines]) + "\n")
        stream = self.rows_of(feed.read_event_stream(self.spark, str(self.path / "in")))
        dedup.start_table(stream, str(self.path / "out"), str(self.path / "checkpoint")).awaitTermination(120)
        return self.spark.read.parquet(str(self.path / "out"))


def test_repeated_and_late_events_are_delivered_once(spark, tmp_path):
    folder = Folder(spark, tmp_path, lambda stream: dedup.once_each(stream, "5 days"))
    first = folder.arrive("1,1,2025-08-11,Login,iOS,243", "1,1,2025-08-11,Login,iOS,243", "2,1,2025-08-12,Login,iOS,1",
                          ",1,2025-08-12,Login,iOS,1", ",2,2025-08-12,Login,iOS,1", ",2,2025-08-12,Login,iOS,1")
    assert rows(first, "event_id", "user_id") == [(1, 1), (2, 1), (None, 1), (None, 2)]
    second = folder.arrive("2,1,2025-08-12,Login,iOS,1", "3,1,2025-08-09,Login,iOS,1", "4,1,2025-08-14,Login,iOS,1")
    assert rows(second, "event_id") == [(1,), (2,), (3,), (4,), (None,), (None,)]
    assert second.count() == folder.arrive("3,1,2025-08-09,Login,iOS,1", "1,1,2025-08-11,Login,iOS,243").count()
    assert set(second.columns) == set(first.columns) == {f.lower() for f in raw.RAW_SCHEMAS["events"].names} | {"event_ts"}


def test_lapses_are_those_of_the_trigger(spark, tmp_path):
    folder = Folder(spark, tmp_path, lambda stream: lapses.lapses(stream, 14, "Login", "1 day"))
    days = {1: ["2025-08-01"], 2: ["2025-08-05", "2025-08-20"], 3: ["2025-08-19"], 4: []}
    lines = [f"{u}{i},{u},{d},Login,iOS,1" for u, all_days in days.items() for i, d in enumerate(all_days)]
    lines.append("40,4,2025-08-02,Deposit,iOS,1")  # never logs in: nothing to wait for
    folder.arrive(*lines, ",,2025-08-21,Login,iOS,1")
    # The clock stands a day behind the latest event of the files before.
    folder.arrive("50,,2025-08-22,Deposit,iOS,1", "51,5,2025-08-22,Deposit,iOS,1")
    out = folder.arrive("52,5,2025-08-23,Deposit,iOS,1")
    assert rows(out) == [(1, dt.date(2025, 8, 1), dt.date(2025, 8, 16))]
    # user 1 comes back, user 3 and 2 stay away
    folder.arrive("60,1,2025-09-01,Login,iOS,1", "61,5,2025-09-08,Deposit,iOS,1")
    out = folder.arrive("62,5,2025-09-09,Deposit,iOS,1")
    again = rows(out)
    assert again == [
        (1, dt.date(2025, 8, 1), dt.date(2025, 8, 16)), (2, dt.date(2025, 8, 20), dt.date(2025, 9, 4)),
        (3, dt.date(2025, 8, 19), dt.date(2025, 9, 3)),
    ]
    events = spark.read.schema(raw.RAW_SCHEMAS["events"]).option("header", True).csv(str(tmp_path / "in"))
    events = events.toDF(*[c.lower() for c in events.columns])
    users = events.select("user_id").where("user_id IS NOT NULL").distinct()
    trigger = triggers.inactive_users(events, users, "2025-09-07", 14).where("status = 'lapsed'")
    back = {1}  # reported, and seen again
    assert {r.user_id for r in trigger.collect()} == {r[0] for r in again} - back
