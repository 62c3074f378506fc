"""Numbering, samples, batches, payload tables, cancellations and the stream."""

import hashlib
import json
from collections import Counter

import pytest
from conftest import day, rows

from stayrate.operators import cancellations, numbering, payload, staging
from stayrate.operators.rollups import user_summary
from stayrate.streaming import feed


def in_hash_order(keys, seed=""):
    return sorted(keys, key=lambda k: (hashlib.md5(f"{k}{seed}".encode()).hexdigest()[:15], k))


@pytest.mark.parametrize("digits", [1, 3])
def test_positions_are_dense(spark, digits):
    df = spark.range(1000).withColumnRenamed("id", "user_id")
    got = numbering.with_position(df, "user_id", digits=digits).collect()
    assert sorted(r.user_id for r in got) == list(range(1000))
    assert sorted(r.position for r in got) == list(range(1, 1001))


@pytest.mark.parametrize("n, fraction, size", [(52, 0.30, 15), (10, 0.3, 3), (2, 0.30, 1), (0, 0.30, 0),
                                              (100, 0.29, int(100 * 0.29)), (300, 1.0, 300)])
def test_sample_size_is_exact(spark, n, fraction, size):
    df = spark.range(n).withColumnRenamed("id", "user_id")
    got = numbering.sample_fraction(df, "user_id", fraction, "x").collect()
    chosen = [r.user_id for r in sorted(got, key=lambda r: r.position)]
    assert chosen == in_hash_order(range(n), "x")[:size]
    assert sorted(r.position for r in got) == list(range(1, size + 1))


@pytest.mark.parametrize("n, size", [(1001, 100), (500, 500), (7, 100)])
def test_batches_are_full(spark, n, size):
    df = spark.range(n).selectExpr("id * 64 as event_id")
    sizes = Counter(r.batch_no for r in numbering.with_batches(df, "event_id", size).collect())
    full, rest = divmod(n, size)
    assert [sizes[b] for b in sorted(sizes)] == [size] * full + ([rest] if rest else [])
    assert sorted(sizes) == list(range(len(sizes)))


def test_identify_payload(make):
    summary = user_summary(make.users((1, "2025-06-14", {"state": None})), make.tx((1, "2026-05-01", 5)),
                           make.events((1, "2026-05-01", "Cancel_Account")), as_of="2026-05-05")
    unlabelled = summary.selectExpr("* except (churn_type)", "cast(null as string) churn_type")
    line = json.loads(payload.json_lines(payload.identify_payload(unlabelled)).first().value)
    assert line == {
        "user_id": "user_1",
        "user_properties": {"$set": {
            "signup_date": "2025-06-14", "acquisition_channel": "Email", "account_type": "Both",
            "state": None, "age_group": "18-24", "churned": False, "churn_type": "Active",
        }},
    }


def test_event_payload_and_requests(make):
    events = make.events(*[(1, "2025-05-05", "Login", 5 + i) for i in range(7)],
                         (2, "2025-05-05 00:00:01.5", "Cancel_Account", 87))
    lines = [json.loads(r.value) for r in payload.json_lines(payload.event_payload(events)).collect()]
    assert lines[-1] == {
        "user_id": "user_2", "event_type": "Cancel_Account", "time": 1746403201500, "platform": "Web",
        "event_properties": {"platform": "Web", "session_duration_sec": 87}, "insert_id": "8",
    }
    requests = payload.request_bodies(payload.event_payload(events), "insert_id", 3).collect()
    assert sorted((r.batch_no, r.n_rows) for r in requests) == [(0, 3), (1, 3), (2, 2)]
    sent = [row for r in requests for row in json.loads(r.body)]
    assert sorted(row["insert_id"] for row in sent) == [str(i) for i in range(1, 9)]
    assert all(row in lines for row in sent)


@pytest.mark.parametrize("rows_per_bucket", [1, 3, 50])
@pytest.mark.parametrize("digits", [0, 1, 3])
def test_positions_over_many_buckets(spark, digits, rows_per_bucket):
    """A range with more rows than a bucket holds is cut; the order stays that of the hash."""
    df = spark.range(700).withColumnRenamed("id", "user_id")
    got = numbering.with_position(df, "user_id", digits=digits, seed="s", rows_per_bucket=rows_per_bucket)
    found = [r.user_id for r in sorted(got.collect(), key=lambda r: r.position)]
    assert found == in_hash_order(range(700), "s")


def test_buckets_hold_no_more_than_they_should(spark):
    df = spark.range(20_000).withColumnRenamed("id", "user_id")
    hashed = numbering._hashed(df, "user_id", numbering._fast_bits("user_id"), 1)
    placed = numbering._placed(hashed, 1, 200)
    sizes = [r["count"] for r in placed.groupBy("_range", "_bucket").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 300 and len(sizes) >= 100


def test_identify_requests(make):
    users = make.users(*[(i, "2025-06-14") for i in range(250)])
    summary = user_summary(users, make.tx((1, "2026-05-01", 5)), make.events((1, "2026-05-01", "Login")), as_of="2026-05-05")
    requests = payload.identify_requests(summary, seed="z").collect()
    assert sorted((r.batch_no, r.n_rows) for r in requests) == [(0, 100), (1, 100), (2, 50)]
    order = in_hash_order([f"user_{i}" for i in range(250)], "z")
    for r in requests:
        sent = json.loads(r.body)
        assert sorted(u["user_id"] for u in sent) == sorted(order[100 * r.batch_no :][:100])
        assert all(set(u["user_properties"]["$set"]) >= {"churned", "churn_type"} for u in sent)
    lines = {r.value for r in payload.json_lines(payload.identify_payload(summary)).collect()}
    assert {json.dumps(u) for r in requests for u in json.loads(r.body)} == {json.dumps(json.loads(x)) for x in lines}


def test_cancellations(make):
    tx = make.tx((1, "2026-02-03", 5), (1, "2025-12-01", 5), (2, "2026-02-04", 5), (3, "2025-06-01", 5),
                 (4, "2025-06-02", 5), (None, "2020-01-01", 5))
    candidates = cancellations.churn_candidates(tx, "2026-05-05")
    assert rows(candidates) == [(1, day("2026-02-03")), (3, day("2025-06-01")), (4, day("2025-06-02"))]
    chosen = numbering.sample_fraction(candidates, "user_id", 0.7, "c")
    events = make.events((1, "2025-01-01", "Login"), (2, "2025-01-01", "Login"))
    assert chosen.count() == 2
    assert staging.append_events(events, events).count() == 4


def test_samples_keep_rows_without_a_key(spark):
    users = [(i if i % 5 else None, i) for i in range(25)]
    df = spark.createDataFrame(users, "user_id long, other long")
    chosen = numbering.sample_fraction(df, "user_id", 0.4).collect()
    assert sorted(r.position for r in chosen) == list(range(1, 11))
    batched = numbering.with_batches(df, "user_id", 10)
    assert sorted(r["count"] for r in batched.groupBy("batch_no").count().collect()) == [5, 10, 10]


def test_stream_checks_the_header(spark, tmp_path):
    incoming = tmp_path / "in"
    incoming.mkdir()
    swapped = "User_ID,Event_ID,Event_Date,Event_Type,Platform,Session_Duration_Sec"
    (incoming / "a.csv").write_text(f"{swapped}\n7,100,2025-08-11,Login,iOS,243\n")
    stream = feed.payload_stream(feed.read_event_stream(spark, str(incoming)))
    query = feed.start_feed(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    with pytest.raises(Exception, match="header"):
        query.awaitTermination(120)


def test_stream_delivers_each_event_once(spark, tmp_path):
    header = "Event_ID,User_ID,Event_Date,Event_Type,Platform,Session_Duration_Sec"
    incoming, out, checkpoint = (tmp_path / d for d in ("in", "out", "checkpoint"))
    incoming.mkdir()

    def deliver():
        stream = feed.read_event_stream(spark, str(incoming))
        query = feed.start_feed(feed.payload_stream(stream, "2026-05-05"), str(out), str(checkpoint))
        query.awaitTermination(120)
        return sorted(json.loads(r.value)["insert_id"] for r in spark.read.text(str(out)).collect())

    old = "9,1,2025-05-04,Login,iOS,10"  # a day too old
    (incoming / "a.csv").write_text(f"{header}\n1,1,2025-08-11,Login,iOS,243\n{old}\n")
    assert deliver() == ["1"]
    (incoming / "b.csv").write_text(f"{header}\n2,1,2025-08-12,Deposit,Web,57\n")
    assert deliver() == ["1", "2"]
    assert deliver() == ["1", "2"]
