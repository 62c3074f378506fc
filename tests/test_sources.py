import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import types as T

from stayrate import session
from stayrate.operators import quality
from stayrate.operators.staging import stage
from stayrate.plans import marts, review
from stayrate.sources import digest, raw, sinks

FILES = {
    "users": [
        "User_ID,Signup_Date,Acquisition_Channel,Account_Type,State,Age_Group",
        "1,2025-06-14,Organic,Banking,CA,25-34",
        "2,2025-06-20,Paid Social,Invest,TX,35-44",
        "3,2025-07-01,Email,Both,NY,55+",
    ],
    "transactions": [
        "Transaction_ID,User_ID,Transaction_Date,Amount_USD,Transaction_Type,Product,Round_Up",
        "1,1,2026-04-01,2.37,Round-Up,Banking,0.63",
        "2,2,2025-11-03,47.5,Recurring Deposit,Invest,0.0",
        "3,1,2026-01-22,-20.15,Withdrawal,Banking,0.0",
    ],
    "events": [
        "Event_ID,User_ID,Event_Date,Event_Type,Platform,Session_Duration_Sec",
        "1,1,2025-08-11,Login,iOS,243",
        "2,2,2025-11-03,Cancel_Account,Android,87",
        "3,1,2025-08-12,Deposit,Web,57",
    ],
}


@pytest.fixture
def folder(tmp_path):
    for name, lines in FILES.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return tmp_path


def test_csv_types(spark, folder):
    tables = stage(raw.read_raw(spark, str(folder)))
    kinds = {f.name: f.dataType for f in tables["transactions"].schema}
    assert kinds["transaction_id"] == T.LongType()
    assert kinds["transaction_date"] == T.DateType()
    assert kinds["amount_usd"] == kinds["round_up"] == T.DecimalType(18, 2)
    assert rows(tables["transactions"], "amount_usd")[0] == (Decimal("-20.15"),)
    assert tables["events"].first().event_ts == dt.datetime(2025, 8, 11)


def test_parquet_gives_the_same_tables(spark, folder, tmp_path):
    csv = raw.read_raw(spark, str(folder))
    for name, df in csv.items():
        df.write.parquet(str(tmp_path / "pq" / f"{name}.parquet"))
    parquet = stage(raw.read_raw(spark, str(tmp_path / "pq"), "parquet"))
    for name, df in stage(csv).items():
        assert df.schema == parquet[name].schema
        assert rows(df) == rows(parquet[name])


def test_missing_table_is_named(spark, folder):
    (folder / "events.csv").unlink()
    with pytest.raises(FileNotFoundError, match="events.*events.csv"):
        raw.read_raw(spark, str(folder))


def test_unknown_format_is_refused(spark, folder):
    with pytest.raises(ValueError, match="fmt"):
        raw.read_raw(spark, str(folder), "xlsx")


def test_malformed_row_fails(spark, folder):
    with open(folder / "users.csv", "a") as f:
        f.write("x,not a date,Email,Both,NY,55+\n")
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        raw.read_raw(spark, str(folder))["users"].collect()


def test_wrong_header_fails(spark, folder):
    lines = FILES["users"][:]
    lines[0] = lines[0].replace("State", "Region")
    (folder / "users.csv").write_text("\n".join(lines) + "\n")
    with pytest.raises(Exception, match="header|Region"):
        raw.read_raw(spark, str(folder))["users"].collect()


def test_row_counts_and_preview(spark, folder):
    tables = stage(raw.read_raw(spark, str(folder)))
    assert rows(sinks.row_counts(tables)) == [("events", 3), ("transactions", 3), ("users", 3)]
    first = sinks.preview(tables["users"], 2, "-user_id")
    assert [r.user_id for r in first.collect()] == [3, 2]


def test_full_run(spark, folder, tmp_path):
    out, exports = str(tmp_path / "marts"), str(tmp_path / "exports")
    tables = marts.run(spark, str(folder), out, exports, as_of="2026-05-05")
    header = "cohort_month,status,users,churn_rate_pct"
    lines = spark.read.text(f"{exports}/mart_churn_cohort_stacked.csv").collect()
    assert [r.value for r in lines] == [
        header,
        "2025-06-01,Retained,1,50.0",
        "2025-06-01,Churned,1,50.0",
        "2025-07-01,Retained,0,100.0",
        "2025-07-01,Churned,1,100.0",
    ]
    labels = rows(tables["mart_user_summary"], "user_id", "churned", "churn_type")
    assert labels == [(1, 0, "Active"), (2, 1, "Explicit"), (3, 1, "Silent")]
    assert {r.viewName for r in spark.sql("show views").collect()} >= {"stg_users", "stg_events"}
    # running again replaces the outputs
    tables = marts.run(spark, str(folder), out, exports, as_of="2026-05-05")
    assert rows(sinks.exported_counts(spark, {"m": f"{exports}/mart_user_summary.csv"})) == [("m", 3)]

    report = review.review(tables, months=["2025-07-01"])
    assert rows(report["headline"]) == [(3, 2, 66.67)]
    assert rows(report["churn_types"]) == [("Active", 1), ("Explicit", 1), ("Silent", 1)]
    assert len(report["cohorts"].collect()) == 1
    for table in report.values():
        table.collect()


def test_failed_check_stops_the_run(spark, folder, tmp_path):
    with open(folder / "users.csv", "a") as f:
        f.write("3,2025-07-01,Email,Both,NY,55+\n")
    with pytest.raises(ValueError, match="unique:stg_users.user_id"):
        marts.run(spark, str(folder), str(tmp_path / "m"), str(tmp_path / "e"), "2026-05-05")
    assert not (tmp_path / "e").exists()


def test_outputs_are_verified(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "user_id bigint")
    good = sinks.export_marts({"mart_user_summary": df}, str(tmp_path))
    sinks.verify_outputs(spark, good)
    empty = sinks.export_marts({"mart_other": df.limit(0)}, str(tmp_path))
    with pytest.raises(ValueError, match="mart_other"):
        sinks.verify_outputs(spark, empty)
    with pytest.raises(FileNotFoundError, match="absent"):
        sinks.verify_outputs(spark, {"mart_x": str(tmp_path / "absent.csv")})


MIXED = "a long, b string, c decimal(18,2), d date, e double"


def mixed(spark, *changes):
    entries = [(i, f"x{i}", Decimal(i) / 4, dt.date(2025, 1, 1 + i % 9), i / 3) for i in range(40)]
    entries += [(None, None, None, None, None), (7, "x7", Decimal("1.75"), dt.date(2025, 1, 8), 7 / 3)]
    for row, column, value in changes:
        entries[row] = (*entries[row][:column], value, *entries[row][column + 1 :])
    return spark.createDataFrame(entries, MIXED)


def test_digest_does_not_depend_on_order_but_on_every_cell(spark):
    df = mixed(spark)
    assert rows(digest.content_digest(df)) == rows(digest.content_digest(df.orderBy("e").repartition(7)))
    assert digest.differences({"t": df}, {"t": df.repartition(3)}).count() == 0
    for column, value in enumerate((99, "y", Decimal("0.01"), dt.date(2030, 1, 1), 0.5)):
        changed = digest.differences({"t": df}, {"t": mixed(spark, (3, column, value))})
        assert rows(changed) == [("t", "*"), ("t", "abcde"[column])]
        lost = digest.differences({"t": df}, {"t": mixed(spark, (3, column, None))})
        assert rows(lost) == [("t", "*"), ("t", "abcde"[column])]
    # values that change places between rows differ in whole rows only
    swapped = mixed(spark, (3, 1, "x4"), (4, 1, "x3"))
    assert rows(digest.differences({"t": df}, {"t": swapped})) == [("t", "*")]
    # a repeated row counts
    assert digest.differences({"t": df}, {"t": df.dropDuplicates()}).count() == 6
    assert rows(digest.differences({"t": df}, {"t": df.drop("b")})) == [("t", "*"), ("t", "b")]
    assert rows(digest.content_digest(df.limit(0)), "n_rows", "digest") == [(0, "0")] * 6


def test_changed_export_is_found(spark, tmp_path):
    marts_in = {"mart_x": mixed(spark)}
    paths = sinks.export_marts(marts_in, str(tmp_path / "good"))
    sinks.verify_contents(spark, paths, marts_in)
    paths = sinks.export_marts({"mart_x": mixed(spark, (5, 2, Decimal("9.99")))}, str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="mart_x.[*], mart_x.c$"):
        sinks.verify_contents(spark, paths, marts_in)


def test_orphans_are_reported_and_do_not_stop_the_run(spark, folder, tmp_path):
    with open(folder / "transactions.csv", "a") as f:
        f.write("4,99,2026-01-22,10.00,Recurring Deposit,Banking,0.0\n")
    tables = marts.run(spark, str(folder), str(tmp_path / "m"), str(tmp_path / "e"), "2026-05-05")
    report = {r.check_name: r.status for r in quality.quality_report(tables).collect()}
    assert [name for name, status in report.items() if status == "fail"] == ["orphans:stg_transactions"]
    counted = tables["mart_transaction_summary"].agg({"transaction_count": "sum"}).first()[0]
    assert counted == 4 and tables["mart_user_summary"].count() == 3


class Stub:
    """The parts of a session that name the shared folder."""

    def __init__(self, master, setting=None):
        self.conf, self.sparkContext = {"spark.checkpoint.dir": setting}, self
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = f"file:{folder}/id"


def test_shared_folder(spark):
    cluster = Stub("yarn", "hdfs:///shared/")
    assert session.shared_folder(cluster) == "hdfs:///shared"
    assert session.run_folder(cluster, "x") != session.run_folder(cluster, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(Stub("yarn"))
    local = Stub("local[2]")
    assert session.shared_folder(local) == session.shared_folder(local)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or session.shared_folder(spark) == named.rstrip("/")
