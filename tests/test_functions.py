import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stayrate.functions import calendar, churn, numbers, transactions


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "part, whole, digits, expected",
    [
        (1, 16, 1, 6.3),  # 6.25, a tie, goes up
        (12, 41, 1, 29.3),
        (0, 7, 1, 0.0),
        (7, 7, 2, 100.0),
        (3, 2, 2, 150.0),
        (1, 3, 2, 33.33),
        (1, 8000, 2, 0.01),  # 0.0125
        (5, 0, 1, None),
        (None, 5, 1, None),
    ],
)
def test_safe_rate(spark, part, whole, digits, expected):
    part, whole = F.lit(part).cast("bigint"), F.lit(whole).cast("bigint")
    assert one(spark, numbers.safe_rate(part, whole, digits)) == expected


def test_safe_ratio_rounds_half_up(spark):
    assert one(spark, numbers.safe_ratio(F.lit(9), F.lit(8), 2)) == 1.13  # 1.125
    assert one(spark, numbers.safe_ratio(F.lit(9), F.lit(0), 2)) is None


def test_mean_without_rows_is_null(spark):
    assert one(spark, numbers.mean(F.lit(5), F.lit(0))) is None
    assert one(spark, numbers.mean(F.lit(Decimal("1.50")), F.lit(4))) == 0.375


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_epoch_millis_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for text, millis in [
            ("2025-05-05", 1746403200000),
            ("2025-03-09 02:30:00", 1741487400000),  # does not exist on New York clocks
            ("1970-01-01 00:00:01.234567", 1234),
            ("1969-12-31 23:59:59.5", -500),
        ]:
            assert one(spark, calendar.epoch_millis(calendar.instant(text))) == millis
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "grain, start, periods",
    [("day", "2024-02-29", 31), ("week", "2024-02-26", 4), ("month", "2024-02-01", 1)],
)
def test_periods(spark, grain, start, periods):
    first = calendar.period_start(calendar.date_of("2024-02-29"), grain)
    last = calendar.period_start(calendar.date_of("2024-03-31"), grain)
    assert one(spark, first) == dt.date.fromisoformat(start)
    assert one(spark, calendar.periods_between(first, last, grain)) == periods


def test_unknown_grain_is_refused():
    with pytest.raises(ValueError, match="grain"):
        calendar.period_start(F.lit(None), "hour")


def test_flow_split(spark):
    for amount, up, down in [("2.50", "2.50", "0"), ("-3.00", "0", "3.00"), ("0", "0", "0")]:
        amount = F.lit(amount).cast("decimal(18,2)")
        assert one(spark, churn.deposited(amount)) == Decimal(up)
        assert one(spark, churn.withdrawn(amount)) == Decimal(down)
    missing = F.lit(None).cast("decimal(18,2)")
    assert one(spark, churn.deposited(missing)) == 0 == one(spark, churn.withdrawn(missing))


@pytest.mark.parametrize(
    "last, days, flag",
    [("2026-02-04", 90, 0), ("2026-02-03", 91, 1), ("2026-05-10", -5, 0), (None, None, 1)],
)
def test_churn_boundary(spark, last, days, flag):
    since = churn.days_since(F.lit(last).cast("date"), "2026-05-05")
    assert one(spark, since) == days
    assert one(spark, churn.churned(since)) == flag


def test_round_up_and_sign(spark):
    def rule(kind, amount):
        amount = F.lit(amount).cast("decimal(18,2)")
        return (
            one(spark, transactions.signed_amount(F.lit(kind), amount)),
            one(spark, transactions.round_up(F.lit(kind), amount)),
        )

    assert rule("Round-Up", "2.37") == (Decimal("2.37"), Decimal("0.63"))
    assert rule("Round-Up", "2.00") == (Decimal("2.00"), Decimal("0.00"))
    assert rule("Withdrawal", "78.43") == (Decimal("-78.43"), Decimal("0.00"))
    assert rule("One-Time Deposit", "47.50") == (Decimal("47.50"), Decimal("0.00"))


def test_money_sums_are_exact(spark):
    amounts = ["0.10"] * 3 + ["-0.05", "9999999999999999.99", None]
    df = spark.createDataFrame([(a,) for a in amounts], "a string").select(
        F.col("a").cast("decimal(18,2)").alias("a")
    )
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        df.agg(numbers.sum_money(F.col("a")).alias("x")).first()
    small = df.where("a < 1")
    assert small.agg(numbers.sum_money(F.col("a")).alias("x")).first().x == Decimal("0.25")
    assert df.where("a IS NULL").agg(numbers.sum_money(F.col("a")).alias("x")).first().x is None
