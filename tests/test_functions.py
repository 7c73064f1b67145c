import hashlib
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tristrata.functions import (
    calendar_attributes,
    decode,
    month_end,
    now,
    period_start,
    single_key,
    surrogate_key,
    today,
)
from tristrata.operators import calendar


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_surrogate_key(spark):
    df = spark.createDataFrame([("P1", None, 7), (None, None, 8)], "a string, b string, c int")
    keys = [r[0] for r in df.select(surrogate_key("a", "b")).collect()]
    assert keys == [md5("P1||NULL"), md5("NULL||NULL")]
    assert df.select(surrogate_key("c")).first()[0] == md5("7")


def test_single_key(spark):
    df = spark.createDataFrame([("P1",), (None,)], "a string")
    assert [r[0] for r in df.select(single_key("a")).collect()] == [md5("P1"), None]


@pytest.mark.parametrize(
    "year, period, end",
    [(2024, 2, date(2024, 2, 29)), (2024, 12, date(2024, 12, 31)), (2024, 13, None), (2024, 0, None),
     (None, 1, None), (2024, None, None)],
)
def test_month_end(spark, year, period, end):
    df = spark.createDataFrame([(year, period)], "y int, p int")
    assert df.select(month_end(F.col("y"), F.col("p"))).first()[0] == end


def test_period_start(spark):
    df = spark.createDataFrame([("202401",), ("202413",), (None,)], "p string")
    days = [r[0] for r in df.select(period_start(F.col("p"))).collect()]
    assert days == [date(2024, 1, 1), None, None]
    assert spark.sql("select 202402 p").select(period_start(F.col("p"))).first()[0] == date(2024, 2, 1)


def test_decode(spark):
    df = spark.createDataFrame([("L",), (None,), ("K",)], "c string")
    labels = {"L": "Subcontract", None: "Turn Key"}
    assert [r[0] for r in df.select(decode(F.col("c"), labels, "Other")).collect()] == [
        "Subcontract", "Turn Key", "Other",
    ]
    assert [r[0] for r in df.select(decode(F.col("c"), {"L": "x"}, "Other")).collect()] == [
        "x", "Other", "Other",
    ]


def test_clock(spark):
    at = datetime(2024, 2, 3, 4, 5, 6)
    row = spark.range(1).select(now(at).alias("n"), today(at).alias("t")).first()
    assert (row.n, row.t) == (at, at.date())
    live = spark.range(1).select(now().alias("n"), today().alias("t"))
    assert live.dtypes == [("n", "timestamp"), ("t", "date")]


def expected_day(d):
    fiscal_month = (d.month - 4) % 12
    quarter = f"Q{(d.month - 1) // 3 + 1}"
    return {
        "date_key": d.year * 10000 + d.month * 100 + d.day,
        "full_date": d,
        "year": d.year,
        "quarter": quarter,
        "month": d.month,
        "month_name": d.strftime("%B"),
        "week": d.isocalendar().week,
        "day": d.day,
        "day_of_week": d.isoweekday(),
        "day_name": d.strftime("%A"),
        "is_weekend": d.isoweekday() > 5,
        "fiscal_year": d.year - (d.month < 4),
        "fiscal_quarter": f"Q{fiscal_month // 3 + 1}",
        "fiscal_period": fiscal_month + 1,
        "year_month": f"{d.year}-{d.month:02}",
        "year_quarter": f"{d.year}-{quarter}",
    }


def test_calendar_attributes_of_every_day(spark):
    start, end = date(2020, 1, 1), date(2030, 12, 31)
    df = calendar(spark, start, end)
    got = {r.full_date: r.asDict() for r in df.drop("created_timestamp").collect()}
    assert len(got) == 4018
    day = start
    while day <= end:
        assert got[day] == expected_day(day)
        day += timedelta(days=1)


def test_calendar_edges(spark):
    days = spark.createDataFrame([(date(2021, 1, 3),), (date(2024, 3, 31),), (date(2024, 4, 1),)], "d date")
    attributes = calendar_attributes(F.col("d"))
    names = ["week", "day_of_week", "is_weekend", "fiscal_year", "fiscal_quarter", "fiscal_period"]
    got = [tuple(r) for r in days.select(*[attributes[n].alias(n) for n in names]).collect()]
    assert got == [
        (53, 7, True, 2020, "Q4", 10),
        (13, 7, True, 2023, "Q4", 12),
        (14, 1, False, 2024, "Q1", 1),
    ]


def test_month_end_of_texts(spark):
    df = spark.createDataFrame([("2024", "02"), ("24", "2"), ("x", "1")], "y string, p string")
    got = [r[0] for r in df.select(month_end(F.col("y"), F.col("p"))).collect()]
    assert got == [date(2024, 2, 29), None, None]
