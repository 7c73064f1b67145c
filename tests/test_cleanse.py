from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tristrata.operators import blanks_to_null, cleanse, keep_latest, parse_dates

AS_OF = datetime(2024, 5, 6, 7, 8, 9)


def test_blanks_to_null(spark):
    df = spark.createDataFrame([("  x ", 1), ("", 2), ("  ", 3), (None, 4), ("\tx", 5)], ["s", "n"])
    assert [r.s for r in blanks_to_null(df).collect()] == ["x", None, None, None, "\tx"]


@pytest.mark.parametrize(
    "text, day",
    [
        ("20240115", date(2024, 1, 15)),
        ("00000000", None),
        ("20230230", None),
        ("20241345", None),
        ("2024011", None),
        ("2024-01-15", None),
        ("x", None),
        (None, None),
    ],
)
def test_date_texts(spark, text, day):
    df = spark.createDataFrame([(text,)], "d string")
    assert parse_dates(df, ["D", "absent"]).first().d == day


def test_date_numbers_dates_and_timestamps(spark):
    df = spark.sql(
        "select 20240115 n, 20240115L b, date'2024-01-15' d, timestamp'2024-01-15 03:04:05' t,"
        " timestamp_ntz'2024-01-15 03:04:05' z, 5 short"
    )
    got = parse_dates(df, df.columns).first()
    assert tuple(got) == (date(2024, 1, 15),) * 5 + (None,)


def test_keep_latest_takes_first_column_by_default(spark):
    df = spark.createDataFrame([(1, "k", "a"), (3, "k", "b"), (2, "k", "c"), (9, None, "n")],
                               ["v", "key", "x"])
    got = {tuple(r) for r in keep_latest(df, ["key"]).collect()}
    assert got == {(3, "k", "b"), (9, None, "n")}


def test_keep_latest_explicit_order(spark):
    df = spark.createDataFrame([(1, "k", "a"), (3, "k", "b")], ["v", "key", "x"])
    assert keep_latest(df, ["key"], [F.col("v").asc()]).first().x == "a"
    assert keep_latest(df, ["key"], ["x"]).first().x == "b"


def test_keep_latest_ignores_partitioning_and_null_order(spark):
    data = [(1, i % 3, None if i % 4 == 0 else i, str(i % 7)) for i in range(200)]
    df = spark.createDataFrame(data, "flag int, key int, a int, b string")
    outcomes = {
        tuple(sorted(map(tuple, keep_latest(df.repartition(n), ["key"]).collect())))
        for n in (1, 3, 8)
    }
    assert len(outcomes) == 1
    assert len(outcomes.pop()) == 3


def test_keep_latest_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 5 as key", "id as v").repartition(4)
    plan = keep_latest(df, ["key"], ["v"])._jdf.queryExecution().executedPlan().toString()
    partial, exchange = plan.index("Partial"), plan.index("Exchange hashpartitioning")
    assert plan.count("WindowGroupLimit") == 2 and exchange < partial


def test_missing_key_fails(spark):
    with pytest.raises(Exception, match="absent"):
        keep_latest(spark.range(3), ["absent"]).collect()


def test_cleanse_end_to_end(spark):
    df = spark.createDataFrame(
        [("20240101", " a ", "1", "f"), ("20240201", " a ", "", "f"), ("bad", "b", "2", "f")],
        ["day", "key", "x", "_source_file"],
    )
    out = cleanse(df, ["key"], ["day"], as_of=AS_OF)
    assert out.columns == [
        "day", "key", "x", "_silver_load_timestamp", "_silver_load_date", "_is_current",
    ]
    got = {r.key: (r.day, r.x, r._silver_load_timestamp, r._silver_load_date) for r in out.collect()}
    stamps = (AS_OF, AS_OF.date())
    assert got == {"a": (date(2024, 2, 1), None, *stamps), "b": (None, "2", *stamps)}


records = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]),
        st.one_of(st.none(), st.integers(0, 3)),
        st.sampled_from(["x", "y", None]),
    ),
    max_size=30,
)


@settings(max_examples=8, deadline=None)
@given(data=records)
def test_keep_latest_equals_brute_force(spark, data):
    def rank(row):
        return [(v is not None, v) if v is not None else (False, 0) for v in (row[1], str(row[2] or ""))]

    best = {}
    for row in data:
        if row[0] not in best or rank(row) > rank(best[row[0]]):
            best[row[0]] = row
    df = spark.createDataFrame(data, "key string, v int, w string").repartition(3)
    got = keep_latest(df, ["key"], ["v"]).collect()
    assert sorted(map(tuple, got), key=str) == sorted(best.values(), key=str)
