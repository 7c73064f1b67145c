import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tristrata.operators import (
    apply_mapping,
    clean_name,
    clean_names,
    columns_of_type,
    data_columns,
    fields,
    measure_columns,
    project,
    without_metadata,
)
from tristrata.sources import mapping_sheet, read_mapping_sheet
from pyspark.sql.types import StringType


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Location (ID)", "Location_ID"),
        ("a  b", "a_b"),
        ("_x_", "x"),
        ("p;q", "p_q"),
        ("a.b", "a.b"),
        ("a-b%", "a-b%"),
        ("a\tb\nc", "a_b_c"),
        ("k={v}/w,", "k_v_w"),
        ("()", ""),
    ],
)
def test_clean_name(raw, clean):
    assert clean_name(raw) == clean


@given(st.text(max_size=30))
def test_clean_name_is_stable_and_tidy(raw):
    name = clean_name(raw)
    assert clean_name(name) == name
    assert "__" not in name and not name.startswith("_") and not name.endswith("_")
    assert not any(c in name for c in " ,;{}()/=\t\n")


def test_clashing_names_are_numbered(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["A B", "A(B", "a/b", "()"])
    assert clean_names(df).columns == ["A_B", "A_B_2", "a_b_3", "column_4"]


def test_clean_names_keeps_dots_usable(spark):
    df = spark.createDataFrame([(" x ",)], ["a.b"])
    assert without_metadata(clean_names(df)).first()[0] == " x "


def test_metadata_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "_b"])
    assert data_columns(df) == ["a"]
    assert without_metadata(df).columns == ["a"]


def test_columns_by_type(spark):
    df = spark.sql("select 1 a, 'x' b, 1.5bd c, 2L d, 1.5d e, cast(1 as float) f, cast(1 as short) g")
    assert columns_of_type(df, StringType) == ["b"]
    assert measure_columns(df) == ["a", "c", "d", "e", "f"]


def test_project_types_and_renames(spark):
    df = spark.createDataFrame([("01", "12.3456", "x"), (None, "bad", "y")], ["K", "V", "Z"])
    out = project(df, fields("K key string\nV value decimal(15,3)\nz z -"))
    assert out.dtypes == [("key", "string"), ("value", "decimal(15,3)"), ("z", "string")]
    assert [(r.key, None if r.value is None else str(r.value), r.z) for r in out.collect()] == [
        ("01", "12.346", "x"),
        (None, None, "y"),
    ]


SHEET = [
    ("demand", "MONTH", "period", 1),
    ("demand", "Product_Id", "material", 1),
    ("demand", "EXTRA", "extra", 0),
    ("other", "X", "y", 1),
]


def test_mapping_sheet_projection(spark):
    df = spark.createDataFrame([("202401", "P1", "e")], ["month", "PRODUCT_ID", "EXTRA"])
    out = apply_mapping(df, mapping_sheet(spark, SHEET), "DEMAND")
    assert out.columns == ["period", "material"]
    assert tuple(out.first()) == ("202401", "P1")


def test_mapping_sheet_names_absent_columns(spark):
    df = spark.createDataFrame([("202401",)], ["month"])
    with pytest.raises(ValueError, match="Product_Id"):
        apply_mapping(df, mapping_sheet(spark, SHEET), "demand")


@pytest.mark.parametrize(
    "text, number",
    [("12", "12.00"), (" 12.5\t", "12.50"), ("+1e2", "100.00"), (".5", "0.50"), ("-3.", "-3.00"),
     ("1,5", None), ("x", None), ("E", None), ("", None), (None, None), ("1e99", None)],
)
def test_numbers_in_text(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    got = project(df, fields("T n decimal(15,2)")).first().n
    assert (None if got is None else str(got)) == number
    assert got == df.select(df.t.try_cast("decimal(15,2)")).first()[0]


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(
    st.text(max_size=8),
    st.text(alphabet="0123456789１２٣４.eE+- \u00a0\u2003\t\x00\x7f\x85", max_size=8),
), min_size=1, max_size=40))
def test_numbers_in_any_text_equal_a_plain_cast(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    guarded = project(df, fields("t n decimal(15,2)\nt i int\nt l bigint"))
    plain = df.select(*[df.t.try_cast(k).alias(n) for n, k in (("n", "decimal(15,2)"), ("i", "int"), ("l", "bigint"))])
    assert guarded.collect() == plain.collect()


def test_mapping_sheet_is_read_by_header(spark, tmp_path):
    file = tmp_path / "sheet.csv"
    file.write_text("Include_In_Gold,note,business_name,source_table,source_column\n1,x,key,orders,A\nno,,other,orders,B\n")
    sheet = read_mapping_sheet(spark, str(file))
    assert sheet.collect() == [("orders", "A", "key", 1), ("orders", "B", "other", None)]
    df = spark.createDataFrame([(1, 2)], "A int, B int")
    assert apply_mapping(df, sheet, "orders").columns == ["key"]
    file.write_text("source_table,source_column,business_name\norders,A,key\n")
    with pytest.raises(ValueError, match="include_in_gold"):
        read_mapping_sheet(spark, str(file))


def test_mapping_sheet_names_are_unique(spark):
    df = spark.createDataFrame([(1, 2)], "A int, B int")
    sheet = mapping_sheet(spark, [("t", "A", "key", 1), ("t", "B", "KEY", 1)])
    with pytest.raises(ValueError, match="KEY"):
        apply_mapping(df, sheet, "t")
