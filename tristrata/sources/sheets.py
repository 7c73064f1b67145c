"""Mapping sheets: which source column becomes which business column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tristrata.functions.text import quoted
from tristrata.operators.schema import clean_names, find_column
from tristrata.sources.csv import read_csv

SHEET_SCHEMA = (
    "source_table string, source_column string, business_name string, include_in_gold int"
)
SHEET_COLUMNS = [column.split()[0] for column in SHEET_SCHEMA.split(", ")]


def read_mapping_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Read a sheet by its header: columns may stand in any order and case, and more may
    follow. A mark that is no number counts as not marked."""
    sheet = clean_names(read_csv(spark, path))
    found = {c: find_column(sheet, c) for c in SHEET_COLUMNS}
    absent = [c for c, column in found.items() if column is None]
    if absent:
        raise ValueError(f"{path} has no column {', '.join(absent)}")
    return sheet.select(
        *[quoted(column).alias(c) for c, column in found.items() if c != "include_in_gold"],
        quoted(found["include_in_gold"]).try_cast("int").alias("include_in_gold"),
    )


def mapping_sheet(spark: SparkSession, rows: Iterable[tuple[str, str, str, int]]) -> DataFrame:
    return spark.createDataFrame(list(rows), SHEET_SCHEMA)
