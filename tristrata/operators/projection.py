"""Renaming and typing projections, one ``select`` each."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tristrata.functions.text import quoted
from tristrata.operators.schema import find_column

AS_READ = "-"
EXACT_NUMBERS = ("decimal", "int", "bigint")
# Every text that Spark reads as an exact number is made of these characters: blanks, control
# characters, signs, and digits of any script.
_NUMBER_TEXT = r"^[\p{Z}\p{C}\p{Nd}.eE+-]+$"


class Field(NamedTuple):
    source: str
    name: str
    type: str = AS_READ


def fields(table: str) -> tuple[Field, ...]:
    """Read a projection written as lines of ``source name type``; the type ``-``
    leaves the column as it was read."""
    return tuple(Field(*line.split()) for line in table.strip().splitlines())


def only(layout: Sequence[Field], names: str) -> tuple[Field, ...]:
    """The named fields of a layout, in the given order."""
    by_name = {f.name: f for f in layout}
    return tuple(by_name[n] for n in names.split())


def project(df: DataFrame, layout: Sequence[Field]) -> DataFrame:
    """Pick, rename and type columns. A value that does not fit its type is NULL."""
    return df.select([_typed(df, f).alias(f.name) for f in layout])


def _typed(df: DataFrame, field: Field) -> Column:
    value = quoted(field.source)
    if field.type == AS_READ:
        return value
    typed = value.try_cast(field.type)
    source = find_column(df, field.source)
    is_text = source is not None and isinstance(df.schema[source].dataType, StringType)
    if is_text and field.type.startswith(EXACT_NUMBERS):
        # A failed cast is slow, so plain junk does not get that far.
        return F.when(value.rlike(_NUMBER_TEXT), typed)
    return typed


def apply_mapping(df: DataFrame, sheet: DataFrame, source_table: str) -> DataFrame:
    """Project by a mapping sheet (``source_table, source_column, business_name,
    include_in_gold``): the rows of one table that are marked 1, in sheet order.

    The sheet describes columns, so it is as small as a schema; its rows are read
    to the driver to shape one ``select``.
    """
    rows = (
        sheet.where(F.lower("source_table") == source_table.lower())
        .where(F.col("include_in_gold").try_cast("int") == 1)
        .select("source_column", "business_name")
        .collect()
    )
    pairs = [(find_column(df, r.source_column), r) for r in rows]
    absent = [r.source_column for found, r in pairs if found is None]
    if absent:
        raise ValueError(f"{source_table} has no column {', '.join(absent)}")
    names = [r.business_name.lower() for _, r in pairs]
    twice = [r.business_name for _, r in pairs if names.count(r.business_name.lower()) > 1]
    if twice:
        raise ValueError(f"{source_table} gets several columns {', '.join(twice)}")
    return df.select([quoted(found).alias(r.business_name) for found, r in pairs])
