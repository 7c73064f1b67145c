"""Operators that look only at column names and types."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
)

from tristrata.functions.text import quoted

METADATA_PREFIX = "_"
# Types that count as measures.
MEASURE_TYPES = (DecimalType, DoubleType, FloatType, LongType, IntegerType)

# Characters a table format may refuse, with the underscore itself so that one
# substitution also merges neighbouring underscores.
_AWKWARD = re.compile(r"[\s,;{}()/=_]+")


def clean_name(name: str) -> str:
    """A header as a column name, e.g. ``Location (ID)`` -> ``Location_ID``."""
    return _AWKWARD.sub("_", name).strip("_")


def clean_names(df: DataFrame) -> DataFrame:
    """Clean every column name. Names that clash (in any case) are numbered
    ``_2``, ``_3``, ...; a name with nothing left becomes ``column_<position>``."""
    taken: set[str] = set()
    names = []
    for position, raw in enumerate(df.columns, start=1):
        base = clean_name(raw) or f"column_{position}"
        name, copy = base, 1
        while name.lower() in taken:
            copy += 1
            name = f"{base}_{copy}"
        taken.add(name.lower())
        names.append(name)
    return df.toDF(*names)


def data_columns(df: DataFrame) -> list[str]:
    """Names of the columns that are not load metadata."""
    return [c for c in df.columns if not c.startswith(METADATA_PREFIX)]


def without_metadata(df: DataFrame) -> DataFrame:
    return df.select([quoted(c) for c in data_columns(df)])


def columns_of_type(df: DataFrame, *types: type[DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def measure_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, *MEASURE_TYPES)


def find_column(df: DataFrame, name: str) -> str | None:
    """The frame's own spelling of a column, matched in any case."""
    return next((c for c in df.columns if c.lower() == name.lower()), None)
