"""Quality reports on a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tristrata.functions.text import quoted
from tristrata.operators.schema import data_columns, without_metadata

_ROWS = "__rows"


def _nulls(df: DataFrame, names: Sequence[str], suffix: str = "") -> list:
    return [F.count_if(quoted(c).isNull()).alias(c + suffix) for c in names]


def null_counts(df: DataFrame, first: int | None = None, suffix: str = "") -> DataFrame:
    """One row with the number of NULLs per data column, in one pass; ``first``
    keeps to the leading columns."""
    return df.agg(*_nulls(df, data_columns(df)[:first], suffix))


def preview(df: DataFrame, rows: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """A few records without load metadata, by ``order_by`` where given."""
    shown = without_metadata(df)
    if order_by:
        shown = shown.orderBy(*[quoted(c) for c in order_by])
    return shown.limit(rows)


@dataclass(frozen=True)
class TableCheck:
    rows: int
    columns: int
    schema: StructType
    nulls: dict[str, int]
    sample: DataFrame


def check_table(df: DataFrame, first: int | None = None) -> TableCheck:
    """Rows, columns, schema, NULLs per data column and a sample, from one scan."""
    names = data_columns(df)[:first]
    counted = df.agg(F.count(F.lit(1)).alias(_ROWS), *_nulls(df, names)).first()
    return TableCheck(
        rows=counted[0],
        columns=len(df.columns),
        schema=df.schema,
        nulls=dict(zip(names, counted[1:])),
        sample=preview(df),
    )


def known_check(
    df: DataFrame, rows: int, nulls: Mapping[str, int], first: int | None = None
) -> TableCheck:
    """The same from numbers that were taken before, such as at the write: no scan."""
    return TableCheck(
        rows=rows,
        columns=len(df.columns),
        schema=df.schema,
        nulls={c: nulls[c] for c in data_columns(df)[:first]},
        sample=preview(df),
    )
