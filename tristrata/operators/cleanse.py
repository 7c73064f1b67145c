"""Cleansing: blanks, dates, repeated records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tristrata.functions.dates import compact_date
from tristrata.functions.text import blank_to_null, quoted
from tristrata.operators.schema import columns_of_type, find_column, without_metadata
from tristrata.operators.stamps import stamp_cleansed

_RANK = "__rank"


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Trim every string column and turn empty text into NULL."""
    text = set(columns_of_type(df, StringType))
    return df.select(
        [blank_to_null(quoted(c)).alias(c) if c in text else quoted(c) for c in df.columns]
    )


def parse_dates(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Turn the named columns into dates; names the frame lacks are passed over."""
    found = [c for c in (find_column(df, n) for n in names) if c is not None]
    parsed = {c: compact_date(quoted(c), df.schema[c].dataType) for c in found}
    return df.select([parsed[c].alias(c) if c in parsed else quoted(c) for c in df.columns])


def keep_latest(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """One record per key: the first one by ``order_by`` (default: the first
    column), descending. The other columns break ties, so the outcome depends
    neither on partitioning nor on row order.

    Spark keeps the best row of each key on the map side (``WindowGroupLimit``),
    so a key with any number of copies reaches the shuffle as one row per task.
    """
    lead = [
        c if isinstance(c, Column) else quoted(c).desc_nulls_last()
        for c in (order_by or df.columns[:1])
    ]
    settled = {k.lower() for k in (*keys, *_plain_names(order_by or df.columns[:1]))}
    rest = [quoted(c).desc_nulls_last() for c in df.columns if c.lower() not in settled]
    window = Window.partitionBy([quoted(k) for k in keys]).orderBy(*lead, *rest)
    return (
        df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)
    )


def _plain_names(order_by: Sequence[str | Column]) -> list[str]:
    return [c for c in order_by if isinstance(c, str)]


def cleanse(
    df: DataFrame,
    keys: Sequence[str] = (),
    dates: Sequence[str] = (),
    order_by: Sequence[str | Column] | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """The whole cleansing step for one raw table."""
    out = parse_dates(blanks_to_null(without_metadata(df)), dates)
    if keys:
        out = keep_latest(out, keys, order_by)
    return stamp_cleansed(out, as_of)
