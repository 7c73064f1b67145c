"""Generic star-schema builders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.functions.calendar import calendar_attributes
from tristrata.functions.clock import now
from tristrata.functions.keys import surrogate_key
from tristrata.functions.text import quoted
from tristrata.operators.joins import attach
from tristrata.operators.schema import find_column
from tristrata.operators.skew import SkewPolicy
from tristrata.operators.stamps import stamp_fact, stamp_validity


def as_dimension(
    df: DataFrame, name: str, keys: Sequence[str], as_of: datetime | None = None
) -> DataFrame:
    """Add the key ``<name>_key`` and the validity columns."""
    return stamp_validity(df.withColumn(f"{name}_key", surrogate_key(*keys)), as_of)


def as_fact(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return stamp_fact(df, as_of)


def distinct_values(df: DataFrame, source: str, name: str) -> DataFrame:
    """The distinct present values of one column."""
    return df.select(quoted(source).alias(name)).where(quoted(name).isNotNull()).distinct()


def calendar(
    spark: SparkSession, start: date, end: date, as_of: datetime | None = None
) -> DataFrame:
    """A date dimension from ``start`` to ``end``, both included."""
    day = F.date_add(F.lit(start), F.col("id").cast("int"))
    days = spark.range((end - start).days + 1).select(day.alias("full_date"))
    attributes = calendar_attributes(F.col("full_date"))
    return days.select([c.alias(n) for n, c in attributes.items()]).withColumn(
        "created_timestamp", now(as_of)
    )


def dimension_keys(dimension: DataFrame, name: str, keys: Mapping[str, str]) -> DataFrame:
    """A dimension's business keys under their fact names (fact column -> dimension
    column) with its hashed key, one row each: rows that share the business key share
    the hashed key too."""
    named = [quoted(d).alias(f) for f, d in keys.items()]
    return dimension.select(*named, quoted(f"{name}_key")).distinct()


def attach_key(
    fact: DataFrame,
    dimension: DataFrame,
    name: str,
    keys: Mapping[str, str],
    policy: SkewPolicy = SkewPolicy(),
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Look up a dimension's key by business keys (fact column -> dimension column).

    The fact keeps its grain and its rows. Those without a dimension row, or with a
    missing business key, get NULL. ``keys_from`` names a frame with the fact's keys that is
    cheaper to count than the fact, such as its base table.
    """
    found = {find_column(fact, f) or f: d for f, d in keys.items()}
    known = dimension_keys(dimension, name, found)
    out = attach(fact, known, list(found), policy=policy, keys_from=keys_from, unique=True)
    return out.select(*[quoted(c) for c in fact.columns], quoted(f"{name}_key"))
