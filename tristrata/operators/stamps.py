"""Load metadata columns of each layer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristrata.functions.clock import now, today


def stamp_raw(
    df: DataFrame, source_file: str, source_system: str, as_of: datetime | None = None
) -> DataFrame:
    return df.withColumns(
        {
            "_ingestion_timestamp": now(as_of),
            "_source_file": F.lit(source_file),
            "_source_system": F.lit(source_system),
            "_bronze_load_date": today(as_of),
        }
    )


def stamp_cleansed(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return df.withColumns(
        {
            "_silver_load_timestamp": now(as_of),
            "_silver_load_date": today(as_of),
            "_is_current": F.lit(True),
        }
    )


def stamp_validity(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Validity columns of a dimension row that is current from this load on."""
    return df.withColumns(
        {
            "effective_date": today(as_of),
            "end_date": F.lit(None).cast("date"),
            "is_current": F.lit(True),
            "created_timestamp": now(as_of),
            "updated_timestamp": now(as_of),
        }
    )


def stamp_fact(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return df.withColumns({"created_timestamp": now(as_of), "updated_timestamp": now(as_of)})
