"""Summaries over the built tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from tristrata.operators.schema import measure_columns
from tristrata.plans.outcomes import FAILED, SUCCESS
from tristrata.sources.tables import load_settings

Source = Callable[[], DataFrame]
# A table's rows where they are known, such as from the write.
Known = Callable[[str], "int | None"]


def _measure(name: str, source: Source, known: Known | None) -> tuple:
    try:
        df = source()
        rows = known(name) if known else None
        return name, df.count() if rows is None else rows, len(df.columns), len(measure_columns(df)), SUCCESS
    except Exception as error:  # noqa: BLE001 - the row is the report
        return name, 0, 0, 0, f"{FAILED}: {error}"


def _measure_all(
    spark: SparkSession, sources: Mapping[str, Source], known: Known | None, parallel: int = 4
) -> list[tuple]:
    """Several tables at a time, in the given order."""
    with load_settings(spark), ThreadPoolExecutor(max_workers=parallel) as pool:
        running = [
            pool.submit(inheritable_thread_target(spark)(_measure), n, s, known)
            for n, s in sources.items()
        ]
        return [r.result() for r in running]


def dimension_summary(
    spark: SparkSession, dimensions: Mapping[str, Source], known: Known | None = None
) -> DataFrame:
    """Name, rows, columns and status per dimension; an unreadable one is a FAILED row. Only what is
    not ``known`` is counted."""
    rows = _measure_all(spark, dimensions, known)
    return spark.createDataFrame(
        [(name, count, width, status) for name, count, width, _, status in rows],
        "dimension string, record_count bigint, column_count bigint, status string",
    )


def fact_summary(
    spark: SparkSession, facts: Mapping[str, Source], known: Known | None = None
) -> DataFrame:
    """As for dimensions, with the number of numeric columns."""
    return spark.createDataFrame(
        _measure_all(spark, facts, known),
        "fact_table string, record_count bigint, column_count bigint, "
        "measure_count bigint, status string",
    )
