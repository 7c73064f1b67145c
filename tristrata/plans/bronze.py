"""Raw layer: extracts as they are, with clean headers and load metadata."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tristrata.operators.schema import clean_names
from tristrata.operators.stamps import stamp_raw
from tristrata.plans.outcomes import Outcome, attempt_all
from tristrata.plans.registry import RULES, Rule
from tristrata.sources.csv import read_csv
from tristrata.sources.tables import Layers, Written, store

BAD_ROWS = "_bad_row"


def raw_frame(
    extract: DataFrame, source_file: str, system: str, as_of: datetime | None = None
) -> DataFrame:
    return stamp_raw(clean_names(extract), source_file, system, as_of)


def ingest(
    spark: SparkSession,
    folder: str,
    rule: Rule,
    layers: Layers = Layers(),
    infer: bool = False,
    multi_line: bool = False,
    as_of: datetime | None = None,
    profile: bool = False,
    merge_schema: bool = False,
) -> Written:
    """Load one extract into its raw table; returns the rows written, how many of them
    had too many or too few cells, or a cell that did not fit, and with ``profile`` the NULLs of
    each column. With ``merge_schema`` the table keeps columns that the extract no longer has."""
    file = f"{rule.extract}.csv"
    extract = read_csv(
        spark, f"{folder.rstrip('/')}/{file}", infer=infer,
        multi_line=multi_line or rule.multi_line, bad_rows=BAD_ROWS,
    )
    frame = raw_frame(extract, file, rule.system, as_of)
    bad = frame.columns[len(extract.columns) - 1]  # as its name was cleaned
    return store(
        frame, f"{layers.bronze}.{rule.raw_table}", bad_rows=bad, profile=profile, merge_schema=merge_schema
    )


def ingest_all(
    spark: SparkSession,
    folders: Mapping[str, str],
    rules: Iterable[Rule] = RULES,
    layers: Layers = Layers(),
    parallel: int = 4,
    profiled: Iterable[str] = (),
    **options,
) -> list[Outcome]:
    """Load every extract; ``folders`` gives the folder of each source system, ``profiled`` the raw
    tables whose NULLs are counted while they are written."""
    rules, profiled = tuple(rules), set(profiled)
    return attempt_all(
        spark,
        {
            (r.extract, r.system): lambda r=r: ingest(
                spark, folders[r.system], r, layers, profile=r.raw_table in profiled, **options
            )
            for r in rules
        },
        parallel,
        targets={(r.extract, r.system): f"{layers.bronze}.{r.raw_table}" for r in rules},
    )
