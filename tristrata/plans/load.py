"""The whole load, layer by layer."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tristrata.operators.profile import TableCheck, check_table, known_check
from tristrata.plans.bronze import ingest_all
from tristrata.plans.gold import DERIVED_FACTS, DIMENSIONS, FACTS, build_gold
from tristrata.plans.outcomes import Outcome, outcome_log
from tristrata.plans.registry import RULES, Rule
from tristrata.plans.reports import dimension_summary, fact_summary
from tristrata.plans.silver import refine_all
from tristrata.sources.tables import Layers, Layout, create_layers, recorded, write_table

LOG_TABLE = "ingestion_log"
# The tables whose quality is checked after a load, and how many of
# their leading columns the cleansed check looks at.
KEY_RAW_TABLES = ("sap_mara", "sap_ekko", "sap_ekpo", "ibp_demand_actual", "ibp_demand_forcast")
KEY_CLEANSED_TABLES = ("mara", "ekko", "ekpo", "demand_actual", "demand_forecast")
CHECKED_COLUMNS = 5


@dataclass(frozen=True)
class LoadResult:
    bronze: list[Outcome]
    silver: list[Outcome]
    gold: list[Outcome]

    @property
    def ok(self) -> bool:
        return all(o.ok for o in self.bronze + self.silver + self.gold)

    @property
    def failed(self) -> list[Outcome]:
        return [o for o in self.bronze + self.silver + self.gold if not o.ok]


def run(
    spark: SparkSession,
    folders: Mapping[str, str],
    rules: Iterable[Rule] = RULES,
    layers: Layers = Layers(),
    orders: Mapping[str, Sequence[str]] = {},
    infer: bool = False,
    parallel: int = 4,
    as_of: datetime | None = None,
    location: str | None = None,
    partitions: Mapping[str, Sequence[str]] = {},
    multi_line: bool = False,
    layouts: Mapping[str, Layout] = {},
    merge_schema: bool = True,
) -> LoadResult:
    """Load extracts into all three layers. A table that fails is reported in the
    result, with all that are built from it; the others are loaded. ``multi_line`` holds for
    every extract; a rule can ask for it alone. ``layouts`` says how cleansed tables' files lie. With
    ``merge_schema`` raw and cleansed tables and dimensions keep columns that earlier loads had. The NULLs of
    the tables that are checked after a load are counted while these are written."""
    rules = tuple(rules)
    create_layers(spark, layers, location)
    bronze = ingest_all(
        spark, folders, rules, layers, parallel, KEY_RAW_TABLES,
        infer=infer, multi_line=multi_line, as_of=as_of, merge_schema=merge_schema,
    )
    write_table(outcome_log(spark, bronze), f"{layers.bronze}.{LOG_TABLE}")
    absent = [r.raw_table for r, o in zip(rules, bronze) if not o.ok]
    silver = refine_all(
        spark, rules, layers, orders, parallel, as_of, absent, layouts, KEY_CLEANSED_TABLES,
        merge_schema,
    )
    old = [o.table_name for o in silver if not o.ok]
    gold = build_gold(spark, layers, parallel, as_of, partitions, old, rules, merge_schema)
    return LoadResult(bronze, silver, gold)


def check_raw(
    spark: SparkSession, tables: Iterable[str] = KEY_RAW_TABLES, layers: Layers = Layers()
) -> dict[str, TableCheck | Exception]:
    return _checks(spark, layers.bronze, tables, None)


def check_cleansed(
    spark: SparkSession, tables: Iterable[str] = KEY_CLEANSED_TABLES, layers: Layers = Layers()
) -> dict[str, TableCheck | Exception]:
    return _checks(spark, layers.silver, tables, CHECKED_COLUMNS)


def _checks(spark, database, tables, first) -> dict[str, TableCheck | Exception]:
    """Checks from what was counted at the write, without a scan; a table that was not profiled
    then, or was changed since, is scanned once."""
    found: dict[str, TableCheck | Exception] = {}
    for name in tables:
        try:
            df, written = spark.table(f"{database}.{name}"), recorded(spark, f"{database}.{name}")
            if written is None or written.nulls is None:
                found[name] = check_table(df, first)
            else:
                found[name] = known_check(df, written.rows, written.nulls, first)
        except Exception as error:  # noqa: BLE001 - the entry is the report
            found[name] = error
    return found


def summarize_dimensions(spark: SparkSession, layers: Layers = Layers()) -> DataFrame:
    return dimension_summary(spark, *_sources(spark, layers, DIMENSIONS))


def summarize_facts(spark: SparkSession, layers: Layers = Layers()) -> DataFrame:
    return fact_summary(spark, *_sources(spark, layers, FACTS | DERIVED_FACTS))


def _sources(spark, layers, names):
    """The tables, and their rows as recorded at the write."""

    def rows(name: str) -> int | None:
        written = recorded(spark, f"{layers.gold}.{name}")
        return written and written.rows

    return {n: lambda n=n: spark.table(f"{layers.gold}.{n}") for n in names}, rows
