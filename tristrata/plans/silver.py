"""Cleansed layer."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import SparkSession

from tristrata.operators.cleanse import cleanse
from tristrata.plans.outcomes import Outcome, attempt_all
from tristrata.plans.registry import RULES, Rule
from tristrata.sources.tables import Layers, Layout, Written, store


def refine(
    spark: SparkSession,
    rule: Rule,
    layers: Layers = Layers(),
    order_by: Sequence[str] | None = None,
    as_of: datetime | None = None,
    layout: Layout = Layout(),
    profile: bool = False,
    merge_schema: bool = False,
) -> Written:
    """Cleanse one raw table; returns the rows written, with ``profile`` the NULLs of each column. With
    ``merge_schema`` the table keeps columns that the raw one no longer has."""
    raw = spark.table(f"{layers.bronze}.{rule.raw_table}")
    clean = cleanse(raw, rule.keys, rule.dates, order_by, as_of)
    table = f"{layers.silver}.{rule.table}"
    return store(clean, table, layout, profile=profile, merge_schema=merge_schema)


def refine_all(
    spark: SparkSession,
    rules: Iterable[Rule] = RULES,
    layers: Layers = Layers(),
    orders: Mapping[str, Sequence[str]] = {},
    parallel: int = 4,
    as_of: datetime | None = None,
    failed: Iterable[str] = (),
    layouts: Mapping[str, Layout] = {},
    profiled: Iterable[str] = (),
    merge_schema: bool = False,
) -> list[Outcome]:
    """Cleanse every raw table; ``orders`` says by cleansed table which record of a
    key is the latest, where that is not its first column. The raw tables ``failed`` hold rows of
    an earlier load, so theirs are reported and not built. ``layouts`` says by cleansed table how its
    files lie (see ``stock_layouts``), ``profiled`` names those whose NULLs are counted at the write."""
    rules, profiled = tuple(rules), set(profiled)
    return attempt_all(
        spark,
        {
            (r.table, r.system): lambda r=r: refine(
                spark, r, layers, orders.get(r.table), as_of, layouts.get(r.table, Layout()),
                r.table in profiled, merge_schema,
            )
            for r in rules
        },
        parallel,
        needs={r.table: [r.raw_table] for r in rules},
        failed=failed,
        targets={(r.table, r.system): f"{layers.silver}.{r.table}" for r in rules},
    )


# The stock tables and their columns for material and plant.
STOCK_KEYS = {
    "mchb": ("MATNR", "WERKS"),
    "mard": ("MATNR", "WERKS"),
    "mbew": ("MATNR", "BWKEY"),
    "mslb": ("MATNR", "WERKS"),
    "mchbh": ("MATNR", "WERKS"),
    "mardh": ("MATNR", "WERKS"),
    "mbewh": ("MATNR", "BWKEY"),
}


def stock_buckets_for(rows: int, rows_per_bucket: int = 400_000) -> int:
    """The number of buckets for stock tables, the largest of which has so many rows, so that a task's share of the
    joins does not grow with the tables: more tables mean more tasks."""
    return max(8, -(-rows // rows_per_bucket))


def stock_layouts(buckets: int) -> dict[str, Layout]:
    """Stock tables in sorted buckets by material and plant: in a session where joins may share partitions on
    part of their keys (``spark.sql.requireAllClusterKeysForCoPartition=false``) the stock facts then join
    them without a shuffle. Choose the number for the size that the largest is to reach; a bucket is one task."""
    return {table: Layout(buckets=buckets, bucket_by=keys) for table, keys in STOCK_KEYS.items()}
