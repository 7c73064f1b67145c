"""Which gold table is built from which tables, and building them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from tristrata.plans import dimensions, facts
from tristrata.plans.outcomes import Once, Outcome, attempt_all
from tristrata.plans.registry import RULES, Rule, keyed_tables
from tristrata.sources.tables import Layers, Layout, Written, store, store_split

SYSTEM = "GOLD"
Builder = Callable[..., DataFrame]

# The cleansed tables of each gold table, in the builder's order.
DIMENSIONS: dict[str, tuple[Builder, str]] = {
    "dim_product": (dimensions.product, "mara makt"),
    "dim_batch": (dimensions.batch, "mch1"),
    "dim_currency": (dimensions.currency, "lfm1 ekko"),
    "dim_date": (dimensions.dates, ""),
    "dim_storage": (dimensions.storage, "t001w t001l"),
    "dim_supplier": (dimensions.supplier, "lfa1 lfm1 lfb1"),
    "dim_uom": (dimensions.unit, "mara"),
    "dim_customer": (dimensions.customer, "master_customer"),
    "dim_customer_product": (dimensions.customer_product, "master_customer_product"),
    "dim_location": (dimensions.location, "master_location"),
    "dim_location_product": (dimensions.location_product, "master_location_product"),
}
FACTS: dict[str, tuple[Builder, str]] = {
    "fact_inventory": (facts.inventory, "mchb mard mbew mslb"),
    "fact_inventory_month_end_stock": (facts.month_end_stock, "mchbh mardh mbewh"),
    "fact_purchase_order": (
        facts.purchase_order,
        "ekko ekpo eket ekbe lfa1 t001 t001w t024 t024e",
    ),
    "fact_demand_actual": (facts.demand_actual, "demand_actual"),
    "fact_demand_forecast": (facts.demand_forecast, "demand_forecast"),
    "fact_batch_release_external": (facts.batch_release_external, "qals qave"),
    "fact_batch_release_internal": (facts.batch_release_internal, "qals qave"),
}
# Built from a fact that is already written, instead of working its joins out again.
DERIVED_FACTS: dict[str, tuple[Builder, str]] = {
    "fact_inventory_monthly_snapshot": (facts.monthly_snapshot, "fact_inventory_month_end_stock"),
}


# Facts that are parts of one frame: built together, in one pass over what they read.
SPLIT_FACTS: tuple[str, ...] = ("fact_batch_release_external", "fact_batch_release_internal")


def _frame(
    spark: SparkSession, build: Builder, sources: str, database: str, as_of: datetime | None, **more
) -> DataFrame:
    frames = [spark.table(f"{database}.{s}") for s in sources.split()]
    return build(*(frames or [spark]), as_of=as_of, **more)


def build_gold(
    spark: SparkSession,
    layers: Layers = Layers(),
    parallel: int = 4,
    as_of: datetime | None = None,
    partitions: Mapping[str, Sequence[str]] = {},
    failed: Iterable[str] = (),
    rules: Iterable[Rule] = RULES,
    merge_schema: bool = False,
) -> list[Outcome]:
    """Build every dimension and fact; ``partitions`` names the columns that a table's
    files are split by, such as the fiscal year of month-end stock. What reads one of the cleansed
    tables ``failed`` is reported and not built. A fact that is built from another one starts
    as soon as that one is done. ``rules`` are those that the tables were cleansed by: what they
    make unique is not counted. With ``merge_schema`` dimensions keep columns that they have; facts
    never do."""
    tables = DIMENSIONS | FACTS | DERIVED_FACTS
    keyed = keyed_tables(rules)

    def frame(name: str) -> DataFrame:
        build, sources = tables[name]
        database = layers.gold if name in DERIVED_FACTS else layers.silver
        more = {"keyed": keyed} if build in dimensions.TOLD_KEYS + facts.TOLD_KEYS else {}
        return _frame(spark, build, sources, database, as_of, **more)

    def load(name: str) -> Written:
        merge = merge_schema and name in DIMENSIONS
        layout = Layout(partitions.get(name, ()))
        return store(frame(name), f"{layers.gold}.{name}", layout, merge_schema=merge)

    def release() -> dict[str, Written]:
        lots = _frame(spark, facts.batch_release, FACTS[SPLIT_FACTS[0]][1], layers.silver, as_of, keyed=keyed)
        conditions = dict(zip(SPLIT_FACTS, (facts.is_external(), facts.is_internal())))
        return store_split(lots, {f"{layers.gold}.{t}": c for t, c in conditions.items()})

    split = () if any(t in partitions for t in SPLIT_FACTS) else SPLIT_FACTS
    once = Once(release)
    return attempt_all(
        spark,
        {
            (name, SYSTEM): (lambda n=name: once(f"{layers.gold}.{n}") if n in split else load(n))
            for name in tables
        },
        parallel,
        needs={name: sources.split() for name, (_, sources) in tables.items()},
        failed=failed,
        targets={(name, SYSTEM): f"{layers.gold}.{name}" for name in tables},
    )
