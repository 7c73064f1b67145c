"""The facts, each from cleansed tables. Builders are lazy and write nothing,
except that joins of large sides first look for hot keys."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tristrata.functions.clock import today
from tristrata.functions.dates import month_end, period_start
from tristrata.functions.text import decode
from tristrata.operators.joins import attach
from tristrata.operators.projection import Field, fields, only, project
from tristrata.operators.skew import KeyCounts, SkewPolicy
from tristrata.operators.star import as_fact
from tristrata.plans.registry import KEYED, Keyed, is_unique

# Source column, published column, type ("-" leaves it as read).
BATCH_STOCK = fields("""
MATNR  material_number         string
WERKS  plant                   string
LGORT  storage_location        string
CHARG  batch_number            string
CLABS  unrestricted_stock_qty  decimal(15,3)
CUMLM  stock_in_transit_qty    decimal(15,3)
CINSM  quality_inspection_qty  decimal(15,3)
CSPEM  blocked_stock_qty       decimal(15,3)
""")
LOCATION_STOCK = fields("""
MATNR  material_number            string
WERKS  plant                      string
LGORT  storage_location           string
LABST  valuated_unrestricted_qty  decimal(15,3)
INSME  valuated_quality_insp_qty  decimal(15,3)
SPEME  valuated_blocked_qty       decimal(15,3)
""")
VALUATION = fields("""
MATNR  material_number       string
BWKEY  plant                 string
VERPR  moving_average_price  decimal(15,2)
STPRS  standard_price        decimal(15,2)
PEINH  price_unit            decimal(15,3)
BWTAR  valuation_type        -
BKLAS  valuation_class       -
""")
SPECIAL_STOCK = fields("""
MATNR  material_number    string
WERKS  plant              string
CHARG  batch_number       string
LBLAB  special_stock_qty  decimal(15,3)
""")
PERIOD = fields("""
LFGJA  fiscal_year    int
LFMON  fiscal_period  int
""")
PAST_LOCATION_STOCK = only(
    LOCATION_STOCK, "material_number plant storage_location valuated_unrestricted_qty"
)
PAST_VALUATION = only(VALUATION, "material_number plant moving_average_price standard_price")

ORDER_HEADER = fields("""
EBELN  purchase_order    string
BSART  po_type           string
LIFNR  supplier_number   string
EKORG  purchasing_org    string
EKGRP  purchasing_group  string
WAERS  currency          string
STATU  order_status      string
BEDAT  po_date           string
ERNAM  created_by        string
AEDAT  created_on        string
""")
ORDER_ITEM = fields("""
EBELN  purchase_order    string
EBELP  po_item           string
MATNR  material_number   string
BUKRS  company           string
WERKS  plant             string
LGORT  storage_location  string
MATKL  material_group    string
TXZ01  short_text        string
MEINS  order_unit        string
PSTYP  item_category     string
MENGE  order_quantity    decimal(15,3)
NETPR  net_price         decimal(15,2)
""")
SCHEDULE_LINE = fields("""
EBELN  purchase_order      string
EBELP  po_item             string
ETENR  schedule_line       string
EINDT  delivery_date       string
MENGE  scheduled_quantity  decimal(15,3)
WEMNG  goods_receipt_qty   decimal(15,3)
""")
ORDER_HISTORY = fields("""
EBELN  purchase_order   string
EBELP  po_item          string
MENGE  delivered_qty    decimal(15,3)
DMBTR  delivered_value  decimal(15,2)
""")
SUPPLIER_NAME = fields("""
LIFNR  supplier_number  string
NAME1  supplier_name    string
""")
COMPANY_NAME = fields("""
BUKRS  company       string
BUTXT  company_name  string
""")
PLANT_NAME = fields("""
WERKS  plant       string
NAME1  plant_name  string
""")
GROUP_NAME = fields("""
EKGRP  purchasing_group       string
EKNAM  purchasing_group_name  string
""")
ORG_NAME = fields("""
EKORG  purchasing_org       string
EKOTX  purchasing_org_name  string
""")
DEMAND_ACTUAL = fields("""
market          customer_id     -
material        product_id      -
period_id       period_id       -
period          period          -
actual_qty      actual_qty      decimal(15,3)
actual_revenue  actual_revenue  decimal(15,2)
shipped_qty     shipped_qty     decimal(15,3)
delivered_qty   delivered_qty   decimal(15,3)
net_actual_qty  net_actual_qty  decimal(15,3)
net_revenue     net_revenue     decimal(15,2)
service_level   service_level   decimal(10,4)
""")
DEMAND_FORECAST = fields("""
market                         customer_id                    -
material                       product_id                     -
period_id                      period_id                      -
period                         period                         -
consensus_demand               consensus_demand               decimal(15,3)
ibp_consensus_forecast         ibp_consensus_forecast         decimal(15,3)
ibp_forecast                   ibp_forecast                   decimal(15,3)
budget_volumes                 budget_volumes                 decimal(15,3)
sc_forecast_override           sc_forecast_override           decimal(15,3)
statistical_forecast           statistical_forecast           decimal(15,3)
upside                         upside_forecast                decimal(15,3)
fcst_snapshot_1                fcst_snapshot_1                decimal(15,3)
fcst_snapshot_2                fcst_snapshot_2                decimal(15,3)
fcst_snapshot_3                fcst_snapshot_3                decimal(15,3)
fcst_snapshot_4                fcst_snapshot_4                decimal(15,3)
fcst_snapshot_5                fcst_snapshot_5                decimal(15,3)
fcst_snapshot_6                fcst_snapshot_6                decimal(15,3)
fcst_snapshot_7                fcst_snapshot_7                decimal(15,3)
fcst_snapshot_8                fcst_snapshot_8                decimal(15,3)
fcst_snapshot_9                fcst_snapshot_9                decimal(15,3)
fcst_snapshot_10               fcst_snapshot_10               decimal(15,3)
fcst_snapshot_11               fcst_snapshot_11               decimal(15,3)
fcst_snapshot_12               fcst_snapshot_12               decimal(15,3)
fcst_variance_snapshot_2       fcst_variance_snapshot_2       decimal(15,3)
fcst_variance_snapshot_3       fcst_variance_snapshot_3       decimal(15,3)
fcst_variance_perc_snapshot_2  fcst_variance_perc_snapshot_2  decimal(15,2)
fcst_variance_perc_snapshot_3  fcst_variance_perc_snapshot_3  decimal(15,2)
ibp_consensus_forecast_prior   ibp_consensus_forecast_prior   decimal(15,3)
""")
INSPECTION_LOT = fields("""
PRUEFLOS    inspection_lot         string
MATNR       material_number        string
WERK        plant                  string
LIFNR       supplier_number        string
EBELN       purchase_order         string
EBELP       po_item                string
ART         inspection_type        string
ENSTEHDAT   inspection_start_date  string
BUDAT       posting_date           string
LOSMENGE    lot_size               decimal(15,3)
GESSTICHPR  sample_size            decimal(15,3)
""")
USAGE_DECISION = fields("""
PRUEFLOS    inspection_lot     string
VBEWERTUNG  usage_decision     string
DBEWERTUNG  defect_assessment  string
VFOLGEAKTI  follow_up_action   string
VDATUM      decision_date      string
VAUSWAHLMG  selected_qty       decimal(15,3)
""")

# Codes and labels.
GOODS_RECEIPT = "1"
EXTERNAL_INSPECTION = "04"
PO_TYPE_CATEGORIES = {"NB": "Direct", "ZARB": "Indirect", "UB": "STO"}
PO_SUB_TYPES = {"L": "Subcontract", None: "Turn Key"}
OTHER = "Other"

# Output order.
INVENTORY_COLUMNS = (
    "material_number plant storage_location batch_number "
    "unrestricted_stock_qty stock_in_transit_qty quality_inspection_qty blocked_stock_qty "
    "valuated_unrestricted_qty valuated_quality_insp_qty valuated_blocked_qty "
    "moving_average_price standard_price price_unit valuation_type valuation_class "
    "special_stock_qty"
).split()
MONTH_END_COLUMNS = (
    "material_number plant storage_location batch_number fiscal_year fiscal_period "
    "unrestricted_stock_qty stock_in_transit_qty quality_inspection_qty blocked_stock_qty "
    "valuated_unrestricted_qty moving_average_price standard_price"
).split()
PURCHASE_ORDER_COLUMNS = (
    "purchase_order po_item schedule_line supplier_number material_number plant "
    "storage_location po_type po_date created_by created_on purchasing_org "
    "purchasing_org_name purchasing_group purchasing_group_name currency order_status "
    "short_text material_group order_unit order_quantity net_price item_category "
    "delivery_date scheduled_quantity goods_receipt_qty delivered_qty delivered_value "
    "supplier_name plant_name company_name"
).split()

LOCATION_KEYS = ["material_number", "plant", "storage_location"]
PLANT_KEYS = ["material_number", "plant"]
BATCH_KEYS = ["material_number", "plant", "batch_number"]
PERIOD_KEYS = ["fiscal_year", "fiscal_period"]
ITEM_KEYS = ["purchase_order", "po_item"]


def with_stock_totals(df: DataFrame) -> DataFrame:
    """Stock on hand (transit left out) and its value at the moving price; a missing
    part leaves the total open."""
    quantity = (
        F.col("unrestricted_stock_qty")
        + F.col("quality_inspection_qty")
        + F.col("blocked_stock_qty")
    )
    return df.withColumn("total_stock_qty", quantity).withColumn(
        "total_stock_value", F.col("total_stock_qty") * F.col("moving_average_price")
    )


def inventory(
    batch_stock: DataFrame,
    location_stock: DataFrame,
    valuation: DataFrame,
    special_stock: DataFrame,
    as_of: datetime | None = None,
    policy: SkewPolicy = SkewPolicy(),
    keyed: Keyed = KEYED,
) -> DataFrame:
    """Current stock by material, plant, location and batch; several special stocks
    of one batch repeat its row.

    The coarsest key is joined first: a session that lets joins share partitions on
    part of their keys (``spark.sql.requireAllClusterKeysForCoPartition=false``) then
    shuffles the batches once instead of three times.
    """
    base = project(batch_stock, BATCH_STOCK)
    counts = KeyCounts()
    out = base
    for table, side, layout, keys in (
        ("mbew", valuation, VALUATION, PLANT_KEYS),
        ("mard", location_stock, LOCATION_STOCK, LOCATION_KEYS),
        ("mslb", special_stock, SPECIAL_STOCK, BATCH_KEYS),
    ):
        out = attach(
            out, project(side, layout), keys, policy=policy, keys_from=base,
            unique=is_unique(table, layout, keys, keyed), counts=counts,
        )
    dated = out.select(*INVENTORY_COLUMNS, today(as_of).alias("snapshot_date"))
    return as_fact(with_stock_totals(dated), as_of)


def month_end_stock(
    batch_stock: DataFrame,
    location_stock: DataFrame,
    valuation: DataFrame,
    as_of: datetime | None = None,
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """Stock of past periods, dated by the last day of the period."""
    base = project(batch_stock, BATCH_STOCK + PERIOD)
    stock = project(location_stock, PAST_LOCATION_STOCK + PERIOD)
    price = project(valuation, PAST_VALUATION + PERIOD)
    counts = KeyCounts()
    out = attach(base, price, PLANT_KEYS + PERIOD_KEYS, policy=policy, keys_from=base, counts=counts)
    out = attach(
        out, stock, LOCATION_KEYS + PERIOD_KEYS, policy=policy, keys_from=base, counts=counts
    )
    dated = out.select(
        *MONTH_END_COLUMNS,
        month_end(F.col("fiscal_year"), F.col("fiscal_period")).alias("month_end_date"),
    )
    return as_fact(with_stock_totals(dated), as_of)


def monthly_snapshot(month_end_fact: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Month-end stock summed over locations and batches. The date follows from the
    grouping columns, so any of a group's dates is its date."""
    totals = month_end_fact.groupBy(*PLANT_KEYS, *PERIOD_KEYS).agg(
        F.sum("unrestricted_stock_qty").alias("total_unrestricted_qty"),
        F.sum("quality_inspection_qty").alias("total_quality_insp_qty"),
        F.sum("blocked_stock_qty").alias("total_blocked_qty"),
        F.sum("total_stock_qty").alias("total_inventory_qty"),
        F.sum("total_stock_value").alias("total_inventory_value"),
        F.avg("moving_average_price").alias("avg_price"),
        F.count("batch_number").alias("batch_count"),
        F.max("month_end_date").alias("snapshot_date"),
    )
    return as_fact(totals, as_of)


def delivered(history: DataFrame) -> DataFrame:
    """Goods received per order item."""
    receipts = history.where(F.col("VGABE").cast("string") == GOODS_RECEIPT)
    return (
        project(receipts, ORDER_HISTORY)
        .groupBy(*ITEM_KEYS)
        .agg(
            F.sum("delivered_qty").alias("delivered_qty"),
            F.sum("delivered_value").alias("delivered_value"),
        )
    )


def _looked_up(
    base: DataFrame,
    unique: bool,
    names: Iterable[tuple[str, DataFrame, Sequence[Field], str]],
    policy: SkewPolicy,
    keyed: Keyed,
    counts: KeyCounts,
    keys_from: DataFrame,
) -> tuple[DataFrame, bool]:
    """A table with the names of its codes (table, frame, layout, code), and whether it still has one row
    where it had one: a table of names that is not unique by its code repeats rows. Names are mostly few."""
    out = base
    for table, side, layout, key in names:
        single = is_unique(table, layout, [key], keyed)
        out = attach(
            out, project(side, layout), [key], policy=policy, keys_from=keys_from, unique=single,
            counts=counts, measured=True,
        )
        unique = unique and single
    return out, unique


def purchase_order(
    headers: DataFrame,
    items: DataFrame,
    schedule: DataFrame,
    history: DataFrame,
    suppliers: DataFrame,
    companies: DataFrame,
    plants: DataFrame,
    groups: DataFrame,
    orgs: DataFrame,
    as_of: datetime | None = None,
    policy: SkewPolicy = SkewPolicy(),
    keyed: Keyed = KEYED,
    item_keys_from: DataFrame | None = None,
) -> DataFrame:
    """Order items by schedule line, with names and goods received.

    Each name is looked up at the grain that owns its code: header names on the
    headers, item names on the items, before either is multiplied by the join with
    the other. Deliveries are summed before they are joined, and the schedule, the
    one side that adds rows, comes last. ``item_keys_from`` has the items' columns and is cheaper
    to count than ``items``, such as the table before repeated records are dropped.
    """
    counts = KeyCounts()
    header, item = project(headers, ORDER_HEADER), project(items, ORDER_ITEM)
    item_keys = item if item_keys_from is None else project(item_keys_from, ORDER_ITEM)
    named, one_header = _looked_up(
        header,
        is_unique("ekko", ORDER_HEADER, ["purchase_order"], keyed),
        (
            ("lfa1", suppliers, SUPPLIER_NAME, "supplier_number"),
            ("t024", groups, GROUP_NAME, "purchasing_group"),
            ("t024e", orgs, ORG_NAME, "purchasing_org"),
        ),
        policy, keyed, counts, header,
    )
    placed, one_item = _looked_up(
        item,
        is_unique("ekpo", ORDER_ITEM, ITEM_KEYS, keyed),
        (("t001", companies, COMPANY_NAME, "company"), ("t001w", plants, PLANT_NAME, "plant")),
        policy, keyed, counts, item_keys,
    )
    lines = attach(
        placed, named, ["purchase_order"], "inner", policy,
        keys_from=item_keys, unique=one_header, right_keys_from=header, counts=counts,
    )
    one_line = one_header and one_item
    lines = attach(
        lines, delivered(history), ITEM_KEYS, policy=policy,
        keys_from=item_keys, left_unique=one_line, unique=True, counts=counts,
    )
    lines = attach(
        lines, project(schedule, SCHEDULE_LINE), ITEM_KEYS, policy=policy,
        keys_from=item_keys, left_unique=one_line, counts=counts,
    )
    received = {
        "delivered_qty": F.coalesce("delivered_qty", F.lit(0)).cast("decimal(15,3)"),
        "delivered_value": F.coalesce("delivered_value", F.lit(0)).cast("decimal(15,2)"),
    }
    ordered = lines.withColumns(received).select(PURCHASE_ORDER_COLUMNS)
    outstanding = F.col("scheduled_quantity") - F.col("goods_receipt_qty")
    derived = {
        "net_order_value": F.col("order_quantity") * F.col("net_price"),
        "outstanding_qty": outstanding,
        "po_status": F.when(outstanding > 0, "Open").otherwise("Closed"),
        "po_type_category": decode(F.col("po_type"), PO_TYPE_CATEGORIES, OTHER),
        "po_sub_type": decode(F.col("item_category"), PO_SUB_TYPES, OTHER),
    }
    return as_fact(ordered.withColumns(derived), as_of)


def demand_actual(demand: DataFrame, as_of: datetime | None = None) -> DataFrame:
    dated = project(demand, DEMAND_ACTUAL).withColumn("period_date", period_start(F.col("period")))
    return as_fact(dated, as_of)


def demand_forecast(demand: DataFrame, as_of: datetime | None = None) -> DataFrame:
    dated = project(demand, DEMAND_FORECAST).withColumn(
        "period_date", period_start(F.col("period"))
    )
    return as_fact(dated, as_of)


def is_external() -> Column:
    return F.col("inspection_type") == EXTERNAL_INSPECTION


def is_internal() -> Column:
    """A lot without a type is neither."""
    return F.col("inspection_type") != EXTERNAL_INSPECTION


def _decided(
    lots: DataFrame, decisions: DataFrame, as_of: datetime | None, policy: SkewPolicy, keyed: Keyed
) -> DataFrame:
    """Lots with their usage decisions. Neither table need have a key, so a lot may be there any number
    of times on either side."""
    key = ["inspection_lot"]
    decided = attach(
        lots, project(decisions, USAGE_DECISION), key, policy=policy,
        left_unique=is_unique("qals", INSPECTION_LOT, key, keyed),
        unique=is_unique("qave", USAGE_DECISION, key, keyed),
    )
    return as_fact(decided, as_of)


def batch_release(
    lots: DataFrame,
    decisions: DataFrame,
    as_of: datetime | None = None,
    policy: SkewPolicy = SkewPolicy(),
    keyed: Keyed = KEYED,
) -> DataFrame:
    """Inspection lots with a type and their usage decision, if any: the external and the internal
    batch release in one pass."""
    chosen = project(lots, INSPECTION_LOT).where(F.col("inspection_type").isNotNull())
    return _decided(chosen, decisions, as_of, policy, keyed)


def batch_release_external(
    lots: DataFrame,
    decisions: DataFrame,
    as_of: datetime | None = None,
    policy: SkewPolicy = SkewPolicy(),
    keyed: Keyed = KEYED,
) -> DataFrame:
    """Inspection lots of goods from outside with their usage decision, if any."""
    chosen = project(lots, INSPECTION_LOT).where(is_external())
    return _decided(chosen, decisions, as_of, policy, keyed)


def batch_release_internal(
    lots: DataFrame,
    decisions: DataFrame,
    as_of: datetime | None = None,
    policy: SkewPolicy = SkewPolicy(),
    keyed: Keyed = KEYED,
) -> DataFrame:
    """All other inspection lots; a lot without a type belongs to neither fact."""
    chosen = project(lots, INSPECTION_LOT).where(is_internal())
    return _decided(chosen, decisions, as_of, policy, keyed)


# Builders whose joins are told what the cleansing rules make unique.
TOLD_KEYS = (inventory, purchase_order, batch_release_external, batch_release_internal)
