"""The dimensions, each from cleansed tables. Builders are lazy and write nothing."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.functions.keys import single_key
from tristrata.operators.joins import attach
from tristrata.operators.projection import fields, project
from tristrata.operators.skew import KeyCounts, SkewPolicy
from tristrata.operators.stamps import stamp_validity
from tristrata.operators.star import as_dimension, calendar, distinct_values
from tristrata.plans.registry import KEYED, Keyed, is_unique

# Source column, published column, type ("-" leaves it as read).
MATERIAL = fields("""
MATNR  material_number     string
MTART  material_type       string
MATKL  material_group      string
MEINS  base_uom            string
VPSTA  complete_status     string
PSTAT  maintenance_status  string
MSTAE  xplant_status       string
ERSDA  created_date        date
LAEDA  last_change_date    date
""")
MATERIAL_TEXT = fields("""
MATNR  material_number       string
MAKTX  material_description  string
""")
BATCH = fields("""
MATNR  material_number   -
CHARG  batch_number      -
ERSDA  created_date      -
HSDAT  production_date   -
VFDAT  expiry_date       -
LAEDA  last_change_date  -
""")
PLANT = fields("""
WERKS  plant       -
NAME1  plant_name  -
ORT01  city        -
LAND1  country     -
REGIO  region      -
""")
STORAGE_LOCATION = fields("""
WERKS  plant                         -
LGORT  storage_location              -
LGOBE  storage_location_description  -
""")
SUPPLIER = fields("""
LIFNR  supplier_number  string
NAME1  supplier_name    string
LAND1  country          string
ORT01  city             string
PSTLZ  postal_code      string
STRAS  street           string
KTOKK  account_group    string
ERDAT  created_date     date
""")
SUPPLIER_ORG = fields("""
LIFNR  supplier_number  string
EKORG  purchasing_org   string
WAERS  order_currency   string
ZTERM  payment_terms    string
INCO1  incoterms        string
""")
SUPPLIER_COMPANY = fields("""
LIFNR  supplier_number  string
INTAD  email            string
""")
CUSTOMER = fields("""
Customer_ID              customer_id              -
Customer_Description     customer_description     -
Customer_Region          customer_region          -
Customer_Country_Region  customer_country_region  -
Demand_Type              demand_type              -
Demand_Sub_Type          demand_sub_type          -
Latitude                 latitude                 double
Longttitude              longitude                double
""")
CUSTOMER_PRODUCT = fields("""
CUSTOMER_ID           customer_id           -
PRODUCT_ID            product_id            -
MARKET_SEGMENT        market_segment        -
REMAINING_SHELF_LIFE  remaining_shelf_life  -
""")
LOCATION = fields("""
LOCATION_ID           location_id           -
LOCATION_DESCRIPTION  location_description  -
LOCATION_REGION       location_region       -
LOCATION_TYPE         location_type         -
LATITUDE              latitude              double
LONGTTITUDE           longitude             double
""")
LOCATION_PRODUCT = fields("""
Location_ID           location_id           -
Product_ID            product_id            -
Material_Description  product_description   -
Plant_Exclusion_X     plant_exclusion_flag  -
Market_DC_X           market_dc_flag        -
""")

# Output order where a join would change it, and the key columns.
PRODUCT_COLUMNS = (
    "material_number material_description material_type material_group base_uom "
    "complete_status maintenance_status xplant_status created_date last_change_date"
).split()
PRODUCT_TEXTS = (
    "material_description material_type material_group base_uom complete_status "
    "maintenance_status xplant_status"
).split()
STORAGE_COLUMNS = (
    "plant storage_location plant_name storage_location_description city country region"
).split()
SUPPLIER_COLUMNS = (
    "supplier_number purchasing_org supplier_name country city postal_code street "
    "order_currency payment_terms incoterms email account_group created_date"
).split()
TEXT_LANGUAGE = "E"
CALENDAR_START, CALENDAR_END = date(2020, 1, 1), date(2030, 12, 31)


def product(
    materials: DataFrame,
    texts: DataFrame,
    language: str = TEXT_LANGUAGE,
    as_of: datetime | None = None,
    policy: SkewPolicy = SkewPolicy(),
    keyed: Keyed = KEYED,
) -> DataFrame:
    """Materials with their description in one language; missing texts read ``""``."""
    spoken = project(texts.where(F.col("SPRAS") == language), MATERIAL_TEXT)
    described = attach(
        project(materials, MATERIAL), spoken, ["material_number"], policy=policy,
        left_unique=is_unique("mara", MATERIAL, ["material_number"], keyed),
        unique=is_unique("makt", MATERIAL_TEXT, ["material_number"], keyed, fixed=["SPRAS"]),
    )
    out = described.select(PRODUCT_COLUMNS).fillna("", subset=PRODUCT_TEXTS)
    return stamp_validity(out.withColumn("dim_product_key", single_key("material_number")), as_of)


def batch(batches: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return as_dimension(
        project(batches, BATCH), "dim_batch", ["material_number", "batch_number"], as_of
    )


def currency(*sources: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The distinct currencies of the given tables, such as supplier organisations
    and order headers."""
    codes = reduce(DataFrame.unionAll, [s.select("WAERS") for s in sources])
    return as_dimension(
        distinct_values(codes, "WAERS", "currency_code"), "dim_currency", ["currency_code"], as_of
    )


def dates(
    spark: SparkSession,
    start: date = CALENDAR_START,
    end: date = CALENDAR_END,
    as_of: datetime | None = None,
) -> DataFrame:
    return calendar(spark, start, end, as_of)


def storage(
    plants: DataFrame,
    locations: DataFrame,
    as_of: datetime | None = None,
    policy: SkewPolicy = SkewPolicy(),
    keyed: Keyed = KEYED,
) -> DataFrame:
    """Storage locations under their plant; a plant without any keeps one row."""
    placed = attach(
        project(plants, PLANT), project(locations, STORAGE_LOCATION), ["plant"], policy=policy,
        left_unique=is_unique("t001w", PLANT, ["plant"], keyed),
    )
    return as_dimension(
        placed.select(STORAGE_COLUMNS), "dim_storage", ["plant", "storage_location"], as_of
    )


def supplier(
    suppliers: DataFrame,
    supplier_orgs: DataFrame,
    supplier_companies: DataFrame,
    as_of: datetime | None = None,
    policy: SkewPolicy = SkewPolicy(),
    keyed: Keyed = KEYED,
) -> DataFrame:
    """Suppliers by purchasing organisation and company e-mail.

    Repeats are dropped on both sides before they are multiplied with each other,
    and once more at the end. The account group adds no column, so joining its
    table could only repeat rows that the distinct removes again.
    """
    orgs = project(supplier_orgs, SUPPLIER_ORG)
    emails = project(supplier_companies, SUPPLIER_COMPANY)
    base = project(suppliers, SUPPLIER)
    # Keys are counted before repeats are dropped: no distinct runs only to be counted.
    counts = KeyCounts()
    with_orgs = attach(
        base, orgs.distinct(), ["supplier_number"], policy=policy,
        left_unique=is_unique("lfa1", SUPPLIER, ["supplier_number"], keyed),
        right_keys_from=orgs, counts=counts,
    )
    full = attach(
        with_orgs, emails.distinct(), ["supplier_number"], policy=policy,
        keys_from=orgs, right_keys_from=emails, counts=counts,
    )
    return as_dimension(
        full.select(SUPPLIER_COLUMNS).distinct(),
        "dim_supplier",
        ["supplier_number", "purchasing_org"],
        as_of,
    )


def unit(materials: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The distinct base units; without a text table a unit describes itself."""
    codes = distinct_values(materials, "MEINS", "uom_code")
    return as_dimension(
        codes.withColumn("uom_description", F.col("uom_code")), "dim_uom", ["uom_code"], as_of
    )


def customer(customers: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return as_dimension(project(customers, CUSTOMER), "dim_customer", ["customer_id"], as_of)


def customer_product(pairs: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return as_dimension(
        project(pairs, CUSTOMER_PRODUCT),
        "dim_customer_product",
        ["customer_id", "product_id"],
        as_of,
    )


def location(locations: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return as_dimension(project(locations, LOCATION), "dim_location", ["location_id"], as_of)


def location_product(pairs: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return as_dimension(
        project(pairs, LOCATION_PRODUCT),
        "dim_location_product",
        ["location_id", "product_id"],
        as_of,
    )


# Builders whose joins are told what the cleansing rules make unique.
TOLD_KEYS = (product, storage, supplier)
