"""One query per operator group, each over whole test tables."""

from __future__ import annotations

import itertools
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.bindings import bind, bind_demand, demand_rows, read
from checks.scratch import shared_folder
from tristrata.functions import (
    blank_to_null,
    calendar_attributes,
    compact_date,
    decode,
    single_key,
    surrogate_key,
)
from tristrata.operators import (
    SkewPolicy,
    apply_mapping,
    as_dimension,
    attach,
    attach_key,
    blanks_to_null,
    check_table,
    clean_names,
    cleanse,
    columns_of_type,
    data_columns,
    fields,
    keep_latest,
    null_counts,
    parse_dates,
    preview,
    project,
    without_metadata,
)
from tristrata.plans import dimensions, facts
from tristrata.plans.bronze import ingest_all, raw_frame
from tristrata.plans.gold import DIMENSIONS, FACTS, build_gold
from tristrata.plans.load import check_raw
from tristrata.plans.outcomes import attempt, attempt_all, outcome_log, sorted_log, summarize_log
from tristrata.plans.registry import RULES, Rule
from tristrata.plans.reports import dimension_summary, fact_summary
from tristrata.plans.silver import refine_all, stock_buckets_for, stock_layouts
from tristrata.sources import (
    Layers,
    Layout,
    create_layers,
    drop_table,
    load_settings,
    mapping_sheet,
    read_csv,
    read_mapping_sheet,
    recorded,
    store,
    store_split,
    use_layer,
    write_table,
)

AS_OF = datetime(2024, 1, 1)
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def as_csv(spark: SparkSession, df: DataFrame, name: str, **options) -> str:
    """Write a frame as CSV, quotes doubled, and return the place."""
    place = shared_folder(spark, name)
    df.write.mode("overwrite").options(header=True, escape='"', **options).csv(place)
    return place


def coarse_keys(spark: SparkSession) -> None:
    """Let joins share one shuffle by the keys that they have in common, as a load does; for plans that run
    after their query has returned."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")


def untimed(df: DataFrame) -> DataFrame:
    return df.drop("created_timestamp", "updated_timestamp")


# Sources and raw layer


@query
def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """All columns under their own types."""
    orders = read(spark, folder, "orders").withColumns(
        {
            "o_orderpriority": F.nullif("o_orderpriority", F.lit("5-LOW")),
            "o_orderdate": F.to_date("o_orderdate"),
        }
    )
    return read_csv(spark, as_csv(spark, orders, "csv_scan"), schema=orders.schema)


@query
def csv_infer(spark: SparkSession, folder: str) -> DataFrame:
    """Types guessed from the text."""
    orders = read(spark, folder, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    return read_csv(spark, as_csv(spark, orders, "csv_infer"), infer=True)


@query
def csv_quotes(spark: SparkSession, folder: str) -> DataFrame:
    """Whole document texts, with quotes and line breaks, through CSV."""
    docs = read(spark, folder, "documents")
    quoted = docs.withColumn("text", F.concat(F.lit('5" pipe, "steel"\n'), "text", F.lit('\\"')))
    place = as_csv(spark, quoted, "csv_quotes")
    back = read_csv(spark, place, schema=quoted.schema, multi_line=True, bad_rows="bad")
    return back.select(
        "doc_id", F.md5("text").alias("digest"), "lang", "source", "n_chars",
        F.col("bad").isNotNull().alias("is_bad"),
    )


@query
def csv_header_only(spark: SparkSession, folder: str) -> DataFrame:
    """One ingest of a whole extract and one with a header alone: rows, counts and types of both."""
    name = "csv_header_only"
    customers = read(spark, folder, "customer")
    as_csv(spark, customers, f"{name}/SAP/FULL.csv")
    header = spark.createDataFrame([(",".join(customers.columns),)], "line string")
    place = shared_folder(spark, name)
    header.coalesce(1).write.mode("overwrite").text(f"{place}/SAP/EMPTY.csv")
    layers = _layers(spark, name)
    rules = [Rule("SAP", extract, extract.lower()) for extract in ("FULL", "EMPTY")]
    log = outcome_log(spark, ingest_all(spark, {"SAP": f"{place}/SAP"}, rules, layers))
    tables = [spark.table(f"{layers.bronze}.{r.raw_table}").select(*customers.columns) for r in rules]
    types = spark.createDataFrame(
        [(r.extract, ",".join(sorted({t for _, t in df.dtypes}))) for r, df in zip(rules, tables)],
        "table_name string, types string",
    )
    rows = reduce(
        DataFrame.union, [df.select(F.lit(r.extract).alias("table_name"), "*") for r, df in zip(rules, tables)]
    )
    counted = log.select("table_name", "record_count").join(types, "table_name")
    return counted.join(rows, "table_name", "left")


@query
def csv_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Read without a schema, codes keep their zeros."""
    parts = read(spark, folder, "part").withColumns(
        {
            "p_partkey": F.lpad(F.col("p_partkey").cast("string"), 10, "0"),
            "p_size": F.lpad(F.col("p_size").cast("string"), 2, "0"),
            "p_retailprice": F.col("p_retailprice").cast("decimal(15,2)"),
        }
    )
    return read_csv(spark, as_csv(spark, parts, "csv_codes"))


@query
def sanitize_columns(spark: SparkSession, folder: str) -> DataFrame:
    awkward = ["Cust (ID)", "Full  Name", "_Nation/Key_", "Acct;Bal", "Acct=Bal"]
    return clean_names(read(spark, folder, "customer").toDF(*awkward))


@query
def bronze_ingest(spark: SparkSession, folder: str) -> DataFrame:
    parts = read(spark, folder, "part").withColumnsRenamed(
        {"p_partkey": "Part Key", "p_name": "Part (Name)"}
    )
    parts = parts.withColumn("p_retailprice", F.col("p_retailprice").cast("decimal(15,2)"))
    place = as_csv(spark, parts, "bronze_ingest")
    raw = raw_frame(read_csv(spark, place), "PART.csv", "SAP", AS_OF)
    return raw.withColumn(
        "_ingestion_timestamp", F.date_format("_ingestion_timestamp", "yyyy-MM-dd HH:mm:ss")
    )


def _ingest(spark: SparkSession, folder: str, name: str) -> DataFrame:
    place = shared_folder(spark, name)
    present = {"SAP": ("orders", "customer", "part"), "IBP": ("supplier", "documents")}
    rules = []
    for system, tables in present.items():
        for table in tables:
            as_csv(spark, read(spark, folder, table), f"{name}/{system}/{table}.csv")
            rules.append(Rule(system, table, table, multi_line=table == "documents"))
        rules.append(Rule(system, "absent", "absent"))
    layers = _layers(spark, name)
    outcomes = ingest_all(spark, {s: f"{place}/{s}" for s in present}, rules, layers)
    return outcome_log(spark, outcomes)


def _layers(spark: SparkSession, name: str) -> Layers:
    layers = Layers(f"bronze_{name}", f"silver_{name}", f"gold_{name}")
    create_layers(spark, layers, shared_folder(spark, name))
    return layers


@query
def schema_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads of one extract, the second without one column, with another and in another order: the
    raw and the cleansed table keep the old columns, and have the new one behind them."""
    name = "schema_merge"
    orders = read(spark, folder, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(15,2)"))
    rule = Rule("SAP", "ORDERS", "orders", ("o_orderkey",))
    layers = _layers(spark, name)
    for frame in (
        orders.select("o_orderkey", "o_orderstatus", "o_totalprice"),
        orders.select("o_totalprice", "o_orderkey", "o_custkey"),
    ):
        as_csv(spark, frame, f"{name}/SAP/ORDERS.csv")
        ingest_all(spark, {"SAP": f"{shared_folder(spark, name)}/SAP"}, [rule], layers, merge_schema=True)
        refine_all(spark, [rule], layers, merge_schema=True)
    clean = spark.table(f"{layers.silver}.orders")
    columns = data_columns(clean)
    return clean.select(*columns, F.lit(" ".join(columns)).alias("in_order"))


@query
def profiled_load(spark: SparkSession, folder: str) -> DataFrame:
    """NULLs per column of a raw table, counted while it was written and read back without a scan."""
    (customers,) = bind(spark, folder, "padded_customers")
    as_csv(spark, customers.drop("_load"), "profiled_load/SAP/CUSTOMERS.csv")
    layers, rules = _layers(spark, "profiled_load"), [Rule("SAP", "CUSTOMERS", "customers")]
    folders = {"SAP": f"{shared_folder(spark, 'profiled_load')}/SAP"}
    ingest_all(spark, folders, rules, layers, profiled=[rules[0].raw_table])
    (check,) = check_raw(spark, [rules[0].raw_table], layers).values()
    return spark.createDataFrame(
        [(check.rows, check.columns, c, n) for c, n in check.nulls.items()],
        "row_count bigint, column_count bigint, column_name string, null_count bigint",
    )


@query
def ingest_summary(spark: SparkSession, folder: str) -> DataFrame:
    return summarize_log(_ingest(spark, folder, "ingest_summary"))


@query
def ingest_log_sorted(spark: SparkSession, folder: str) -> DataFrame:
    log = sorted_log(_ingest(spark, folder, "ingest_log_sorted"))
    return log.drop("timestamp", "error", "readable", "readable_rows", "null_counts")


@query
def layers_listed(spark: SparkSession, folder: str) -> DataFrame:
    """The layer databases with what was loaded into one of them, by unqualified name."""
    layers = _layers(spark, "layers_listed")
    found = [d for d in create_layers(spark, layers) if d.endswith("layers_listed")]
    write_table(read(spark, folder, "customer"), f"{layers.silver}.customer")
    use_layer(spark, layers.silver)
    try:
        rows = spark.table("customer").count()
    finally:
        use_layer(spark, "default")
    counts = [(d, rows if d == layers.silver else 0) for d in found]
    return spark.createDataFrame(counts, "layer string, record_count bigint")


# Cleansed layer


@query
def silver_trim_null(spark: SparkSession, folder: str) -> DataFrame:
    (customers,) = bind(spark, folder, "padded_customers")
    return blanks_to_null(without_metadata(customers))


@query
def blank_values(spark: SparkSession, folder: str) -> DataFrame:
    """Whole document texts through the single-column form."""
    docs = read(spark, folder, "documents")
    padded = F.concat(F.lit("  "), "text", F.lit(" "))
    return docs.select(
        "doc_id", F.md5(blank_to_null(padded)).alias("digest"),
        blank_to_null(F.lit("  ")).alias("nothing"),
    )


@query
def silver_dates(spark: SparkSession, folder: str) -> DataFrame:
    (orders,) = bind(spark, folder, "order_dates")
    return parse_dates(orders, ["ORDERED", "noted", "number", "real_date", "not_there"])


@query
def silver_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    lines = read(spark, folder, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    return keep_latest(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query
def silver_dedupe_first_column(spark: SparkSession, folder: str) -> DataFrame:
    """Default order: by the first column."""
    return keep_latest(read(spark, folder, "lineitem"), ["l_suppkey"])


@query
def silver_transform(spark: SparkSession, folder: str) -> DataFrame:
    (lines,) = bind(spark, folder, "raw_lines")
    clean = cleanse(lines, ["order_id", "line"], ["shipped"], ["shipped"], AS_OF)
    return clean.drop("_silver_load_timestamp")


@query
def silver_run(spark: SparkSession, folder: str) -> DataFrame:
    """Extract -> raw table -> cleansed table, through storage."""
    place = shared_folder(spark, "silver_run")
    (lines,) = bind(spark, folder, "raw_lines")
    as_csv(spark, lines.drop("_source_file"), "silver_run/SAP/LINES.csv")
    rules = [Rule("SAP", "LINES", "lines", ("order_id", "line"), ("shipped", "absent"))]
    layers = _layers(spark, "silver_run")
    ingest_all(spark, {"SAP": f"{place}/SAP"}, rules, layers)
    refine_all(spark, rules, layers, {"lines": ["shipped", "part", "supplier"]}, as_of=AS_OF)
    return spark.table(f"{layers.silver}.lines").drop("_silver_load_timestamp")


@query
def mapping_projection(spark: SparkSession, folder: str) -> DataFrame:
    sheet = mapping_sheet(
        spark,
        [
            ("events", "EVENT_ID", "lot", 1),
            ("events", "user_id", "market", 1),
            ("events", "event_type", "kind", 1),
            ("events", "props", "properties", 0),
            ("events", "Value", "sales_history", 1),
            ("other", "ts", "period", 1),
        ],
    )
    return apply_mapping(read(spark, folder, "events"), sheet, "events")


@query
def mapping_file(spark: SparkSession, folder: str) -> DataFrame:
    """A sheet read from a file whose columns stand in another order."""
    sheet = spark.createDataFrame(
        [("1", "orders", "Order", "o_orderkey", ""), ("1", "orders", "Value, total", "O_TotalPrice", "x"),
         ("0", "orders", "Clerk", "o_clerk", "left out"), ("no", "orders", "Also out", "o_custkey", "")],
        "`Include in Gold` string, source_table string, Business_Name string, `SOURCE COLUMN` string, note string",
    )
    place = as_csv(spark, sheet.coalesce(1), "mapping_file")
    return apply_mapping(read(spark, folder, "orders"), read_mapping_sheet(spark, place), "orders")


@query
def typed_staging(spark: SparkSession, folder: str) -> DataFrame:
    layout = fields("""
        l_orderkey       order_id  string
        l_linenumber     line      string
        l_quantity       quantity  decimal(15,3)
        l_extendedprice  price     decimal(15,2)
        l_tax            ratio     decimal(10,4)
        l_returnflag     flag      -
        l_linestatus     number    int
        text             amount    decimal(15,2)
    """)
    lines = read(spark, folder, "lineitem")
    part = F.col("l_partkey").cast("string")
    wide = F.translate(part, "0123456789", "０１２３４５６７８９")
    forms = [part, wide, F.concat(F.lit(" +"), part, F.lit("e2 ")), F.concat(F.lit("-."), part), F.concat(part, F.lit(",5")), F.lit(" ")]
    text = F.element_at(F.array(*forms), (F.col("l_linenumber") % len(forms) + 1).cast("int"))
    return project(lines.withColumn("text", text), layout)


@query
def columns_by_type(spark: SparkSession, folder: str) -> DataFrame:
    from pyspark.sql.types import DoubleType

    (lines,) = bind(spark, folder, "raw_lines")
    doubles = columns_of_type(lines, DoubleType)
    return lines.select("part", *doubles, F.lit(len(data_columns(lines))).alias("width"))


# Keys and dimensions


@query
def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    (lines,) = bind(spark, folder, "keyed_lines")
    return lines.withColumn("row_key", surrogate_key("order_id", "part", "line", "flag"))


@query
def single_keys(spark: SparkSession, folder: str) -> DataFrame:
    (lines,) = bind(spark, folder, "keyed_lines")
    return lines.select("order_id", "part", "supplier", single_key("flag").alias("flag_key"))


@query
def scd_columns(spark: SparkSession, folder: str) -> DataFrame:
    parts = read(spark, folder, "part").select("p_partkey", "p_name", "p_brand")
    out = as_dimension(parts, "part", ["p_partkey", "p_brand"], AS_OF)
    return out.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in out.columns if c.endswith("_timestamp")}
    )


@query
def code_labels(spark: SparkSession, folder: str) -> DataFrame:
    (items,) = bind(spark, folder, "ekpo_raw")
    return items.select(
        "EBELN", "MATNR", "WERKS", "PSTYP",
        decode(F.col("PSTYP"), facts.PO_SUB_TYPES, facts.OTHER).alias("sub_type"),
    )


@query
def calendar_of_events(spark: SparkSession, folder: str) -> DataFrame:
    attributes = calendar_attributes(F.to_date("ts"))
    return read(spark, folder, "events").select(
        "event_id", *[c.alias(n) for n, c in attributes.items()]
    )


@query
def date_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Events by user: numbers as dates, most of them impossible."""
    events = read(spark, folder, "events")
    number = F.col("user_id") * 100 + 20240000 + F.col("event_id") % 40
    return events.select(
        "event_id",
        compact_date(number, events.schema["event_id"].dataType).alias("day"),
    )


@query
def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    return untimed(dimensions.product(*bind(spark, folder, "mara", "makt"), as_of=AS_OF))


@query
def dim_batch(spark: SparkSession, folder: str) -> DataFrame:
    return untimed(dimensions.batch(*bind(spark, folder, "mch1"), as_of=AS_OF))


@query
def dim_currency(spark: SparkSession, folder: str) -> DataFrame:
    return untimed(dimensions.currency(*bind(spark, folder, "segments", "lfm1"), as_of=AS_OF))


@query
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    """A calendar over the days the orders span."""
    span = read(spark, folder, "orders").agg(
        F.min(F.to_date("o_orderdate")).alias("first"), F.max(F.to_date("o_orderdate")).alias("last")
    )
    first, last = span.first()
    return untimed(dimensions.dates(spark, first, last, AS_OF))


@query
def dim_storage(spark: SparkSession, folder: str) -> DataFrame:
    return untimed(dimensions.storage(*bind(spark, folder, "t001w", "t001l"), as_of=AS_OF))


@query
def dim_supplier(spark: SparkSession, folder: str) -> DataFrame:
    return untimed(dimensions.supplier(*bind(spark, folder, "lfa1", "lfm1", "lfb1"), as_of=AS_OF))


@query
def dim_uom(spark: SparkSession, folder: str) -> DataFrame:
    return untimed(dimensions.unit(*bind(spark, folder, "mara"), as_of=AS_OF))


@query
def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return untimed(dimensions.customer(*bind(spark, folder, "master_customer"), as_of=AS_OF))


@query
def dim_customer_product(spark: SparkSession, folder: str) -> DataFrame:
    pairs = bind(spark, folder, "master_customer_product")
    return untimed(dimensions.customer_product(*pairs, as_of=AS_OF))


@query
def dim_location(spark: SparkSession, folder: str) -> DataFrame:
    return untimed(dimensions.location(*bind(spark, folder, "master_location"), as_of=AS_OF))


@query
def dim_location_product(spark: SparkSession, folder: str) -> DataFrame:
    pairs = bind(spark, folder, "master_location_product")
    return untimed(dimensions.location_product(*pairs, as_of=AS_OF))


@query
def dim_key_lookup(spark: SparkSession, folder: str) -> DataFrame:
    supplier = dimensions.supplier(*bind(spark, folder, "lfa1", "lfm1", "lfb1"))
    (lines,) = bind(spark, folder, "keyed_lines")
    lines = lines.withColumn("supplier", F.col("supplier").cast("string"))
    keys = {"supplier": "supplier_number", "flag": "purchasing_org"}
    return attach_key(lines, supplier, "dim_supplier", keys)


# Facts


@query
def fact_inventory(spark: SparkSession, folder: str) -> DataFrame:
    coarse_keys(spark)
    return untimed(
        facts.inventory(*bind(spark, folder, "mchb", "mard", "mbew", "mslb"), as_of=AS_OF)
    )


@query
def fact_month_end(spark: SparkSession, folder: str) -> DataFrame:
    coarse_keys(spark)
    return untimed(facts.month_end_stock(*bind(spark, folder, "mchbh", "mardh", "mbewh")))


@query
def fact_monthly_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    coarse_keys(spark)
    month_end = facts.month_end_stock(*bind(spark, folder, "mchbh", "mardh", "mbewh"))
    return untimed(facts.monthly_snapshot(month_end))


@query
def delivered_qty(spark: SparkSession, folder: str) -> DataFrame:
    return facts.delivered(*bind(spark, folder, "ekbe"))


@query
def po_fact(spark: SparkSession, folder: str) -> DataFrame:
    coarse_keys(spark)
    headers, records, schedule, history, *names = bind(
        spark, folder, "ekko", "ekpo_raw", "eket", "ekbe", "vendors", "t001", "t001w", "t024", "t024e"
    )
    items = keep_latest(records, ["EBELN", "EBELP"], ["MATNR"])
    return untimed(facts.purchase_order(headers, items, schedule, history, *names, item_keys_from=records))


@query
def fact_demand_actual(spark: SparkSession, folder: str) -> DataFrame:
    return untimed(facts.demand_actual(*bind(spark, folder, "demand_actual")))


@query
def fact_demand_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return untimed(facts.demand_forecast(*bind(spark, folder, "demand_forecast")))


@query
def batch_external(spark: SparkSession, folder: str) -> DataFrame:
    return untimed(facts.batch_release_external(*bind(spark, folder, "qals", "qave")))


@query
def batch_internal(spark: SparkSession, folder: str) -> DataFrame:
    return untimed(facts.batch_release_internal(*bind(spark, folder, "qals", "qave")))


@query
def fact_stamps(spark: SparkSession, folder: str) -> DataFrame:
    """A fact with its load stamps."""
    out = facts.batch_release_external(*bind(spark, folder, "qals", "qave"), as_of=AS_OF)
    return out.select(
        "inspection_lot",
        *[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("created_timestamp", "updated_timestamp")],
    )


def _write_silver(spark: SparkSession, folder: str, layers: Layers) -> None:
    needed = " ".join(tables for _, tables in (DIMENSIONS | FACTS).values()).split()
    demand = ("demand_actual", "demand_forecast")
    names = sorted(set(needed) - {"ekpo", *demand})
    silver = {"demand_rows": demand_rows(spark, folder)}
    silver |= dict(zip(names, bind(spark, folder, *names)))
    silver["ekpo"] = keep_latest(*bind(spark, folder, "ekpo_raw"), ["EBELN", "EBELP"], ["MATNR"])
    shared = f"{layers.bronze}.demand_rows"
    loads = {
        (n, "silver"): lambda n=n, df=df: write_table(df, shared if n == "demand_rows" else f"{layers.silver}.{n}")
        for n, df in silver.items()
    }
    for n in demand:
        loads[n, "silver"] = lambda n=n: write_table(bind_demand(spark, n, spark.table(shared)), f"{layers.silver}.{n}")
    attempt_all(spark, loads, needs=dict.fromkeys(demand, ["demand_rows"]))
    drop_table(spark, shared)


@query
def gold_run(spark: SparkSession, folder: str) -> DataFrame:
    """All dimensions and facts through storage: rows per table, and a sum over what was written."""
    layers = _layers(spark, "gold_run")
    _write_silver(spark, folder, layers)
    split = {"fact_inventory_month_end_stock": ["fiscal_year"]}
    log = outcome_log(spark, build_gold(spark, layers, as_of=AS_OF, partitions=split))
    sums = _letters(spark, layers)
    return log.select("table_name", "status", "record_count").join(reduce(DataFrame.union, sums), "table_name")


def _letters(spark: SparkSession, layers: Layers) -> list[DataFrame]:
    """Of each gold table a sum over what was written."""
    return [
        spark.table(f"{layers.gold}.{name}").select(
            F.lit(name).alias("table_name"), F.sum(F.length(column)).cast("bigint").alias("key_letters")
        )
        for name, column in GOLD_KEYS.items()
    ]


# A text column of each table.
GOLD_KEYS = {
    "dim_product": "material_number", "dim_batch": "batch_number", "dim_currency": "currency_code",
    "dim_date": "month_name", "dim_storage": "plant", "dim_supplier": "supplier_number",
    "dim_uom": "uom_code", "dim_customer": "customer_id", "dim_customer_product": "product_id",
    "dim_location": "location_id", "dim_location_product": "product_id",
    "fact_inventory": "batch_number", "fact_inventory_month_end_stock": "batch_number",
    "fact_inventory_monthly_snapshot": "material_number", "fact_purchase_order": "short_text",
    "fact_demand_actual": "product_id", "fact_demand_forecast": "product_id",
    "fact_batch_release_external": "inspection_lot", "fact_batch_release_internal": "inspection_lot",
}


@query
def gold_run_failed(spark: SparkSession, folder: str) -> DataFrame:
    """A second run over old tables, with one cleansed table not renewed and one gone: what reads
    them is FAILED though old tables are there."""
    layers = _layers(spark, "gold_run_failed")
    _write_silver(spark, folder, layers)
    build_gold(spark, layers, as_of=AS_OF)
    spark.sql(f"DROP TABLE {layers.silver}.mardh")
    log = outcome_log(spark, build_gold(spark, layers, as_of=AS_OF, failed=["mara"]))
    return log.select("table_name", "status", "record_count")


@query
def gold_write_failed(spark: SparkSession, folder: str) -> DataFrame:
    """A second run in which one fact fails while it is written: it is FAILED, and what can be read
    under its name are all rows of the first run."""
    layers = _layers(spark, "gold_write_failed")
    _write_silver(spark, folder, layers)
    build_gold(spark, layers, as_of=AS_OF)
    lines = f"{layers.silver}.eket"
    spark.sql(f"ALTER TABLE {lines} RENAME TO {lines}_whole")
    spark.sql(
        f"""CREATE VIEW {lines} AS SELECT EBELN, EBELP, ETENR, EINDT, MENGE, CASE WHEN EBELP = '3'
        THEN CAST(raise_error('a broken row') AS DOUBLE) ELSE WEMNG END AS WEMNG FROM {lines}_whole"""
    )
    try:
        log = outcome_log(spark, build_gold(spark, layers, as_of=AS_OF))
    finally:
        spark.sql(f"DROP VIEW {lines}")
        spark.sql(f"ALTER TABLE {lines}_whole RENAME TO {lines}")
    found = log.select("table_name", "status", "record_count", "readable", "readable_rows")
    return found.join(reduce(DataFrame.union, _letters(spark, layers)), "table_name")


@query
def overwrite_failed(spark: SparkSession, folder: str) -> DataFrame:
    """A load that fails half-way leaves rows, schema and partitions; a rerun then replaces all three."""
    layers = _layers(spark, "overwrite_failed")
    table = f"{layers.gold}.orders"
    orders = read(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    store(orders, table, Layout(["o_orderstatus"]))
    broken = F.raise_error(F.lit("a broken row")).cast("double")
    late = orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 100 == 99, broken).otherwise(F.col("o_totalprice")).alias("value")
    )
    for step, frame in (("kept", late), ("renewed", orders.drop("o_orderstatus"))):
        outcome = attempt(table, "GOLD", lambda df=frame: store(df, table), spark, table)
        now = spark.table(table)
        folders = spark.sql(f"SHOW PARTITIONS {table}").count() if "o_orderstatus" in now.columns else 0
        found = now.select(
            F.lit(step).alias("step"), F.lit(outcome.status).alias("status"),
            F.lit(outcome.readable).alias("readable"),
            F.lit(outcome.readable_rows).cast("bigint").alias("readable_rows"),
            F.lit(folders).alias("partitions"), *now.columns,
        )
        store(found, f"{layers.silver}.{step}")
    steps = [spark.table(f"{layers.silver}.{step}") for step in ("kept", "renewed")]
    return steps[0].unionByName(steps[1], allowMissingColumns=True)


@query
def stock_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """Current stock from cleansed tables in buckets by material and plant, without a shuffle."""
    layers = _layers(spark, "stock_buckets")
    names = ("mchb", "mard", "mbew", "mslb")
    stock = dict(zip(names, bind(spark, folder, *names)))
    with load_settings(spark):
        # The tables by batch are mostly the largest; if another turns out to be, all are dealt again.
        most, buckets = max(stock[n].count() for n in ("mchb", "mslb")), 0
        while buckets < stock_buckets_for(most):
            buckets = stock_buckets_for(most)
            layouts = stock_layouts(buckets)
            most = max(store(df, f"{layers.silver}.{n}", layouts[n]).rows for n, df in stock.items())
        tables = [spark.table(f"{layers.silver}.{n}") for n in names]
        store(facts.inventory(*tables, as_of=AS_OF), f"{layers.gold}.fact_inventory")
    return untimed(spark.table(f"{layers.gold}.fact_inventory"))


@query
def batch_spread(spark: SparkSession, folder: str) -> DataFrame:
    """Both batch releases from one pass over the lots, a third of which have one number."""
    lots, decisions = bind(spark, folder, "hot_qals", "hot_qave")
    released = facts.batch_release(lots, decisions, AS_OF, _spread(lots.count()))
    layers = _layers(spark, "batch_spread")
    tables = {"external": facts.is_external(), "internal": facts.is_internal()}
    store_split(released, {f"{layers.gold}.{t}": c for t, c in tables.items()})
    return reduce(
        DataFrame.union,
        [untimed(spark.table(f"{layers.gold}.{t}")).withColumn("release", F.lit(t)) for t in tables],
    )


@query
def registry_run(spark: SparkSession, folder: str) -> DataFrame:
    """All extracts of the registry through the raw and the cleansed layer."""
    place = shared_folder(spark, "registry_run")
    layers = _layers(spark, "registry_run")
    sources = itertools.cycle(("customer", "part", "supplier", "orders"))
    for rule, table in zip(RULES, sources):
        names = [*rule.keys, *rule.dates]
        df = read(spark, folder, "lineitem" if len(names) > 6 else table)
        # The first columns take the names that the rule looks for.
        df = df.withColumnsRenamed(dict(zip(df.columns, names)))
        # 43 extracts lie there at once: packed, in files that are not split but small enough for a task.
        packed = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}
        as_csv(spark, df, f"registry_run/{rule.system}/{rule.extract}.csv", **packed)
    raw = ingest_all(spark, {s: f"{place}/{s}" for s in ("SAP", "IBP")}, RULES, layers)
    clean = refine_all(spark, RULES, layers, as_of=AS_OF)
    both = outcome_log(spark, raw).withColumn("layer", F.lit("raw")).union(
        outcome_log(spark, clean).withColumn("layer", F.lit("clean"))
    )
    return both.select("layer", "table_name", "source_system", "status", "record_count")


def _spread(rows: int) -> SkewPolicy:
    """Spread every key that holds more than a 256th of the rows."""
    return SkewPolicy(broadcast_bytes=0, rows_per_task=max(20, rows // 256))


@query
def lookup_spread(spark: SparkSession, folder: str) -> DataFrame:
    """Supplier names on order lines, frequent suppliers spread over tasks."""
    lines = read(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("supplier"), "l_orderkey", "l_partkey", "l_linenumber"
    )
    names = read(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("supplier"), F.col("s_name").alias("supplier_name")
    )
    return attach(lines, names, ["supplier"], policy=_spread(lines.count()))


@query
def schedule_spread(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines under their supplier and status, frequent pairs spread over tasks;
    pairs without lines stay."""
    lines = read(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("supplier"), F.col("l_linestatus").alias("status"),
        "l_orderkey", "l_partkey", "l_quantity",
    )
    suppliers = read(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("supplier"), "s_name", F.explode(F.array(F.lit("O"), F.lit("X"))).alias("status")
    )
    return attach(suppliers, lines, ["supplier", "status"], policy=_spread(lines.count()))


@query
def lookup_many_keys(spark: SparkSession, folder: str) -> DataFrame:
    """A few frequent suppliers among as many keys as there are lines, found by small sketches."""
    lines = read(spark, folder, "lineitem").select(
        F.when(F.col("l_suppkey") < 4, F.negate("l_suppkey")).otherwise(F.col("l_orderkey") * 8 + F.col("l_linenumber"))
        .cast("bigint").alias("line_key"),
        "l_quantity",
    )
    names = read(spark, folder, "supplier").select(
        F.negate("s_suppkey").cast("bigint").alias("line_key"), F.col("s_name").alias("supplier_name")
    )
    rows = max(20, lines.count() // 256)
    policy = SkewPolicy(broadcast_bytes=0, rows_per_task=rows, buckets=2, tracked=64, listed=1)
    return attach(lines, names, ["line_key"], policy=policy)


@query
def lookup_absent_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers with their lines, where keys that the counted frame has often are not in the joined one."""
    lines = read(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("supplier"), "l_orderkey", "l_linenumber"
    )
    others = lines.withColumn(
        "supplier", F.when(F.col("supplier") < 4, -1 - F.col("supplier")).otherwise(F.col("supplier")).cast("bigint")
    )
    suppliers = read(spark, folder, "supplier").select(F.col("s_suppkey").alias("supplier"), "s_name")
    return attach(suppliers, others, ["supplier"], policy=_spread(lines.count()), right_keys_from=lines)


# Reports


@query
def null_profile_wide(spark: SparkSession, folder: str) -> DataFrame:
    (lines,) = bind(spark, folder, "raw_lines")
    return null_counts(cleanse(lines, ["order_id", "line"], ["shipped"], ["shipped"], AS_OF))


@query
def null_profile_first5(spark: SparkSession, folder: str) -> DataFrame:
    (lines,) = bind(spark, folder, "raw_lines")
    clean = cleanse(lines, ["order_id", "line"], ["shipped"], ["shipped"], AS_OF)
    return null_counts(clean, first=5, suffix="_nulls")


@query
def bronze_check(spark: SparkSession, folder: str) -> DataFrame:
    (customers,) = bind(spark, folder, "padded_customers")
    check = check_table(customers)
    return spark.createDataFrame(
        [(check.rows, check.columns, c, n) for c, n in check.nulls.items()],
        "row_count bigint, column_count bigint, column_name string, null_count bigint",
    )


@query
def bronze_preview(spark: SparkSession, folder: str) -> DataFrame:
    """The sample of a check: five records."""
    (lines,) = bind(spark, folder, "raw_lines")
    return preview(lines, 5, ["quantity", "order_id", "line", "part", "supplier"])


@query
def dim_summary(spark: SparkSession, folder: str) -> DataFrame:
    built = {
        "dim_product": lambda: dim_product(spark, folder),
        "dim_uom": lambda: dim_uom(spark, folder),
        "dim_storage": lambda: dim_storage(spark, folder),
        "dim_absent": lambda: read(spark, folder, "absent"),
    }
    return dimension_summary(spark, built).withColumn("status", F.split("status", ":")[0])


@query
def facts_summary(spark: SparkSession, folder: str) -> DataFrame:
    built = {
        "fact_inventory": lambda: fact_inventory(spark, folder),
        "fact_purchase_order": lambda: po_fact(spark, folder),
        "fact_absent": lambda: read(spark, folder, "absent"),
    }
    return fact_summary(spark, built).withColumn("status", F.split("status", ":")[0])


@query
def written_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The same of stored facts, by the rows that were counted at the write."""
    layers = _layers(spark, "written_summary")
    built = {"fact_inventory": fact_inventory, "fact_purchase_order": po_fact}
    with load_settings(spark):
        for name, build in built.items():
            store(build(spark, folder), f"{layers.gold}.{name}")
    sources = {n: lambda n=n: spark.table(f"{layers.gold}.{n}") for n in (*built, "fact_absent")}
    known = fact_summary(spark, sources, lambda n: recorded(spark, f"{layers.gold}.{n}").rows)
    return known.withColumn("status", F.split("status", ":")[0])
