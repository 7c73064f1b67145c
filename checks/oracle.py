"""The registered queries as SQL for DuckDB."""

from __future__ import annotations

import itertools

from checks.bindings import ctes
from tristrata.plans.registry import RULES

VALIDITY = """DATE '2024-01-01' AS effective_date, CAST(NULL AS DATE) AS end_date,
    TRUE AS is_current"""


def key(*names: str) -> str:
    parts = ", ".join(f"coalesce(CAST({n} AS VARCHAR), 'NULL')" for n in names)
    return f"md5(concat_ws('||', {parts}))"


def date8(text: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({text}, '[0-9]{{8}}') "
        f"THEN CAST(try_strptime({text}, '%Y%m%d') AS DATE) END"
    )


def latest(source: str, keys: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {keys} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"
    )


def down(names: str) -> str:
    return ", ".join(f"{n} DESC NULLS LAST" for n in names.split())


def dec(expression: str, precision: int, scale: int) -> str:
    return f"CAST({expression} AS DECIMAL({precision},{scale}))"


def calendar(day: str) -> str:
    fiscal = f"CAST({day} - INTERVAL 3 MONTH AS DATE)"
    return f"""CAST(strftime({day}, '%Y%m%d') AS BIGINT) AS date_key,
    {day} AS full_date,
    CAST(year({day}) AS BIGINT) AS year,
    'Q' || quarter({day}) AS quarter,
    CAST(month({day}) AS BIGINT) AS month,
    strftime({day}, '%B') AS month_name,
    CAST(weekofyear({day}) AS BIGINT) AS week,
    CAST(day({day}) AS BIGINT) AS day,
    CAST(isodow({day}) AS BIGINT) AS day_of_week,
    strftime({day}, '%A') AS day_name,
    isodow({day}) >= 6 AS is_weekend,
    CAST(CASE WHEN month({day}) >= 4 THEN year({day}) ELSE year({day}) - 1 END AS BIGINT)
        AS fiscal_year,
    'Q' || quarter({fiscal}) AS fiscal_quarter,
    CAST((month({day}) + 8) % 12 + 1 AS BIGINT) AS fiscal_period,
    strftime({day}, '%Y-%m') AS year_month,
    year({day}) || '-Q' || quarter({day}) AS year_quarter"""


CLEAN_LINES = f"""{ctes("raw_lines")},
trimmed AS (
    SELECT nullif(trim(order_id), '') AS order_id, line, nullif(trim(flag), '') AS flag,
           nullif(trim(status), '') AS status, {date8("trim(shipped)")} AS shipped,
           part, supplier, quantity
    FROM raw_lines),
clean AS (
    {latest("trimmed", "order_id, line", down("shipped flag status part supplier quantity"))})"""

STAGED = {
    "u": "CAST(CLABS AS DECIMAL(15,3))",
    "t": "CAST(CUMLM AS DECIMAL(15,3))",
    "q": "CAST(CINSM AS DECIMAL(15,3))",
    "k": "CAST(CSPEM AS DECIMAL(15,3))",
}
STOCK = """{u} AS unrestricted_stock_qty, {t} AS stock_in_transit_qty,
    {q} AS quality_inspection_qty, {k} AS blocked_stock_qty""".format(**STAGED)
TOTAL = "({u} + {q} + {k})".format(**STAGED)
TOTALS = f"""{dec(TOTAL, 17, 3)} AS total_stock_qty,
    {dec(dec(TOTAL, 17, 3) + " * CAST(VERPR AS DECIMAL(15,2))", 33, 5)} AS total_stock_value"""

INVENTORY = f"""{ctes("mchb", "mard", "mbew", "mslb")}
SELECT b.MATNR AS material_number, b.WERKS AS plant, b.LGORT AS storage_location,
    b.CHARG AS batch_number, {STOCK},
    {dec("d.LABST", 15, 3)} AS valuated_unrestricted_qty,
    {dec("d.INSME", 15, 3)} AS valuated_quality_insp_qty,
    {dec("d.SPEME", 15, 3)} AS valuated_blocked_qty,
    {dec("v.VERPR", 15, 2)} AS moving_average_price, {dec("v.STPRS", 15, 2)} AS standard_price,
    {dec("v.PEINH", 15, 3)} AS price_unit, v.BWTAR AS valuation_type, v.BKLAS AS valuation_class,
    {dec("s.LBLAB", 15, 3)} AS special_stock_qty, DATE '2024-01-01' AS snapshot_date,
    {TOTALS}
FROM mchb b
LEFT JOIN mard d ON b.MATNR = d.MATNR AND b.WERKS = d.WERKS AND b.LGORT = d.LGORT
LEFT JOIN mbew v ON b.MATNR = v.MATNR AND b.WERKS = v.BWKEY
LEFT JOIN mslb s ON b.MATNR = s.MATNR AND b.WERKS = s.WERKS AND b.CHARG = s.CHARG"""

MONTH_END = f"""SELECT b.MATNR AS material_number, b.WERKS AS plant,
    b.LGORT AS storage_location, b.CHARG AS batch_number,
    CAST(b.LFGJA AS INTEGER) AS fiscal_year, CAST(b.LFMON AS INTEGER) AS fiscal_period, {STOCK},
    {dec("d.LABST", 15, 3)} AS valuated_unrestricted_qty,
    {dec("v.VERPR", 15, 2)} AS moving_average_price, {dec("v.STPRS", 15, 2)} AS standard_price,
    last_day(CAST(try_strptime(b.LFGJA || lpad(CAST(b.LFMON AS VARCHAR), 2, '0') || '01',
        '%Y%m%d') AS DATE)) AS month_end_date,
    {TOTALS}
FROM mchbh b
LEFT JOIN mardh d ON b.MATNR = d.MATNR AND b.WERKS = d.WERKS AND b.LGORT = d.LGORT
    AND b.LFGJA = d.LFGJA AND b.LFMON = d.LFMON
LEFT JOIN mbewh v ON b.MATNR = v.MATNR AND b.WERKS = v.BWKEY
    AND b.LFGJA = v.LFGJA AND b.LFMON = v.LFMON"""

DELIVERED = """SELECT EBELN AS purchase_order, EBELP AS po_item,
    CAST(sum(CAST(MENGE AS DECIMAL(15,3))) AS DECIMAL(25,3)) AS delivered_qty,
    CAST(sum(CAST(DMBTR AS DECIMAL(15,2))) AS DECIMAL(25,2)) AS delivered_value
FROM ekbe WHERE VGABE = '1' GROUP BY EBELN, EBELP"""

ORDERED = "CAST(i.MENGE AS DECIMAL(15,3))"
PRICE = "CAST(i.NETPR AS DECIMAL(15,2))"
OPEN_QTY = "(CAST(s.MENGE AS DECIMAL(15,3)) - CAST(s.WEMNG AS DECIMAL(15,3)))"
PURCHASE = f"""{ctes("ekko", "ekpo_raw", "eket", "ekbe", "vendors", "t001", "t001w", "t024", "t024e")},
ekpo AS ({latest("ekpo_raw", "EBELN, EBELP",
    down("MATNR BUKRS WERKS LGORT MATKL TXZ01 MEINS PSTYP MENGE NETPR"))}),
received AS ({DELIVERED})
SELECT h.EBELN AS purchase_order, i.EBELP AS po_item, s.ETENR AS schedule_line,
    h.LIFNR AS supplier_number, i.MATNR AS material_number, i.WERKS AS plant,
    i.LGORT AS storage_location, h.BSART AS po_type, h.BEDAT AS po_date, h.ERNAM AS created_by,
    h.AEDAT AS created_on, h.EKORG AS purchasing_org, o.EKOTX AS purchasing_org_name,
    h.EKGRP AS purchasing_group, g.EKNAM AS purchasing_group_name, h.WAERS AS currency,
    h.STATU AS order_status, i.TXZ01 AS short_text, i.MATKL AS material_group,
    i.MEINS AS order_unit, {ORDERED} AS order_quantity, {PRICE} AS net_price,
    i.PSTYP AS item_category, s.EINDT AS delivery_date,
    {dec("s.MENGE", 15, 3)} AS scheduled_quantity, {dec("s.WEMNG", 15, 3)} AS goods_receipt_qty,
    {dec("coalesce(r.delivered_qty, 0)", 15, 3)} AS delivered_qty,
    {dec("coalesce(r.delivered_value, 0)", 15, 2)} AS delivered_value,
    v.NAME1 AS supplier_name, p.NAME1 AS plant_name, c.BUTXT AS company_name,
    {dec(f"{ORDERED} * {PRICE}", 31, 5)} AS net_order_value,
    {dec(OPEN_QTY, 16, 3)} AS outstanding_qty,
    CASE WHEN {OPEN_QTY} > 0 THEN 'Open' ELSE 'Closed' END AS po_status,
    CASE h.BSART WHEN 'NB' THEN 'Direct' WHEN 'ZARB' THEN 'Indirect' WHEN 'UB' THEN 'STO'
        ELSE 'Other' END AS po_type_category,
    CASE WHEN i.PSTYP = 'L' THEN 'Subcontract' WHEN i.PSTYP IS NULL THEN 'Turn Key'
        ELSE 'Other' END AS po_sub_type
FROM ekko h
JOIN ekpo i ON h.EBELN = i.EBELN
LEFT JOIN eket s ON i.EBELN = s.EBELN AND i.EBELP = s.EBELP
LEFT JOIN received r ON i.EBELN = r.purchase_order AND i.EBELP = r.po_item
LEFT JOIN vendors v ON h.LIFNR = v.LIFNR
LEFT JOIN t001 c ON i.BUKRS = c.BUKRS
LEFT JOIN t001w p ON i.WERKS = p.WERKS
LEFT JOIN t024 g ON h.EKGRP = g.EKGRP
LEFT JOIN t024e o ON h.EKORG = o.EKORG"""

PERIOD_DATE = "CAST(try_strptime(period || '01', '%Y%m%d') AS DATE) AS period_date"
ACTUALS = "actual_qty:3 actual_revenue:2 shipped_qty:3 delivered_qty:3 net_actual_qty:3 net_revenue:2"
FORECASTS = (
    "consensus_demand:3 ibp_consensus_forecast:3 ibp_forecast:3 budget_volumes:3 "
    "sc_forecast_override:3 statistical_forecast:3 "
    + " ".join(f"fcst_snapshot_{i}:3" for i in range(1, 13))
    + " fcst_variance_snapshot_2:3 fcst_variance_snapshot_3:3 fcst_variance_perc_snapshot_2:2 "
    "fcst_variance_perc_snapshot_3:2 ibp_consensus_forecast_prior:3"
)


def measures(names: str) -> str:
    pairs = (n.split(":") for n in names.split())
    return ", ".join(f"{dec(n, 15, int(s))} AS {n}" for n, s in pairs)


DEMAND_KEYS = "market AS customer_id, material AS product_id, period_id, period"

PRODUCT = f"""SELECT m.MATNR AS material_number, coalesce(t.MAKTX, '') AS material_description,
    coalesce(MTART, '') AS material_type, coalesce(MATKL, '') AS material_group,
    coalesce(MEINS, '') AS base_uom, coalesce(VPSTA, '') AS complete_status,
    coalesce(PSTAT, '') AS maintenance_status, coalesce(MSTAE, '') AS xplant_status,
    ERSDA AS created_date, LAEDA AS last_change_date, md5(m.MATNR) AS dim_product_key, {VALIDITY}
FROM mara m LEFT JOIN (SELECT * FROM makt WHERE SPRAS = 'E') t ON m.MATNR = t.MATNR"""

UNIT = f"""SELECT DISTINCT MEINS AS uom_code, MEINS AS uom_description,
    {key("MEINS")} AS dim_uom_key, {VALIDITY} FROM mara WHERE MEINS IS NOT NULL"""

STORAGE = f"""SELECT w.WERKS AS plant, l.LGORT AS storage_location, w.NAME1 AS plant_name,
    l.LGOBE AS storage_location_description, w.ORT01 AS city, w.LAND1 AS country,
    w.REGIO AS region, {key("w.WERKS", "l.LGORT")} AS dim_storage_key, {VALIDITY}
FROM t001w w LEFT JOIN t001l l ON w.WERKS = l.WERKS"""

SUPPLIER = f"""SELECT DISTINCT a.LIFNR AS supplier_number, m.EKORG AS purchasing_org,
    a.NAME1 AS supplier_name, a.LAND1 AS country, a.ORT01 AS city, a.PSTLZ AS postal_code,
    a.STRAS AS street, m.WAERS AS order_currency, m.ZTERM AS payment_terms,
    m.INCO1 AS incoterms, b.INTAD AS email, a.KTOKK AS account_group, a.ERDAT AS created_date,
    {key("a.LIFNR", "m.EKORG")} AS dim_supplier_key, {VALIDITY}
FROM lfa1 a
LEFT JOIN (SELECT DISTINCT * FROM lfm1) m ON a.LIFNR = m.LIFNR
LEFT JOIN (SELECT DISTINCT LIFNR, INTAD FROM lfb1) b ON a.LIFNR = b.LIFNR"""


def release(test: str, lots: str = "qals", decisions: str = "qave") -> str:
    return f"""{ctes(lots, decisions)}
SELECT q.PRUEFLOS AS inspection_lot, MATNR AS material_number, WERK AS plant,
    LIFNR AS supplier_number, EBELN AS purchase_order, EBELP AS po_item, ART AS inspection_type,
    ENSTEHDAT AS inspection_start_date, BUDAT AS posting_date, {dec("LOSMENGE", 15, 3)} AS lot_size,
    {dec("GESSTICHPR", 15, 3)} AS sample_size, VBEWERTUNG AS usage_decision,
    DBEWERTUNG AS defect_assessment, VFOLGEAKTI AS follow_up_action, VDATUM AS decision_date,
    {dec("VAUSWAHLMG", 15, 3)} AS selected_qty
FROM {lots} q LEFT JOIN {decisions} a ON q.PRUEFLOS = a.PRUEFLOS WHERE {test}"""


INGESTED = [
    ("orders", "SAP"), ("customer", "SAP"), ("part", "SAP"), ("supplier", "IBP"),
    ("documents", "IBP"),
]
INGEST_LOG = " UNION ALL ".join(
    [
        f"SELECT '{t}' AS table_name, '{s}' AS source_system, 'SUCCESS' AS status, "
        f"count(*) AS record_count, CAST(0 AS BIGINT) AS bad_records FROM {t}"
        for t, s in INGESTED
    ]
    + [f"SELECT 'absent', '{s}', 'FAILED', 0, 0" for s in ("SAP", "IBP")]
)


def counted(names: str, suffix: str = "") -> str:
    return ", ".join(f"count(*) - count({n}) AS {n}{suffix}" for n in names.split())


def summary(kind: str, rows: list[tuple[str, str, int, int | None]]) -> str:
    """Rows of (name, SELECT, columns, measures), and one table that cannot be read."""
    parts = []
    for name, sql, width, numeric in rows:
        extra = "" if numeric is None else f", CAST({numeric} AS BIGINT) AS measure_count"
        parts.append(
            f"SELECT '{name}' AS {kind}, (SELECT count(*) FROM ({sql}) x) AS record_count, "
            f"CAST({width} AS BIGINT) AS column_count{extra}, 'SUCCESS' AS status"
        )
    extra = "" if rows[0][3] is None else ", 0"
    prefix = "dim" if kind == "dimension" else "fact"
    parts.append(f"SELECT '{prefix}_absent', 0, 0{extra}, 'FAILED'")
    return " UNION ALL ".join(parts)


ORACLE: dict[str, str] = {
    "csv_scan": """SELECT * REPLACE (nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
        CAST(o_orderdate AS DATE) AS o_orderdate) FROM orders""",
    "csv_infer": """SELECT * REPLACE (CAST(o_orderkey AS INTEGER) AS o_orderkey,
        CAST(o_custkey AS INTEGER) AS o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate)
        FROM orders""",
    "csv_quotes": """SELECT doc_id, md5('5" pipe, "steel"' || chr(10) || text || chr(92) || '"') AS digest,
        lang, source, n_chars, FALSE AS is_bad FROM documents""",
    "csv_header_only": """SELECT 'FULL' AS table_name, (SELECT count(*) FROM customer) AS record_count,
        'string' AS types, CAST(COLUMNS(*) AS VARCHAR) FROM customer
        UNION ALL BY NAME SELECT 'EMPTY' AS table_name, 0 AS record_count, 'string' AS types""",
    "schema_merge": f"""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(NULL AS VARCHAR) AS o_orderstatus,
        CAST({dec("o_totalprice", 15, 2)} AS VARCHAR) AS o_totalprice, CAST(o_custkey AS VARCHAR) AS o_custkey,
        'o_orderkey o_orderstatus o_totalprice o_custkey' AS in_order FROM orders""",
    "profiled_load": " UNION ALL ".join(
        f"SELECT count(*) AS row_count, CAST(8 AS BIGINT) AS column_count, '{c}' AS column_name, "
        f"count(*) - count({e}) AS null_count FROM ({ctes('padded_customers')} SELECT * FROM padded_customers)"
        for c, e in (("id", "id"), ("name", "name"), ("segment", "nullif(trim(segment), '')"), ("nation", "nullif(nation, '')"))
    ),
    "overwrite_failed": """SELECT 'kept' AS step, 'FAILED' AS status, 'OLD' AS readable,
        (SELECT count(*) FROM orders) AS readable_rows,
        CAST((SELECT count(DISTINCT o_orderstatus) FROM orders) AS INTEGER) AS partitions,
        o_orderkey, o_orderstatus, o_totalprice FROM orders
        UNION ALL SELECT 'renewed', 'SUCCESS', 'NEW', (SELECT count(*) FROM orders), 0,
        o_orderkey, NULL, o_totalprice FROM orders""",
    "stock_buckets": INVENTORY,
    "batch_spread": " UNION ALL ".join(
        f"SELECT *, '{name}' AS release FROM ({release(test, 'hot_qals', 'hot_qave')})"
        for name, test in (("external", "ART = '04'"), ("internal", "ART <> '04'"))
    ),
    "lookup_many_keys": """SELECT CAST(CASE WHEN l_suppkey < 4 THEN -l_suppkey
        ELSE l_orderkey * 8 + l_linenumber END AS BIGINT) AS line_key, l_quantity,
        CASE WHEN l_suppkey < 4 THEN s_name END AS supplier_name
        FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""",
    "lookup_absent_keys": """SELECT s_suppkey AS supplier, s_name, l_orderkey, l_linenumber
        FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey AND s_suppkey > 3""",
    "csv_codes": f"""SELECT * REPLACE (lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS p_partkey,
        lpad(CAST(p_size AS VARCHAR), 2, '0') AS p_size,
        CAST({dec("p_retailprice", 15, 2)} AS VARCHAR) AS p_retailprice) FROM part""",
    "sanitize_columns": """SELECT c_custkey AS "Cust_ID", c_name AS "Full_Name",
        c_nationkey AS "Nation_Key", c_acctbal AS "Acct_Bal", c_mktsegment AS "Acct_Bal_2"
        FROM customer""",
    "bronze_ingest": f"""SELECT CAST(p_partkey AS VARCHAR) AS "Part_Key", p_name AS "Part_Name",
        p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size,
        CAST({dec("p_retailprice", 15, 2)} AS VARCHAR) AS p_retailprice, '2024-01-01 00:00:00' AS _ingestion_timestamp,
        'PART.csv' AS _source_file, 'SAP' AS _source_system,
        DATE '2024-01-01' AS _bronze_load_date FROM part""",
    "ingest_summary": f"""SELECT source_system, status, count(*) AS table_count,
        CAST(sum(record_count) AS BIGINT) AS total_records
        FROM ({INGEST_LOG}) GROUP BY source_system, status""",
    "ingest_log_sorted": f"SELECT * FROM ({INGEST_LOG}) ORDER BY source_system, table_name",
    "silver_trim_null": f"""{ctes("padded_customers")}
        SELECT id, nullif(trim(name), '') AS name, nullif(trim(segment), '') AS segment,
        nullif(trim(nation), '') AS nation FROM padded_customers""",
    "blank_values": """SELECT doc_id,
        md5(nullif(trim('  ' || text || ' '), '')) AS digest,
        CAST(NULL AS VARCHAR) AS nothing FROM documents""",
    "silver_dates": f"""{ctes("order_dates")}
        SELECT id, {date8("ordered")} AS ordered, {date8("noted")} AS noted,
        {date8("CAST(number AS VARCHAR)")} AS number, real_date FROM order_dates""",
    "silver_dedupe": f"""WITH dated AS (SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate)
        FROM lineitem) {latest("dated", "l_orderkey, l_linenumber", down(
            "l_shipdate l_partkey l_suppkey l_quantity l_extendedprice l_discount l_tax "
            "l_returnflag l_linestatus"))}""",
    "silver_dedupe_first_column": latest("lineitem", "l_suppkey", down(
        "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
        "l_returnflag l_linestatus l_shipdate")),
    "silver_transform": f"""{CLEAN_LINES} SELECT *, DATE '2024-01-01' AS _silver_load_date,
        TRUE AS _is_current FROM clean""",
    "silver_run": f"""{ctes("raw_lines")},
        text_lines AS (
            SELECT order_id, CAST(line AS VARCHAR) AS line, trim(flag) AS flag,
                nullif(trim(status), '') AS status, {date8("shipped")} AS shipped,
                CAST(part AS VARCHAR) AS part, CAST(supplier AS VARCHAR) AS supplier,
                CAST(quantity AS VARCHAR) AS quantity FROM raw_lines)
        SELECT *, DATE '2024-01-01' AS _silver_load_date, TRUE AS _is_current
        FROM ({latest("text_lines", "order_id, line",
            down("shipped part supplier flag status quantity"))})""",
    "mapping_projection": """SELECT event_id AS lot, user_id AS market, event_type AS kind,
        value AS sales_history FROM events""",
    "mapping_file": """SELECT o_orderkey AS "Order", o_totalprice AS "Value, total" FROM orders""",
    "layers_listed": """SELECT layer || '_layers_listed' AS layer,
        CASE WHEN layer = 'silver' THEN (SELECT count(*) FROM customer) ELSE 0 END AS record_count
        FROM (VALUES ('bronze'), ('silver'), ('gold')) x(layer)""",
    "fact_stamps": f"""SELECT inspection_lot, '2024-01-01 00:00:00' AS created_timestamp,
        '2024-01-01 00:00:00' AS updated_timestamp FROM ({release("ART = '04'")})""",
    "typed_staging": f"""SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
        CAST(l_linenumber AS VARCHAR) AS line, {dec("l_quantity", 15, 3)} AS quantity,
        {dec("l_extendedprice", 15, 2)} AS price, {dec("l_tax", 10, 4)} AS ratio,
        l_returnflag AS flag, TRY_CAST(l_linestatus AS INTEGER) AS number,
        CASE WHEN l_linenumber % 6 IN (0, 1) THEN {dec("l_partkey", 15, 2)}
            WHEN l_linenumber % 6 = 2 THEN {dec("l_partkey * 100", 15, 2)}
            WHEN l_linenumber % 6 = 3 THEN {dec("'-0.' || l_partkey", 15, 2)} END AS amount
        FROM lineitem""",
    "columns_by_type": "SELECT l_partkey AS part, l_quantity AS quantity, 8 AS width FROM lineitem",
    "surrogate_keys": f"""{ctes("keyed_lines")} SELECT *,
        {key("order_id", "part", "line", "flag")} AS row_key FROM keyed_lines""",
    "single_keys": f"""{ctes("keyed_lines")} SELECT order_id, part, supplier,
        md5(flag) AS flag_key FROM keyed_lines""",
    "scd_columns": f"""SELECT p_partkey, p_name, p_brand, {key("p_partkey", "p_brand")} AS part_key,
        {VALIDITY}, '2024-01-01 00:00:00' AS created_timestamp,
        '2024-01-01 00:00:00' AS updated_timestamp FROM part""",
    "code_labels": f"""{ctes("ekpo_raw")} SELECT EBELN, MATNR, WERKS, PSTYP,
        CASE WHEN PSTYP = 'L' THEN 'Subcontract' WHEN PSTYP IS NULL THEN 'Turn Key'
        ELSE 'Other' END AS sub_type FROM ekpo_raw""",
    "calendar_of_events": f"SELECT event_id, {calendar('CAST(ts AS DATE)')} FROM events",
    "date_texts": f"""SELECT event_id, {date8("CAST(user_id * 100 + 20240000 + event_id % 40 AS VARCHAR)")}
        AS day FROM events""",
    "dim_product": f"{ctes('mara', 'makt')} {PRODUCT}",
    "dim_batch": f"""{ctes("mch1")} SELECT MATNR AS material_number, CHARG AS batch_number,
        ERSDA AS created_date, HSDAT AS production_date, VFDAT AS expiry_date,
        LAEDA AS last_change_date, {key("MATNR", "CHARG")} AS dim_batch_key, {VALIDITY} FROM mch1""",
    "dim_currency": f"""{ctes("segments", "lfm1")} SELECT DISTINCT WAERS AS currency_code,
        {key("WAERS")} AS dim_currency_key, {VALIDITY}
        FROM (SELECT WAERS FROM segments UNION ALL SELECT WAERS FROM lfm1) WHERE WAERS IS NOT NULL""",
    "dim_date": f"""SELECT {calendar("d")} FROM (SELECT CAST(unnest(generate_series(
        min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d
        FROM orders)""",
    "dim_storage": f"{ctes('t001w', 't001l')} {STORAGE}",
    "dim_supplier": f"{ctes('lfa1', 'lfm1', 'lfb1')} {SUPPLIER}",
    "dim_uom": f"{ctes('mara')} {UNIT}",
    "dim_customer": f"""{ctes("master_customer")} SELECT Customer_ID AS customer_id,
        Customer_Description AS customer_description, Customer_Region AS customer_region,
        Customer_Country_Region AS customer_country_region, Demand_Type AS demand_type,
        Demand_Sub_Type AS demand_sub_type, Latitude AS latitude, Longttitude AS longitude,
        {key("Customer_ID")} AS dim_customer_key, {VALIDITY} FROM master_customer""",
    "dim_customer_product": f"""{ctes("master_customer_product")} SELECT CUSTOMER_ID AS customer_id,
        PRODUCT_ID AS product_id, MARKET_SEGMENT AS market_segment,
        REMAINING_SHELF_LIFE AS remaining_shelf_life,
        {key("CUSTOMER_ID", "PRODUCT_ID")} AS dim_customer_product_key, {VALIDITY}
        FROM master_customer_product""",
    "dim_location": f"""{ctes("master_location")} SELECT LOCATION_ID AS location_id,
        LOCATION_DESCRIPTION AS location_description, LOCATION_REGION AS location_region,
        LOCATION_TYPE AS location_type, LATITUDE AS latitude, LONGTTITUDE AS longitude,
        {key("LOCATION_ID")} AS dim_location_key, {VALIDITY} FROM master_location""",
    "dim_location_product": f"""{ctes("master_location_product")} SELECT Location_ID AS location_id,
        Product_ID AS product_id, Material_Description AS product_description,
        Plant_Exclusion_X AS plant_exclusion_flag, Market_DC_X AS market_dc_flag,
        {key("Location_ID", "Product_ID")} AS dim_location_product_key, {VALIDITY}
        FROM master_location_product""",
    "dim_key_lookup": f"""{ctes("lfa1", "lfm1", "lfb1", "keyed_lines")},
        suppliers AS (SELECT DISTINCT supplier_number, purchasing_org, dim_supplier_key
            FROM ({SUPPLIER}))
        SELECT k.order_id, k.part, CAST(k.supplier AS VARCHAR) AS supplier, k.line, k.flag,
            s.dim_supplier_key
        FROM keyed_lines k LEFT JOIN suppliers s
            ON CAST(k.supplier AS VARCHAR) = s.supplier_number AND k.flag = s.purchasing_org""",
    "fact_inventory": INVENTORY,
    "fact_month_end": f"{ctes('mchbh', 'mardh', 'mbewh')} {MONTH_END}",
    "fact_monthly_snapshot": f"""{ctes("mchbh", "mardh", "mbewh")}, month_end AS ({MONTH_END})
        SELECT material_number, plant, fiscal_year, fiscal_period,
            {dec("sum(unrestricted_stock_qty)", 25, 3)} AS total_unrestricted_qty,
            {dec("sum(quality_inspection_qty)", 25, 3)} AS total_quality_insp_qty,
            {dec("sum(blocked_stock_qty)", 25, 3)} AS total_blocked_qty,
            {dec("sum(total_stock_qty)", 27, 3)} AS total_inventory_qty,
            {dec("sum(total_stock_value)", 38, 5)} AS total_inventory_value,
            {dec("avg(moving_average_price)", 19, 6)} AS avg_price,
            count(batch_number) AS batch_count, any_value(month_end_date) AS snapshot_date
        FROM month_end GROUP BY material_number, plant, fiscal_year, fiscal_period""",
    "delivered_qty": f"{ctes('ekbe')} {DELIVERED}",
    "po_fact": PURCHASE,
    "fact_demand_actual": f"""{ctes("demand_actual")} SELECT {DEMAND_KEYS}, {measures(ACTUALS)},
        {dec("service_level", 10, 4)} AS service_level, {PERIOD_DATE} FROM demand_actual""",
    "fact_demand_forecast": f"""{ctes("demand_forecast")} SELECT {DEMAND_KEYS}, {measures(FORECASTS)},
        {dec("upside", 15, 3)} AS upside_forecast, {PERIOD_DATE} FROM demand_forecast""",
    "batch_external": release("ART = '04'"),
    "batch_internal": release("ART <> '04'"),
    "lookup_spread": """SELECT l_suppkey AS supplier, l_orderkey, l_partkey, l_linenumber,
        s_name AS supplier_name FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey""",
    "schedule_spread": """SELECT s.s_suppkey AS supplier, st.status, s.s_name, l.l_orderkey,
        l.l_partkey, l.l_quantity
        FROM supplier s, (VALUES ('O'), ('X')) st(status)
        LEFT JOIN lineitem l ON l.l_suppkey = s.s_suppkey AND l.l_linestatus = st.status""",
    "null_profile_wide": f"""{CLEAN_LINES} SELECT {counted(
        "order_id line flag status shipped part supplier quantity")} FROM clean""",
    "null_profile_first5": f"""{CLEAN_LINES} SELECT {counted(
        "order_id line flag status shipped", "_nulls")} FROM clean""",
    "bronze_check": " UNION ALL ".join(
        f"SELECT count(*) AS row_count, CAST(5 AS BIGINT) AS column_count, '{c}' AS column_name, "
        f"count(*) - count({c}) AS null_count FROM ({ctes('padded_customers')} "
        f"SELECT * FROM padded_customers)"
        for c in "id name segment nation".split()
    ),
    "bronze_preview": f"""{ctes("raw_lines")} SELECT * EXCLUDE (_source_file) FROM raw_lines
        ORDER BY quantity, order_id, line, part, supplier LIMIT 5""",
    "dim_summary": summary(
        "dimension",
        [
            ("dim_product", f"{ctes('mara', 'makt')} {PRODUCT}", 14, None),
            ("dim_uom", f"{ctes('mara')} {UNIT}", 6, None),
            ("dim_storage", f"{ctes('t001w', 't001l')} {STORAGE}", 11, None),
        ],
    ),
    "facts_summary": summary(
        "fact_table",
        [("fact_inventory", INVENTORY, 20, 13), ("fact_purchase_order", PURCHASE, 36, 8)],
    ),
}

# Rows of every table of the whole load, with the currencies of all its sources.
_CURRENCIES = f"""{ctes('lfm1', 'ekko')} SELECT WAERS FROM lfm1 WHERE WAERS IS NOT NULL
    UNION SELECT WAERS FROM ekko WHERE WAERS IS NOT NULL"""
_CALENDAR_DAYS = "SELECT unnest(generate_series(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY))"
_LOADED = {
    "dim_currency": _CURRENCIES,
    "dim_date": _CALENDAR_DAYS,
    **{
        f"dim_{n}": ORACLE[f"dim_{n}"]
        for n in (
            "product", "batch", "storage", "supplier", "uom", "customer", "customer_product",
            "location", "location_product",
        )
    },
    "fact_inventory": ORACLE["fact_inventory"],
    "fact_inventory_month_end_stock": ORACLE["fact_month_end"],
    "fact_inventory_monthly_snapshot": ORACLE["fact_monthly_snapshot"],
    "fact_purchase_order": ORACLE["po_fact"],
    "fact_demand_actual": ORACLE["fact_demand_actual"],
    "fact_demand_forecast": ORACLE["fact_demand_forecast"],
    "fact_batch_release_external": ORACLE["batch_external"],
    "fact_batch_release_internal": ORACLE["batch_internal"],
}
_KEYS = {
    "dim_product": "material_number", "dim_batch": "batch_number", "dim_date": "month_name",
    "dim_storage": "plant", "dim_supplier": "supplier_number", "dim_uom": "uom_code",
    "dim_customer": "customer_id", "dim_customer_product": "product_id",
    "dim_location": "location_id", "dim_location_product": "product_id",
    "fact_inventory": "batch_number", "fact_inventory_month_end_stock": "batch_number",
    "fact_inventory_monthly_snapshot": "material_number", "fact_purchase_order": "short_text",
    "fact_demand_actual": "product_id", "fact_demand_forecast": "product_id",
    "fact_batch_release_external": "inspection_lot", "fact_batch_release_internal": "inspection_lot",
    "dim_currency": "WAERS",
}
_LETTERS = {n: f"CAST(sum(length({c})) AS BIGINT)" for n, c in _KEYS.items()}
_LETTERS["dim_date"] = "CAST(sum(length(strftime(d, '%B'))) AS BIGINT)"
_LOADED["dim_date"] = _CALENDAR_DAYS + " AS d"
ORACLE["gold_run"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, 'SUCCESS' AS status, count(*) AS record_count, "
    f"{_LETTERS[name]} AS key_letters FROM ({sql}) x"
    for name, sql in _LOADED.items()
)
# Read the material master or the past location stock, at one or two removes.
_NOT_RENEWED = {
    "dim_product", "dim_uom", "fact_inventory_month_end_stock", "fact_inventory_monthly_snapshot",
}
ORACLE["gold_run_failed"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, 'FAILED' AS status, CAST(0 AS BIGINT) AS record_count"
    if name in _NOT_RENEWED
    else f"SELECT '{name}' AS table_name, 'SUCCESS' AS status, count(*) AS record_count FROM ({sql}) x"
    for name, sql in _LOADED.items()
)

ORACLE["gold_write_failed"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{status}' AS status, CAST({count} AS BIGINT) AS record_count, "
    f"'{readable}' AS readable, count(*) AS readable_rows, {_LETTERS[name]} AS key_letters FROM ({sql}) x"
    for name, sql in _LOADED.items()
    for status, count, readable in [
        ("FAILED", "0", "OLD") if name == "fact_purchase_order" else ("SUCCESS", "count(*)", "NEW")
    ]
)
ORACLE["written_summary"] = ORACLE["facts_summary"]


def _registry_rows() -> str:
    """Rows of each extract: the first column, a key's or none's, has distinct values."""
    parts = []
    for rule, table in zip(RULES, itertools.cycle(("customer", "part", "supplier", "orders"))):
        rows = kept = f"SELECT count(*) FROM {table}"
        if len(rule.keys + rule.dates) > 6:
            rows = "SELECT count(*) FROM lineitem"
            kept = """SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey,
                l_linenumber, l_quantity, l_extendedprice, l_discount FROM lineitem)"""
        parts.append(("raw", rule.extract, rule.system, rows))
        parts.append(("clean", rule.table, rule.system, kept))
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, '{system}' AS source_system, "
        f"'SUCCESS' AS status, ({count}) AS record_count"
        for layer, name, system, count in parts
    )


ORACLE["registry_run"] = _registry_rows()
