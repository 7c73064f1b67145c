"""The test tables dressed as business tables.

Each binding is SQL that Spark and DuckDB read alike, so both sides of a check
start from the same input: the operators under test are DataFrame code on one
side and separate SQL on the other. Test tables appear as ``{name}``.

The test tables hold no NULLs and no dirty values. Bindings make some, by
conditions on the data, in columns; they never leave out rows to save work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

_DEMAND_ROWS = """
    select market, material, max(status) as period_id, period,
           cast(sum(qty) as decimal(15,3)) as qty,
           cast(sum(revenue) as decimal(15,2)) as revenue,
           min(ratio) as ratio
    from (
        select cast(o_custkey as string) as market, cast(l_partkey as string) as material,
               o_orderstatus as status,
               cast(year(o_orderdate) as string) ||
                   case when l_returnflag = 'R' then '13'
                        when month(o_orderdate) < 10 then '0' || cast(month(o_orderdate) as string)
                        else cast(month(o_orderdate) as string) end as period,
               cast(l_quantity as decimal(15,3)) as qty,
               cast(l_extendedprice as decimal(15,2)) as revenue,
               cast(l_discount as decimal(10,4)) as ratio
        from {orders} join {lineitem} on o_orderkey = l_orderkey
    ) sold
    group by market, material, period
"""
_SNAPSHOTS = ",\n           ".join(f"qty + {i} as fcst_snapshot_{i}" for i in range(1, 13))
# Rows under another key are what rows without a partner look like from the other side.
_UNMET_STOCK = "case when l_returnflag = 'N' then 'x' else '' end"
_UNMET_PRICE = "case when l_discount < 0.05 then 'x' else '' end"
_LINE_KEYS = "cast(l_partkey as string) as MATNR, cast(l_suppkey as string) as {plant}"
_PERIOD = """year(l_shipdate) as LFGJA,
           case when l_linenumber = 7 then 13 else month(l_shipdate) end as LFMON"""
_PERIOD_GROUP = "year(l_shipdate), case when l_linenumber = 7 then 13 else month(l_shipdate) end"
_STOCK = """cast(l_linenumber as string) as LGORT,
           cast(l_orderkey as string) as CHARG,
           l_quantity as CLABS,
           l_discount as CUMLM,
           case when l_returnflag <> 'A' then l_tax end as CINSM,
           l_discount as CSPEM"""

BINDINGS: dict[str, str] = {
    "mara": """
    select cast(p_partkey as string) as MATNR,
           case when p_size > 10 then p_type end as MTART,
           p_brand as MATKL,
           case when p_type <> 'PROMO' then p_type end as MEINS,
           case when p_size > 20 then 'K' end as VPSTA,
           cast(p_size as string) as PSTAT,
           case when p_size < 5 then '01' end as MSTAE,
           date '2024-01-01' as ERSDA,
           case when p_size > 30 then date '2024-02-01' end as LAEDA
    from {part}""",
    "makt": """
    select cast(p_partkey as string) as MATNR,
           p_name as MAKTX,
           case when p_size <= 25 then 'E' else 'D' end as SPRAS
    from {part}""",
    "mch1": """
    select distinct cast(l_partkey as string) as MATNR,
           cast(l_orderkey as string) as CHARG,
           cast(l_shipdate as date) as ERSDA,
           case when l_returnflag = 'R' then cast(l_shipdate as date) end as HSDAT,
           last_day(cast(l_shipdate as date)) as VFDAT,
           l_linestatus as LAEDA
    from {lineitem}""",
    "t001w": """
    select cast(s_suppkey as string) as WERKS, s_name as NAME1, 'city' as ORT01,
           cast(s_nationkey as string) as LAND1,
           case when s_acctbal > 0 then 'plus' end as REGIO
    from {supplier}""",
    "t001l": """
    select case when l_discount > 0.09 and l_tax > 0.07 then '' else 'x' end
               || cast(l_suppkey as string) as WERKS,
           cast(l_linenumber as string) as LGORT, 'bin ' || cast(min(l_partkey) as string) as LGOBE
    from {lineitem}
    group by case when l_discount > 0.09 and l_tax > 0.07 then '' else 'x' end,
             l_suppkey, l_linenumber""",
    "lfa1": """
    select cast(s_suppkey as string) as LIFNR, s_name as NAME1,
           cast(s_nationkey as string) as LAND1, 'city' as ORT01,
           case when s_acctbal > 0 then '00' || cast(s_nationkey as string) end as PSTLZ,
           'street' as STRAS, 'Z001' as KTOKK, date '2023-05-06' as ERDAT
    from {supplier}""",
    "lfm1": """
    select cast(l_suppkey as string) as LIFNR, l_returnflag as EKORG,
           case when l_returnflag = 'A' then 'EUR' when l_returnflag = 'R' then 'USD' end as WAERS,
           'Z' || l_returnflag as ZTERM, l_linestatus as INCO1
    from {lineitem}""",
    "lfb1": """
    select cast(l_suppkey as string) as LIFNR, cast(l_linenumber as string) as BUKRS,
           'mail' || l_linestatus || '@x' as INTAD
    from {lineitem}""",
    "segments": """
    select case when c_mktsegment <> 'MACHINERY' then c_mktsegment end as WAERS from {customer}""",
    "master_customer": """
    select cast(c_custkey as string) as Customer_ID, c_name as Customer_Description,
           cast(c_nationkey as string) as Customer_Region,
           cast(c_nationkey + 100 as string) as Customer_Country_Region,
           c_mktsegment as Demand_Type,
           case when c_acctbal > 0 then 'base' end as Demand_Sub_Type,
           c_acctbal as Latitude, -c_acctbal as Longttitude
    from {customer}""",
    "master_customer_product": """
    select cast(o_custkey as string) as CUSTOMER_ID, cast(l_partkey as string) as PRODUCT_ID,
           max(l_returnflag) as MARKET_SEGMENT,
           cast(max(l_linenumber) as int) as REMAINING_SHELF_LIFE
    from {orders} join {lineitem} on o_orderkey = l_orderkey
    group by o_custkey, l_partkey""",
    "master_location": """
    select cast(s_suppkey as string) as LOCATION_ID, s_name as LOCATION_DESCRIPTION,
           n_name as LOCATION_REGION,
           case when s_acctbal > 5000 then 'DC' end as LOCATION_TYPE,
           s_acctbal as LATITUDE, -s_acctbal as LONGTTITUDE
    from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "master_location_product": """
    select cast(l_suppkey as string) as Location_ID, cast(l_partkey as string) as Product_ID,
           'part ' || cast(l_partkey as string) as Material_Description,
           case when max(l_tax) > 0.05 then 'X' end as Plant_Exclusion_X,
           case when min(l_discount) < 0.02 then 'X' end as Market_DC_X
    from {lineitem} group by l_suppkey, l_partkey""",
    "mchb": f"""
    select {_LINE_KEYS.replace("{plant}", "WERKS")},
           {_STOCK}
    from {{lineitem}}""",
    "mard": f"""
    select {_UNMET_STOCK} || {_LINE_KEYS.replace("{plant}", "WERKS")},
           cast(l_linenumber as string) as LGORT,
           sum(cast(l_quantity as decimal(15,3))) as LABST,
           sum(cast(l_tax as decimal(15,3))) as INSME,
           count(*) as SPEME
    from {{lineitem}}
    group by {_UNMET_STOCK}, l_partkey, l_suppkey, l_linenumber""",
    "mbew": f"""
    select {_UNMET_PRICE} || {_LINE_KEYS.replace("{plant}", "BWKEY")},
           max(l_extendedprice) as VERPR, min(l_extendedprice) as STPRS, count(*) as PEINH,
           max(l_returnflag) as BWTAR, min(l_linestatus) as BKLAS
    from {{lineitem}}
    group by {_UNMET_PRICE}, l_partkey, l_suppkey""",
    "mslb": f"""
    select case when l_returnflag = 'R' then '' else 'x' end
               || {_LINE_KEYS.replace("{plant}", "WERKS")}, cast(l_orderkey as string) as CHARG,
           l_returnflag as SOBKZ, l_quantity as LBLAB
    from {{lineitem}}""",
    "mchbh": f"""
    select {_LINE_KEYS.replace("{plant}", "WERKS")},
           {_PERIOD},
           {_STOCK}
    from {{lineitem}}""",
    "mardh": f"""
    select {_UNMET_STOCK} || {_LINE_KEYS.replace("{plant}", "WERKS")},
           cast(l_linenumber as string) as LGORT, {_PERIOD},
           sum(cast(l_quantity as decimal(15,3))) as LABST
    from {{lineitem}}
    group by {_UNMET_STOCK}, l_partkey, l_suppkey, l_linenumber, {_PERIOD_GROUP}""",
    "mbewh": f"""
    select {_UNMET_PRICE} || {_LINE_KEYS.replace("{plant}", "BWKEY")},
           {_PERIOD},
           max(l_extendedprice) as VERPR, min(l_extendedprice) as STPRS
    from {{lineitem}}
    group by {_UNMET_PRICE}, l_partkey, l_suppkey, {_PERIOD_GROUP}""",
    "ekko": """
    select cast(o_orderkey as string) as EBELN, '1000' as BUKRS,
           case when o_orderpriority = '1-URGENT' then 'ZZ' when o_orderstatus = 'F' then 'NB'
                when o_orderstatus = 'O' then 'ZARB' else 'UB' end as BSART,
           cast(o_custkey as string) as LIFNR, o_orderstatus as EKORG,
           o_orderpriority as EKGRP, 'EUR' as WAERS, o_orderstatus as STATU,
           cast(cast(o_orderdate as date) as string) as BEDAT, 'clerk' as ERNAM,
           case when o_totalprice > 100000 then cast(cast(o_orderdate as date) as string) end as AEDAT
    from {orders}""",
    "ekpo_raw": """
    select cast(l_orderkey as string) as EBELN, cast(l_linenumber as string) as EBELP,
           cast(l_partkey as string) as MATNR, l_returnflag as BUKRS,
           cast(l_suppkey as string) as WERKS, l_linestatus as LGORT,
           l_returnflag || l_linestatus as MATKL, 'item ' || cast(l_partkey as string) as TXZ01,
           'EA' as MEINS,
           case when l_returnflag = 'R' then 'L' when l_returnflag = 'N' then 'K' end as PSTYP,
           l_quantity as MENGE, l_extendedprice as NETPR
    from {lineitem}""",
    "eket": """
    select case when l_discount > 0 then '' else 'x' end || cast(l_orderkey as string) as EBELN,
           cast(l_linenumber as string) as EBELP,
           cast(l_partkey as string) || '-' || cast(l_suppkey as string) as ETENR,
           cast(cast(l_shipdate as date) as string) as EINDT,
           l_quantity as MENGE,
           case when l_tax = 0 then null when l_linestatus = 'O' then l_quantity - 1
                else l_quantity end as WEMNG
    from {lineitem}""",
    "ekbe": """
    select cast(l_orderkey as string) as EBELN, cast(l_linenumber as string) as EBELP,
           case when l_returnflag = 'R' then '1' else '2' end as VGABE,
           l_quantity as MENGE, l_extendedprice as DMBTR
    from {lineitem}""",
    "vendors": "select cast(c_custkey as string) as LIFNR, c_name as NAME1 from {customer}",
    "t001": """
    select distinct case when l_returnflag = 'A' then 'x' else '' end || l_returnflag as BUKRS,
           'company ' || l_returnflag as BUTXT
    from {lineitem}""",
    "t024": """
    select distinct case when o_orderpriority = '5-LOW' then 'x' else '' end || o_orderpriority
               as EKGRP, lower(o_orderpriority) as EKNAM
    from {orders}""",
    "t024e": """
    select distinct o_orderstatus as EKORG, 'org ' || o_orderstatus as EKOTX from {orders}""",
    "demand_actual": f"""
    select market, material, period_id, period,
           qty as actual_qty, revenue as actual_revenue, qty - 1 as shipped_qty,
           case when period_id = 'F' then qty end as delivered_qty, qty - 2 as net_actual_qty,
           revenue - 10 as net_revenue, ratio as service_level
    from ({_DEMAND_ROWS}) d""",
    "demand_forecast": f"""
    select market, material, period_id, period,
           qty as consensus_demand, qty + 1 as ibp_consensus_forecast, qty + 2 as ibp_forecast,
           qty + 3 as budget_volumes, case when period_id = 'O' then qty end as sc_forecast_override,
           qty + 4 as statistical_forecast, qty + 5 as upside,
           {_SNAPSHOTS},
           qty - 2 as fcst_variance_snapshot_2, qty - 3 as fcst_variance_snapshot_3,
           revenue as fcst_variance_perc_snapshot_2, revenue + 1 as fcst_variance_perc_snapshot_3,
           qty - 1 as ibp_consensus_forecast_prior
    from ({_DEMAND_ROWS}) d""",
    "qals": """
    select cast(doc_id as string) as PRUEFLOS, source as WERK,
           case when lang = 'en' then '04' when lang = 'de' then null else '01' end as ART,
           lang as MATNR, source as LIFNR, cast(n_chars as string) as EBELN, '10' as EBELP,
           '2024-01-02' as ENSTEHDAT, '2024-01-03' as ERSTELDAT,
           case when n_chars > 1000 then '2024-01-04' end as BUDAT,
           n_chars as LOSMENGE, n_chars + 1 as GESSTICHPR
    from {documents}""",
    "qave": """
    select cast(doc_id as string) as PRUEFLOS, 'p' as VWERKS,
           case when quality = 1 then 'A' else 'R' end as VBEWERTUNG,
           cast(toxic as string) as DBEWERTUNG,
           case when toxic = 1 then 'BLOCK' end as VFOLGEAKTI,
           '2024-02-01' as VDATUM, quality as VAUSWAHLMG
    from {labels}""",
    "hot_qals": """
    select case when doc_id % 3 = 0 then 'hot' else cast(doc_id as string) end as PRUEFLOS,
           cast(doc_id as string) as MATNR, source as WERK, source as LIFNR, lang as EBELN, '10' as EBELP,
           case when lang = 'en' then '04' when lang = 'de' then null else '01' end as ART,
           '2024-01-02' as ENSTEHDAT, '2024-01-03' as BUDAT, n_chars as LOSMENGE, n_chars as GESSTICHPR
    from {documents}""",
    "hot_qave": """
    select case when doc_id < 5 then 'hot' else cast(doc_id as string) end as PRUEFLOS,
           cast(quality as string) as VBEWERTUNG, cast(toxic as string) as DBEWERTUNG,
           cast(doc_id as string) as VFOLGEAKTI, '2024-02-01' as VDATUM, quality as VAUSWAHLMG
    from {labels}""",
    "padded_customers": """
    select c_custkey as id, '  ' || c_name || ' ' as name,
           case when c_mktsegment = 'MACHINERY' then '   ' else c_mktsegment end as segment,
           case when c_acctbal < 0 then '' when c_acctbal < 1000 then null
                else ' ' || cast(c_nationkey as string) end as nation,
           'batch 7' as _load
    from {customer}""",
    "order_dates": """
    select o_orderkey as id,
           case o_orderpriority when '1-URGENT' then '00000000' when '2-HIGH' then '20230230'
                when '3-MEDIUM' then null
                else replace(cast(cast(o_orderdate as date) as string), '-', '') end as ordered,
           case o_orderstatus when 'F' then '2024011' when 'O' then '2024-01-15'
                else replace(cast(cast(o_orderdate as date) as string), '-', '') end as noted,
           year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1 as number,
           cast(o_orderdate as date) as real_date
    from {orders}""",
    "raw_lines": """
    select cast(l_orderkey as string) as order_id, l_linenumber as line,
           ' ' || l_returnflag || ' ' as flag,
           case when l_linestatus = 'O' then ' ' else l_linestatus end as status,
           case when l_returnflag = 'R' then '20241345'
                else replace(cast(cast(l_shipdate as date) as string), '-', '') end as shipped,
           l_partkey as part, l_suppkey as supplier, l_quantity as quantity,
           'file.csv' as _source_file
    from {lineitem}""",
    "keyed_lines": """
    select l_orderkey as order_id, l_partkey as part, l_suppkey as supplier,
           case when l_returnflag <> 'R' then l_linenumber end as line,
           case when l_linestatus = 'O' then l_returnflag end as flag
    from {lineitem}""",
}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def bind(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    """The named business tables as DataFrames."""
    used = {
        t: read(spark, folder, t)
        for t in TABLES
        if any(f"{{{t}}}" in BINDINGS[n] for n in names)
    }
    return [
        spark.sql(
            BINDINGS[n], **{t: df for t, df in used.items() if f"{{{t}}}" in BINDINGS[n]}
        )
        for n in names
    ]


def demand_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that both demand tables are views of."""
    return spark.sql(_DEMAND_ROWS, **{t: read(spark, folder, t) for t in ("orders", "lineitem")})


def bind_demand(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """A demand table over rows that were worked out before, once for both."""
    return spark.sql(BINDINGS[name].replace(_DEMAND_ROWS, "select * from {rows}"), rows=rows)


def ctes(*names: str) -> str:
    """The named business tables as SQL common table expressions."""
    plain = {t: t for t in TABLES}
    return "WITH " + ",\n".join(f"{n} AS ({BINDINGS[n].format(**plain)})" for n in names)
