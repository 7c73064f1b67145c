from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from erp import write_extracts
from tristrata.operators import TableCheck
from tristrata.plans import load
from tristrata.plans.bronze import ingest_all
from tristrata.plans.outcomes import outcome_log, sorted_log, summarize_log
from tristrata.plans.registry import RULES, Rule
from tristrata.sources import Layers, create_layers, drop_table, read_csv, use_layer, write_table

AS_OF = datetime(2024, 6, 1, 12, 0, 0)
LAYERS = Layers("t_bronze", "t_silver", "t_gold")


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folders = write_extracts(tmp_path_factory.mktemp("extracts"))
    place = str(tmp_path_factory.mktemp("layers"))
    split = {"fact_inventory_month_end_stock": ["fiscal_year"]}
    return load.run(
        spark, folders, layers=LAYERS, as_of=AS_OF, location=place, partitions=split
    )


@pytest.fixture
def gold(spark, loaded):
    return lambda name: spark.table(f"{LAYERS.gold}.{name}")


def test_every_table_loads(loaded):
    assert loaded.failed == [] and loaded.ok
    assert (len(loaded.bronze), len(loaded.silver), len(loaded.gold)) == (43, 43, 19)


def test_counts_are_those_of_the_tables(spark, loaded):
    for outcomes, layer, names in (
        (loaded.bronze, LAYERS.bronze, [r.raw_table for r in RULES]),
        (loaded.silver, LAYERS.silver, [r.table for r in RULES]),
        (loaded.gold, LAYERS.gold, [o.table_name for o in loaded.gold]),
    ):
        for outcome, name in zip(outcomes, names):
            assert spark.table(f"{layer}.{name}").count() == outcome.record_count, name


def test_raw_table(spark, loaded):
    raw = spark.table(f"{LAYERS.bronze}.sap_t077k")
    assert raw.columns[-4:] == [
        "_ingestion_timestamp", "_source_file", "_source_system", "_bronze_load_date",
    ]
    assert raw.select("DURAS", "KTOKD", "_source_file", "_source_system").collect() == [
        ("X", "0001", "T077K.csv", "SAP"), (None, "0001", "T077K.csv", "SAP"),
    ]


def test_header_only_extract_is_an_empty_table_of_strings(spark, loaded):
    raw = spark.table(f"{LAYERS.bronze}.sap_plko")
    assert raw.count() == 0 and raw.dtypes[0] == ("MANDT", "string")


def test_cleansed_table(spark, loaded):
    rows = spark.table(f"{LAYERS.silver}.mara").orderBy("MATNR").collect()
    assert [(r.MATNR, r.ERSDA, r.LAEDA, r.PSTAT) for r in rows] == [
        ("0001", date(2023, 1, 5), None, None), ("0002", None, date(2024, 1, 1), None),
    ]
    assert all(r._is_current and r._silver_load_date == AS_OF.date() for r in rows)


def test_ingestion_log(spark, loaded):
    log = spark.table(f"{LAYERS.bronze}.{load.LOG_TABLE}")
    got = {(r.source_system, r.status): r.table_count for r in summarize_log(log).collect()}
    assert got == {("SAP", "SUCCESS"): 37, ("IBP", "SUCCESS"): 6}
    names = [r.table_name for r in sorted_log(log).collect()]
    assert names[:2] == ["demand_actual", "demand_forcast"] and names[6] == "AUSP"


def test_dim_product(gold):
    rows = {r.material_number: r for r in gold("dim_product").collect()}
    assert rows["0001"].material_description == "Steel" and rows["0001"].maintenance_status == ""
    assert rows["0002"].material_description == "" and rows["0002"].base_uom == ""
    assert rows["0001"].effective_date == AS_OF.date() and rows["0001"].end_date is None
    assert gold("dim_product").columns[:10] == [
        "material_number", "material_description", "material_type", "material_group", "base_uom",
        "complete_status", "maintenance_status", "xplant_status", "created_date", "last_change_date",
    ]
    assert gold("dim_product").columns[10:] == [
        "dim_product_key", "effective_date", "end_date", "is_current", "created_timestamp",
        "updated_timestamp",
    ]


def test_other_dimensions(gold, rows):
    assert rows(gold("dim_batch"), "batch_number", "production_date", "expiry_date") == [
        ("B1", date(2024, 1, 2), None)
    ]
    assert rows(gold("dim_currency"), "currency_code") == [("EUR",), ("USD",)]
    assert gold("dim_date").count() == 4018
    assert rows(gold("dim_storage"), "plant", "storage_location", "plant_name") == [
        ("P1", "L1", "Plant"), ("P1", "L2", "Plant"), ("P2", None, "Empty plant"),
    ]
    assert rows(gold("dim_supplier"), "supplier_number", "purchasing_org", "email", "order_currency") == [
        ("V1", "O1", "a@x", "EUR"), ("V1", "O1", "b@x", "EUR"),
        ("V1", "O2", "a@x", "USD"), ("V1", "O2", "b@x", "USD"), ("V2", None, None, None),
    ]
    assert rows(gold("dim_uom"), "uom_code", "uom_description") == [("KG", "KG")]
    assert rows(gold("dim_customer"), "customer_id", "demand_sub_type", "latitude", "longitude") == [
        ("M1", "new", 48.5, 9.75)
    ]
    assert rows(gold("dim_customer_product"), "customer_id", "product_id", "remaining_shelf_life") == [
        ("M1", "0001", "30")
    ]
    assert rows(gold("dim_location"), "location_id", "latitude", "longitude") == [("P1", 48.5, None)]
    assert rows(gold("dim_location_product"), "plant_exclusion_flag", "market_dc_flag") == [("X", None)]


def test_fact_inventory(gold, rows):
    fact = gold("fact_inventory")
    got = rows(fact, "batch_number", "special_stock_qty", "total_stock_qty", "total_stock_value", "price_unit")
    assert got == [
        ("B1", D("7.000"), D("6.000"), D("15.00000"), D("1.000")),
        ("B1", D("8.000"), D("6.000"), D("15.00000"), D("1.000")),
        ("B2", None, None, None, D("1.000")),
        ("B3", None, D("4.000"), None, None),
    ]
    kinds = dict(fact.dtypes)
    assert kinds["total_stock_qty"] == "decimal(17,3)" and kinds["total_stock_value"] == "decimal(33,5)"
    assert fact.select("snapshot_date").distinct().collect() == [(AS_OF.date(),)]


def test_month_end_and_snapshot(gold, rows):
    stock = gold("fact_inventory_month_end_stock")
    assert rows(stock, "batch_number", "fiscal_period", "month_end_date", "total_stock_value") == [
        ("B1", 13, None, None),
        ("B1", 2, date(2024, 2, 29), D("6.00000")),
        ("B2", 2, date(2024, 2, 29), D("4.00000")),
    ]
    assert "PartitionFilters: [isnotnull(fiscal_year" in (
        stock.where("fiscal_year = 2024")._jdf.queryExecution().executedPlan().toString()
    )
    snapshot = gold("fact_inventory_monthly_snapshot")
    assert rows(
        snapshot, "fiscal_period", "total_inventory_qty", "total_inventory_value", "avg_price",
        "batch_count", "snapshot_date",
    ) == [
        (13, D("1.000"), None, None, 1, None),
        (2, D("5.000"), D("10.00000"), D("2.000000"), 2, date(2024, 2, 29)),
    ]
    sums = [df.agg(F.sum(c)).first()[0] for df, c in
            ((stock, "total_stock_qty"), (snapshot, "total_inventory_qty"))]
    assert sums[0] == sums[1]


def test_fact_purchase_order(gold, rows):
    fact = gold("fact_purchase_order")
    assert len(fact.columns) == 38
    got = rows(
        fact, "purchase_order", "po_item", "schedule_line", "outstanding_qty", "po_status",
        "delivered_qty", "delivered_value", "net_order_value", "po_type_category", "po_sub_type",
    )
    zero = (D("0.000"), D("0.00"))
    assert got == [
        ("4500", "10", "1", D("5.000"), "Open", D("5.000"), D("12.50"), D("25.00000"), "Direct", "Subcontract"),
        ("4500", "10", "2", D("0.000"), "Closed", D("5.000"), D("12.50"), D("25.00000"), "Direct", "Subcontract"),
        ("4500", "20", None, None, "Closed", *zero, D("1.00000"), "Direct", "Turn Key"),
        ("4501", "10", "1", None, "Closed", *zero, D("6.00000"), "Indirect", "Other"),
        ("4502", "10", None, None, "Closed", *zero, D("8.00000"), "STO", "Subcontract"),
    ]
    names = rows(
        fact.where("schedule_line is null or schedule_line = '1'"), "purchase_order", "po_item",
        "supplier_name", "company_name", "plant_name", "purchasing_group_name", "purchasing_org_name",
        "po_date", "delivery_date",
    )
    assert names == [
        ("4500", "10", "Vendor", "Company", "Plant", "Group", "Org", "2024-01-10", "2024-02-01"),
        ("4500", "20", "Vendor", None, None, "Group", "Org", "2024-01-10", None),
        ("4501", "10", None, "Company", "Plant", None, "Org", "2024-01-10", "2024-03-01"),
        ("4502", "10", "Vendor", "Company", "Plant", "Group", None, None, None),
    ]


def test_demand_facts(gold, rows):
    assert rows(gold("fact_demand_actual"), "period", "actual_qty", "actual_revenue", "service_level", "period_date") == [
        ("202401", D("1.500"), D("2.25"), D("0.9877"), date(2024, 1, 1)),
        ("202413", D("1.000"), None, None, None),
    ]
    forecast = gold("fact_demand_forecast")
    row = forecast.first()
    assert (row.upside_forecast, row.fcst_snapshot_12, row.fcst_variance_perc_snapshot_3) == (
        D("7.000"), D("19.000"), D("23.00"),
    )
    assert row.period_date == date(2024, 2, 1) and len(forecast.columns) == 4 + 24 + 1 + 2


def test_batch_release_facts(gold, rows):
    columns = ("inspection_lot", "usage_decision", "selected_qty", "lot_size")
    assert rows(gold("fact_batch_release_external"), *columns) == [
        ("1", "A", D("5.000"), D("5.000")), ("4", None, None, D("5.000")),
    ]
    assert rows(gold("fact_batch_release_internal"), *columns) == [("2", "R", D("4.000"), D("5.000"))]


def test_summaries(spark, loaded):
    dims = {r.dimension: r for r in load.summarize_dimensions(spark, LAYERS).collect()}
    assert len(dims) == 11 and all(r.status == "SUCCESS" for r in dims.values())
    assert (dims["dim_date"].record_count, dims["dim_date"].column_count) == (4018, 17)
    facts = {r.fact_table: r for r in load.summarize_facts(spark, LAYERS).collect()}
    assert len(facts) == 8
    assert (facts["fact_inventory"].record_count, facts["fact_inventory"].measure_count) == (4, 13)


def test_summary_reports_what_is_missing(spark, loaded):
    rows = load.summarize_facts(spark, Layers(gold="nowhere")).collect()
    assert all(r.status.startswith("FAILED: ") and r.record_count == 0 for r in rows)


def test_quality_checks(spark, loaded):
    raw = load.check_raw(spark, layers=LAYERS)
    assert set(raw) == set(load.KEY_RAW_TABLES)
    mara = raw["sap_mara"]
    assert isinstance(mara, TableCheck) and (mara.rows, mara.columns) == (3, 13)
    assert mara.nulls["PSTAT"] == 3 and "_source_file" not in mara.nulls
    assert mara.sample.count() == 3 and mara.sample.columns[0] == "MATNR"
    clean = load.check_cleansed(spark, layers=LAYERS)
    assert clean["mara"].nulls == {"MATNR": 0, "MTART": 0, "MATKL": 0, "MEINS": 1, "VPSTA": 1}
    assert isinstance(load.check_raw(spark, ["absent"], LAYERS)["absent"], Exception)


def test_one_bad_table_does_not_stop_the_rest(spark, tmp_path):
    (tmp_path / "GOOD.csv").write_text("A,B\n1,2\n")
    rules = [Rule("SAP", "MISSING", "missing"), Rule("SAP", "GOOD", "good")]
    layers = Layers("f_bronze", "f_silver", "f_gold")
    create_layers(spark, layers, str(tmp_path / "layers"))
    outcomes = ingest_all(spark, {"SAP": str(tmp_path)}, rules, layers)
    assert [(o.table_name, o.status, o.record_count) for o in outcomes] == [
        ("MISSING", "FAILED", 0), ("GOOD", "SUCCESS", 1),
    ]
    assert "MISSING.csv" in outcomes[0].error
    totals = {r.status: r.total_records for r in summarize_log(outcome_log(spark, outcomes)).collect()}
    assert totals == {"FAILED": 0, "SUCCESS": 1}


def test_load_result_says_when_something_failed(spark, tmp_path):
    layers = Layers("g_bronze", "g_silver", "g_gold")
    result = load.run(
        spark, {"SAP": str(tmp_path)}, [Rule("SAP", "MISSING", "missing")], layers,
        location=str(tmp_path / "layers"),
    )
    assert not result.ok
    assert {o.table_name for o in result.failed} >= {"MISSING", "missing", "fact_inventory"}
    assert [o.table_name for o in result.gold if o.ok] == ["dim_date"]


def test_overwrite_replaces_rows_and_schema(spark, tmp_path):
    create_layers(spark, Layers("w_bronze", "w_silver", "w_gold"), str(tmp_path))
    use_layer(spark, "w_gold")
    assert spark.catalog.currentDatabase() == "w_gold"
    use_layer(spark, "default")
    assert write_table(spark.sql("select 1 a"), "w_gold.t") == 1
    df = spark.range(5).selectExpr("id", "id % 2 as part")
    assert write_table(df, "w_gold.t", partition_by=["part"]) == 5
    assert spark.table("w_gold.t").columns == ["id", "part"]
    assert write_table(df.where("id > 9"), "w_gold.t", replace=True) == 0
    drop_table(spark, "w_gold.t")
    assert not spark.catalog.tableExists("w_gold.t")


def test_csv_options(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text('code,note\n01,"a\nb"\n02,c\n')
    assert read_csv(spark, str(file), multi_line=True).collect() == [("01", "a\nb"), ("02", "c")]
    file.write_text("code;n\n01;2\n")
    assert read_csv(spark, str(file), infer=True, sep=";").dtypes == [("code", "int"), ("n", "int")]
    assert read_csv(spark, str(file), schema="code string, n double", sep=";").collect() == [("01", 2.0)]


def test_quoted_text(spark, tmp_path):
    """Doubled quotes, separators, line breaks and a closing backslash stay as they are."""
    file = tmp_path / "q.csv"
    file.write_text('a,b\n"5"" pipe, ""steel"", x","say ""a""b"\n"c,d\\","two\nlines"\n')
    assert read_csv(spark, str(file), multi_line=True).collect() == [
        ('5" pipe, "steel", x', 'say "a"b'), ("c,d\\", "two\nlines"),
    ]
    file.write_text('a,b\n"x\\"y",1\n')
    assert read_csv(spark, str(file), escape="\\").collect() == [('x"y', "1")]


def test_bad_rows_are_counted(spark, tmp_path):
    (tmp_path / "BAD.csv").write_text("A,B\n1,2\n3\n4,5,6\n7,8\n")
    rows = read_csv(spark, str(tmp_path / "BAD.csv"), bad_rows="bad").collect()
    assert [r.bad for r in rows] == [None, "3", "4,5,6", None]
    assert [r.A for r in rows] == ["1", "3", "4", "7"]
    layers = Layers("b_bronze", "b_silver", "b_gold")
    create_layers(spark, layers, str(tmp_path / "layers"))
    (outcome,) = ingest_all(spark, {"SAP": str(tmp_path)}, [Rule("SAP", "BAD", "bad")], layers)
    assert (outcome.status, outcome.record_count, outcome.bad_records) == ("SUCCESS", 4, 2)
    assert spark.table("b_bronze.sap_bad").columns[:3] == ["A", "B", "_ingestion_timestamp"]


def test_a_rule_can_ask_for_line_breaks(spark, tmp_path):
    (tmp_path / "TEXT.csv").write_text('A,B\n1,"x\ny"\n2,z\n')
    layers = Layers("m_bronze", "m_silver", "m_gold")
    create_layers(spark, layers, str(tmp_path / "layers"))
    rules = [Rule("SAP", "TEXT", "text", multi_line=True)]
    (outcome,) = ingest_all(spark, {"SAP": str(tmp_path)}, rules, layers)
    assert (outcome.record_count, outcome.bad_records) == (2, 0)


def test_failure_reaches_all_that_is_built_from_it(spark, tmp_path):
    """A second load over old tables, with one extract gone."""
    folders = write_extracts(tmp_path / "extracts")
    layers = Layers("s_bronze", "s_silver", "s_gold")
    place = str(tmp_path / "layers")
    assert load.run(spark, folders, layers=layers, location=place).ok
    (tmp_path / "extracts" / "SAP" / "MARDH.csv").unlink()
    again = load.run(spark, folders, layers=layers, location=place)
    failed = {o.table_name: o.error for o in again.failed}
    assert set(failed) == {
        "MARDH", "mardh", "fact_inventory_month_end_stock", "fact_inventory_monthly_snapshot"
    }
    assert "sap_mardh" in failed["mardh"]
    assert "mardh" in failed["fact_inventory_month_end_stock"]
    assert "fact_inventory_month_end_stock" in failed["fact_inventory_monthly_snapshot"]


def test_rows_are_counted_after_the_shuffle(spark, tmp_path):
    """The count sits in the stage that writes, whose tasks count once."""
    create_layers(spark, Layers("c_bronze", "c_silver", "c_gold"), str(tmp_path))
    df = spark.range(100).selectExpr("id", "id % 3 as part")
    seen = []
    original = type(df).observe

    def observe(frame, *args):
        seen.append(frame._jdf.queryExecution().optimizedPlan().toString())
        return original(frame, *args)

    type(df).observe = observe
    try:
        assert write_table(df, "c_gold.t", ["part"]) == 100
    finally:
        type(df).observe = original
    assert seen and "RebalancePartitions" in seen[0]


def test_registry():
    assert len(RULES) == 43
    assert sum(r.system == "SAP" for r in RULES) == 37
    assert sum(bool(r.keys) for r in RULES) == 32
    by_table = {r.table: r for r in RULES}
    assert by_table["demand_forecast"].raw_table == "ibp_demand_forcast"
    assert by_table["mch1"].dates == ("ERSDA", "HSDAT", "VFDAT")
