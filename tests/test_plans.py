"""Physical plans: what reaches the scan, what is shuffled, and how often."""

import re

import pytest
from pyspark.sql import functions as F

from tristrata.operators import blanks_to_null, null_counts, without_metadata
from tristrata.plans import dimensions, facts


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def stored(spark, tmp_path):
    """Write a frame of the given columns and read it back."""

    def store(name, columns, key=None):
        df = spark.range(50).select(
            *[(F.col("id") % 5 if c == key else F.col("id")).cast("string").alias(c) for c in columns.split()]
        )
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    return store


@pytest.fixture
def stock(stored):
    return (
        stored("mchb", "MATNR WERKS LGORT CHARG CLABS CUMLM CINSM CSPEM EXTRA"),
        stored("mard", "MATNR WERKS LGORT LABST INSME SPEME"),
        stored("mbew", "MATNR BWKEY VERPR STPRS PEINH BWTAR BKLAS"),
        stored("mslb", "MATNR WERKS CHARG LBLAB"),
    )


def test_only_needed_columns_are_read(stock):
    plan = plan_of(facts.inventory(*stock))
    assert "EXTRA" not in plan and plan.count("FileScan") == 4


def test_coarse_key_first_lets_joins_share_a_shuffle(spark, stock, no_broadcast):
    setting = "spark.sql.requireAllClusterKeysForCoPartition"
    assert plan_of(facts.inventory(*stock)).count("Exchange hashpartitioning") == 6
    spark.conf.set(setting, "false")
    try:
        assert plan_of(facts.inventory(*stock)).count("Exchange hashpartitioning") == 4
    finally:
        spark.conf.unset(setting)


def test_small_lookups_are_not_shuffled(stock):
    assert "Exchange hashpartitioning" not in plan_of(facts.inventory(*stock))


def test_inspection_type_reaches_the_scan(stored):
    lots = stored(
        "qals", "PRUEFLOS MATNR WERK LIFNR EBELN EBELP ART ENSTEHDAT BUDAT LOSMENGE GESSTICHPR"
    )
    decisions = stored("qave", "PRUEFLOS VBEWERTUNG DBEWERTUNG VFOLGEAKTI VDATUM VAUSWAHLMG")
    plan = plan_of(facts.batch_release_external(lots, decisions))
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(ART,04\)", plan)


def test_movement_type_reaches_the_scan_and_sums_are_partial(stored, no_broadcast):
    history = stored("ekbe", "EBELN EBELP VGABE MENGE DMBTR EXTRA", key="VGABE")
    plan = plan_of(facts.delivered(history))
    assert "EqualTo(VGABE,1)" in plan and "partial_sum" in plan and "EXTRA" not in plan


def test_distinct_is_partial_before_its_shuffle(stored):
    plan = plan_of(dimensions.unit(stored("mara", "MATNR MEINS")))
    assert plan.count("HashAggregate") == 2 and "IsNotNull(MEINS)" in plan


def test_every_text_is_trimmed_once(stored):
    df = stored("raw", "a b c _file")
    plan = plan_of(blanks_to_null(without_metadata(df)))
    assert plan.count("trim(") == 3 and "_file" not in plan


def test_null_profile_is_one_scan(stored):
    assert plan_of(null_counts(stored("raw", "a b c"))).count("FileScan") == 1


def test_headers_and_items_are_named_before_they_are_joined(stored, no_broadcast):
    header = stored("ekko", "EBELN BSART LIFNR EKORG EKGRP WAERS STATU BEDAT ERNAM AEDAT")
    item = stored("ekpo", "EBELN EBELP MATNR BUKRS WERKS LGORT MATKL TXZ01 MEINS PSTYP MENGE NETPR")
    plan = plan_of(
        facts.purchase_order(
            header, item,
            stored("eket", "EBELN EBELP ETENR EINDT MENGE WEMNG"),
            stored("ekbe", "EBELN EBELP VGABE MENGE DMBTR"),
            stored("lfa1", "LIFNR NAME1"), stored("t001", "BUKRS BUTXT"),
            stored("t001w", "WERKS NAME1"), stored("t024", "EKGRP EKNAM"), stored("t024e", "EKORG EKOTX"),
        )
    )
    inner = plan.index("Inner")
    assert plan.count("LeftOuter") == 7
    # Schedule and deliveries sit above the inner join, the five lookups below it.
    assert plan[:inner].count("LeftOuter") == 2
    # Deliveries are grouped by the join's own keys: one shuffle serves both.
    assert plan.count("Exchange hashpartitioning(purchase_order") + plan.count(
        "Exchange hashpartitioning(EBELN"
    ) == 5
