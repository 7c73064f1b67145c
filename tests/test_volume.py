"""What loads and plans shuffle, write and leave on disk."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.bindings import bind, bind_demand, demand_rows
from checks.queries import QUERIES
from checks.scratch import shared_folder
from tristrata.operators import SkewPolicy, attach, hot_keys, skew
from tristrata.operators.skew import measured_bytes
from tristrata.plans import facts
from tristrata.plans.outcomes import attempt_all
from tristrata.plans.silver import stock_buckets_for, stock_layouts
from tristrata.sources import create_layers, load_settings, store, store_split, write_table
from tristrata.sources.tables import LOAD_SETTINGS, Layers, location

COARSE = "spark.sql.requireAllClusterKeysForCoPartition"


@pytest.fixture
def layers(spark, tmp_path):
    layers = Layers("bronze_volume", "silver_volume", "gold_volume")
    create_layers(spark, layers, str(tmp_path / "layers"))
    yield layers
    for name in (layers.bronze, layers.silver, layers.gold):
        spark.sql(f"DROP DATABASE `{name}` CASCADE")


@pytest.fixture
def folder(spark, tmp_path):
    """Two hundred rows of each table."""
    ids = spark.range(200)
    i = F.col("id")
    text = {n: i.cast("string").alias(n) for n in ("c_name", "p_name", "p_type", "p_brand", "s_name")}
    made = {
        "customer": [i.alias("c_custkey"), text["c_name"], (i % 25).alias("c_nationkey")],
        "supplier": [
            i.alias("s_suppkey"), text["s_name"], (i % 25).alias("s_nationkey"), i.cast("double").alias("s_acctbal")
        ],
        "part": [i.alias("p_partkey"), text["p_name"], text["p_brand"], text["p_type"]],
        "orders": [
            i.alias("o_orderkey"), (i % 20).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
            i.cast("double").alias("o_totalprice"), F.lit("1-URGENT").alias("o_orderpriority"),
            F.lit("1996-01-02").cast("timestamp").alias("o_orderdate"),
        ],
        "lineitem": [
            (i % 150).alias("l_orderkey"), (i % 50).alias("l_partkey"), (i % 10).alias("l_suppkey"),
            (i % 7 + 1).cast("int").alias("l_linenumber"), i.cast("double").alias("l_quantity"),
            i.cast("double").alias("l_extendedprice"), F.lit(0.06).alias("l_discount"), F.lit(0.02).alias("l_tax"),
            F.lit("R").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
            F.lit("1996-03-04").cast("timestamp").alias("l_shipdate"),
        ],
    }
    for name, columns in made.items():
        ids.select(*columns).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


@pytest.fixture
def settings(spark):
    """No broadcasts; the session's own settings come back."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    for name in (COARSE, "spark.sql.autoBroadcastJoinThreshold"):
        spark.conf.unset(name)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {str(f) for d in disk.localDirs() for f in Path(d.getPath()).rglob("shuffle_*")}


def test_loads_leave_no_shuffle_files(spark, layers):
    grouped = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before, seen = shuffle_files(spark), {}

    def write(name):
        seen.update({k: spark.conf.get(k) for k in LOAD_SETTINGS})
        if name == "c":
            return store_split(grouped, {f"{layers.gold}.c": F.col("k") < 3})[f"{layers.gold}.c"]
        return store(grouped, f"{layers.gold}.{name}")

    own = {k: spark.conf.get(k) for k in LOAD_SETTINGS}
    outcomes = attempt_all(spark, {(n, "GOLD"): lambda n=n: write(n) for n in "abc"})
    assert [o.record_count for o in outcomes] == [7, 7, 3] and seen == LOAD_SETTINGS
    assert {k: spark.conf.get(k) for k in LOAD_SETTINGS} == own
    for _ in range(50):  # they go in the background
        if not shuffle_files(spark) - before:
            break
        spark.range(1).count()
    assert not shuffle_files(spark) - before


def test_settings_come_back_after_an_error(spark):
    own = {k: spark.conf.get(k) for k in LOAD_SETTINGS}
    with pytest.raises(ValueError), load_settings(spark):
        raise ValueError
    assert {k: spark.conf.get(k) for k in LOAD_SETTINGS} == own


def test_tables_are_packed(spark, layers):
    write_table(spark.range(10), f"{layers.gold}.packed")
    store_split(spark.range(10), {f"{layers.gold}.part": F.col("id") < 5})
    for name in ("packed", "part"):
        files = list(Path(location(spark, f"{layers.gold}.{name}").removeprefix("file:")).rglob("*.parquet"))
        assert files and all(".zstd." in f.name for f in files)


@pytest.mark.parametrize(("query", "shuffles"), [("fact_inventory", 6), ("fact_monthly_snapshot", 5)])
def test_stock_is_shuffled_once(spark, folder, settings, query, shuffles):
    """The stock once, by the keys that all its joins have, and what its partners are grouped and joined by."""
    plan = plan_of(QUERIES[query](spark, folder))
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == shuffles


def test_few_names_are_broadcast_whatever_their_estimate(spark, tmp_path):
    spark.range(50_000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("v")).write.parquet(
        str(tmp_path / "left")
    )
    left = spark.read.parquet(str(tmp_path / "left"))
    few = left.select((F.col("k").cast("int") % 3).cast("string").alias("k"), F.lit("y").alias("name")).distinct()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1k")
    try:
        assert measured_bytes(few) == 3 * (16 + 2 * 16 + 2)
        joined = attach(left, few, ["k"], unique=True, measured=True)
        assert "BroadcastHashJoin" in plan_of(joined) and joined.where("name is not null").count() == 3
        many = attach(left, left.withColumnRenamed("v", "name"), ["k"], unique=True, measured=True)
        assert "BroadcastHashJoin" not in plan_of(many)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert measured_bytes(few.limit(0)) == 0


def test_orders_are_counted_by_the_cheaper_frame(spark, settings):
    """Repeated records are dropped by the plan that is returned, not by the search for hot keys as well."""

    def frame(layout):
        return spark.range(5).select(*[F.col("id").cast("string").alias(c) for c in {f.source for f in layout}])

    raw = frame(facts.ORDER_ITEM)
    late = raw.withColumn("EBELN", F.when(F.rand() < 2, F.raise_error(F.lit("counted"))).otherwise(F.col("EBELN")))
    history = frame(facts.ORDER_HISTORY).withColumn("VGABE", F.lit("1"))
    layouts = (
        facts.SUPPLIER_NAME, facts.COMPANY_NAME, facts.PLANT_NAME, facts.GROUP_NAME, facts.ORG_NAME
    )
    rest = (frame(facts.SCHEDULE_LINE), history, *[frame(x) for x in layouts])
    header = frame(facts.ORDER_HEADER)
    built = facts.purchase_order(header, late, *rest, item_keys_from=raw)
    with pytest.raises(Exception, match="counted"):
        built.collect()
    whole = facts.purchase_order(header, raw, *rest, item_keys_from=raw)
    assert sorted(whole.drop("created_timestamp", "updated_timestamp").collect()) == sorted(
        facts.purchase_order(header, raw, *rest).drop("created_timestamp", "updated_timestamp").collect()
    )


def test_buckets_grow_with_the_stock(spark, folder):
    assert [stock_buckets_for(n) for n in (0, 3_200_000, 3_200_001, 400_000_000)] == [8, 8, 9, 1000]
    assert stock_layouts(stock_buckets_for(40_000_000))["mchb"].buckets == 100
    assert QUERIES["stock_buckets"](spark, folder).count() >= 200


def test_extracts_of_the_registry_are_packed(spark, folder):
    log = QUERIES["registry_run"](spark, folder).collect()
    assert len(log) == 86 and all(r.status == "SUCCESS" and r.record_count > 0 for r in log)
    raw = [r for r in log if r.layer == "raw"]
    assert all(r.record_count == 200 for r in raw)
    place = Path(re.sub("^file:", "", shared_folder(spark, "registry_run")))
    files = list(place.rglob("*.csv/part-*"))
    assert len(files) >= 43 and all(f.name.endswith(".csv.gz") for f in files)


def test_demand_is_worked_out_once(spark, folder):
    rows = demand_rows(spark, folder)
    rows.write.parquet(f"{folder}/demand_rows")
    staged = spark.read.parquet(f"{folder}/demand_rows")
    for name in ("demand_actual", "demand_forecast"):
        mine, whole = bind_demand(spark, name, staged), bind(spark, folder, name)[0]
        assert not re.search("Join|Aggregate", plan_of(mine)) and mine.dtypes == whole.dtypes
        assert sorted(mine.collect(), key=str) == sorted(whole.collect(), key=str) and mine.count() > 0


def test_keys_are_sketched_only_in_crowded_groups(spark, monkeypatch):
    ids = spark.range(20_000)
    assert hot_keys(ids, ["id"], SkewPolicy(rows_per_task=2)) is None  # all groups are crowded, no key is hot
    mixed = ids.select(F.when(F.col("id") < 700, -1).otherwise(F.col("id")).alias("k"))
    assert hot_keys(mixed, ["k"], SkewPolicy(rows_per_task=600)).collect() == [(-1, 700)]
    nulls = ids.select(F.when(F.col("id") >= 700, F.col("id")).alias("k"))
    assert hot_keys(nulls, ["k"], SkewPolicy(rows_per_task=600)).collect() == [(None, 700)]

    def fail(*args):
        raise AssertionError("sketched")

    monkeypatch.setattr(skew.F, "expr", fail)
    assert hot_keys(mixed, ["k"], SkewPolicy(rows_per_task=5000)) is None
    with pytest.raises(AssertionError, match="sketched"):
        hot_keys(mixed, ["k"], SkewPolicy(rows_per_task=600))
