"""Overwriting tables: what is in place before, after and when something fails on the way."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from erp import write_extracts
from tristrata.plans import facts, load
from tristrata.plans.gold import build_gold
from tristrata.plans.outcomes import attempt, attempt_all, outcome_log
from tristrata.plans.registry import KEYED, Rule, is_unique, keyed_tables
from tristrata.plans.silver import stock_layouts
from tristrata.sources import (
    Layers,
    Layout,
    create_layers,
    drop_table,
    readable_rows,
    recorded,
    settle,
    store,
    store_split,
    write_table,
)
from tristrata.sources import tables as module
from tristrata.sources.tables import FRESH, RETIRED, location

AS_OF = datetime(2024, 6, 1, 12, 0, 0)


@pytest.fixture
def layers(spark, tmp_path, request):
    name = f"x{abs(hash(request.node.name))}"
    found = Layers(f"{name}_bronze", f"{name}_silver", f"{name}_gold")
    create_layers(spark, found, str(tmp_path / "layers"))
    return found


@pytest.fixture
def table(layers):
    return f"{layers.gold}.t"


def numbers(spark, start, end):
    return spark.range(start, end).selectExpr("id", "id % 3 as part")


def broken(df):
    return df.withColumn("id", F.when(F.col("id") % 10 == 7, F.raise_error(F.lit("broken")).cast("bigint")).otherwise(F.col("id")))


def ids(spark, table):
    return sorted(r.id for r in spark.table(table).collect())


def left_over(spark, table):
    return [s for s in (FRESH, RETIRED) if spark.catalog.tableExists(table + s)]


def test_a_failed_write_leaves_the_old_table(spark, table):
    store(numbers(spark, 0, 9), table, Layout(["part"]))
    for replace in (False, True):
        with pytest.raises(Exception, match="broken"):
            write_table(broken(numbers(spark, 0, 100)).select(F.col("id").alias("other")), table, replace=replace)
        assert ids(spark, table) == list(range(9))
        assert spark.table(table).columns == ["id", "part"]
        assert spark.sql(f"SHOW PARTITIONS {table}").count() == 3
        assert left_over(spark, table) == []
    assert write_table(numbers(spark, 20, 25).select("id"), table) == 5
    assert ids(spark, table) == list(range(20, 25)) and spark.table(table).columns == ["id"]


def test_a_failed_first_write_leaves_nothing(spark, table):
    with pytest.raises(Exception, match="broken"):
        write_table(broken(numbers(spark, 0, 100)), table)
    assert not settle(spark, table) and readable_rows(spark, table) == (False, None)
    assert write_table(numbers(spark, 0, 4), table) == 4


def test_readers_of_the_old_table_can_finish(spark, table):
    store(numbers(spark, 0, 9), table)
    reader = spark.table(table)
    store(numbers(spark, 50, 52), table)
    assert reader.count() == 9 and ids(spark, table) == [50, 51]


def test_a_table_can_be_made_of_itself(spark, table):
    store(numbers(spark, 0, 9), table)
    for _ in range(4):
        store(spark.table(table).withColumn("id", F.col("id") + 1), table)
    assert ids(spark, table) == list(range(4, 13))


@pytest.mark.parametrize("layout", [Layout(), Layout(["part"]), Layout(buckets=3, bucket_by=["part"])])
def test_a_run_that_dies_between_the_steps_is_settled(spark, table, layout, monkeypatch):
    """Whichever step of the swap is the last one that happens."""
    store(numbers(spark, 0, 9), table, layout)
    rename = module._rename
    for steps, wanted in ((0, list(range(9))), (1, list(range(20, 25)))):
        done = []

        def dying(*args):
            if len(done) == steps:
                raise KeyboardInterrupt
            done.append(args)
            rename(*args)

        monkeypatch.setattr(module, "_rename", dying)
        with pytest.raises(KeyboardInterrupt):
            store(numbers(spark, 20, 25), table, layout)
        monkeypatch.setattr(module, "_rename", rename)
        assert settle(spark, table) and left_over(spark, table) == []
        assert ids(spark, table) == wanted
        assert readable_rows(spark, table) == (True, len(wanted))
    store(numbers(spark, 0, 3), table, layout)
    assert ids(spark, table) == [0, 1, 2]


def test_only_the_old_table_is_left(spark, table):
    store(numbers(spark, 0, 9), table)
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}{RETIRED}")
    assert settle(spark, table) and ids(spark, table) == list(range(9))


def test_a_table_written_by_other_means_is_replaced(spark, table):
    numbers(spark, 0, 3).write.saveAsTable(table)
    assert recorded(spark, table) is None and readable_rows(spark, table) == (True, None)
    assert write_table(numbers(spark, 5, 7), table) == 2
    assert ids(spark, table) == [5, 6] and recorded(spark, table).rows == 2


def test_dropping_frees_the_folder(spark, table, tmp_path):
    df = numbers(spark, 0, 5000)
    store(df, table)
    store(df, table)
    drop_table(spark, table)
    drop_table(spark, table)
    assert not spark.catalog.tableExists(table)
    assert store(numbers(spark, 0, 2), table).rows == 2 and ids(spark, table) == [0, 1]


def test_what_was_counted_stays_with_the_table(spark, table):
    df = spark.createDataFrame(
        [(1, None, "x", "m"), (None, None, "it's \\ \"q\"", "m")], "`a b` int, b string, `c'd` string, _meta string"
    )
    written = store(df, table, profile=True)
    assert written == recorded(spark, table)
    assert (written.rows, written.nulls) == (2, {"a b": 1, "b": 2, "c'd": 0})
    df.write.insertInto(table)
    assert recorded(spark, table) is None
    wide = spark.range(3).select(*[F.lit(None).cast("int").alias(f"a_long_column_name_{i}") for i in range(400)])
    assert store(wide, table, profile=True) == recorded(spark, table)


def test_buckets_need_no_shuffle(spark, layers):
    for name, part in (("l", 3), ("r", 5)):
        df = spark.range(100).selectExpr("id", f"id % {part} as v")
        store(df, f"{layers.gold}.{name}", Layout(buckets=4, bucket_by=["id"]))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = (spark.table(f"{layers.gold}.{n}") for n in "lr")
        joined = left.join(right.withColumnRenamed("v", "w"), "id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100 and "Exchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_split_in_one_pass(spark, layers):
    targets = {f"{layers.gold}.{n}": F.col("part") == i for i, n in enumerate(("zero", "one", "none"))}
    targets[f"{layers.gold}.none"] = F.col("part") > 5
    df = numbers(spark, 0, 10)
    for _ in range(3):
        found = store_split(df, targets)
        assert [w.rows for w in found.values()] == [4, 3, 0]
        assert [ids(spark, t) for t in targets] == [[0, 3, 6, 9], [1, 4, 7], []]
        assert all(spark.table(t).columns == ["id", "part"] for t in targets)
        assert recorded(spark, f"{layers.gold}.one").rows == 3
    # One of them, written alone in between, does not touch the files of the others.
    for _ in range(3):
        store(numbers(spark, 0, 2), f"{layers.gold}.zero")
        assert ids(spark, f"{layers.gold}.one") == [1, 4, 7]
    assert [w.rows for w in store_split(df, targets).values()] == [4, 3, 0]
    with pytest.raises(Exception, match="broken"):
        store_split(broken(df), targets)
    assert [ids(spark, t) for t in targets] == [[0, 3, 6, 9], [1, 4, 7], []]


def test_outcomes_say_what_is_left(spark, layers):
    target = f"{layers.gold}.t"
    store(numbers(spark, 0, 9), target)

    def fail():
        store(broken(numbers(spark, 0, 100)), target)

    failed = attempt("t", "X", fail, spark, target)
    assert (failed.status, failed.readable, failed.readable_rows) == ("FAILED", "OLD", 9)
    absent = attempt("u", "X", fail, spark, f"{layers.gold}.u")
    assert (absent.readable, absent.readable_rows) == ("NONE", None)
    done = attempt("t", "X", lambda: store(numbers(spark, 0, 2), target, profile=True), spark, target)
    assert (done.readable, done.readable_rows, done.null_counts) == ("NEW", 2, {"id": 0, "part": 0})
    outcomes = attempt_all(
        spark, {("t", "X"): fail, ("after", "X"): fail}, needs={"after": ["t"]}, targets={("t", "X"): target}
    )
    assert [(o.readable, o.readable_rows) for o in outcomes] == [("OLD", 2), (None, None)]
    log = {r.table_name: r for r in outcome_log(spark, [failed, absent, done]).collect()}
    assert log["u"].readable == "NONE" and log["t"].null_counts == {"id": 0, "part": 0}


def test_a_second_load_says_what_is_old(spark, tmp_path, layers):
    folders = write_extracts(tmp_path / "extracts")
    place = str(tmp_path / "layers")
    assert load.run(spark, folders, layers=layers, location=place, as_of=AS_OF).ok
    (tmp_path / "extracts" / "SAP" / "MARDH.csv").unlink()
    again = load.run(spark, folders, layers=layers, location=place, as_of=AS_OF)
    left = {o.table_name: (o.readable, o.readable_rows) for o in again.failed}
    assert left == {
        "MARDH": ("OLD", spark.table(f"{layers.bronze}.sap_mardh").count()),
        "mardh": ("OLD", spark.table(f"{layers.silver}.mardh").count()),
        "fact_inventory_month_end_stock": ("OLD", 3),
        "fact_inventory_monthly_snapshot": ("OLD", 2),
    }


@pytest.fixture
def no_scan(monkeypatch):
    def scan(*_):
        raise AssertionError("scanned")

    monkeypatch.setattr("tristrata.plans.load.check_table", scan)
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.count", scan)


def test_checks_and_summaries_after_a_load_scan_nothing(spark, tmp_path, layers, no_scan):
    folders = write_extracts(tmp_path / "extracts")
    result = load.run(spark, folders, layers=layers, location=str(tmp_path / "layers"), as_of=AS_OF)
    mara = load.check_raw(spark, layers=layers)["sap_mara"]
    assert (mara.rows, mara.columns, mara.nulls["PSTAT"]) == (3, 13, 3)
    clean = load.check_cleansed(spark, layers=layers)
    assert clean["mara"].nulls == {"MATNR": 0, "MTART": 0, "MATKL": 0, "MEINS": 1, "VPSTA": 1}
    facts_ = {r.fact_table: r.record_count for r in load.summarize_facts(spark, layers).collect()}
    assert facts_["fact_inventory"] == 4 and len(facts_) == 8
    assert next(o for o in result.bronze if o.table_name == "MARA").null_counts["PSTAT"] == 3


def test_the_batch_releases_are_built_in_one_pass(spark, tmp_path, layers, monkeypatch):
    folders = write_extracts(tmp_path / "extracts")
    assert load.run(spark, folders, layers=layers, location=str(tmp_path / "layers"), as_of=AS_OF).ok
    built = []
    original = facts.batch_release
    monkeypatch.setattr(facts, "batch_release", lambda *a, **k: built.append(a) or original(*a, **k))
    outcomes = {o.table_name: o.record_count for o in build_gold(spark, layers, as_of=AS_OF)}
    assert len(built) == 1
    assert outcomes["fact_batch_release_external"] == 2 and outcomes["fact_batch_release_internal"] == 1
    split = {"fact_batch_release_internal": ["inspection_type"]}
    again = {o.table_name: o.record_count for o in build_gold(spark, layers, as_of=AS_OF, partitions=split)}
    assert len(built) == 1 and again == outcomes


def test_stock_joins_on_buckets_shuffle_nothing(spark, tmp_path, layers):
    folders = write_extracts(tmp_path / "extracts")
    load.run(
        spark, folders, layers=layers, location=str(tmp_path / "layers"), as_of=AS_OF, layouts=stock_layouts(4)
    )
    settings = {
        "spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for build, names in (
            (facts.inventory, "mchb mard mbew mslb"), (facts.month_end_stock, "mchbh mardh mbewh")
        ):
            fact = build(*[spark.table(f"{layers.silver}.{n}") for n in names.split()])
            plan = fact._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and fact.count() in (3, 4)
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_uniqueness_is_proved_by_the_rules():
    assert is_unique("mbew", facts.VALUATION, facts.PLANT_KEYS)
    assert is_unique("mard", facts.LOCATION_STOCK, facts.LOCATION_KEYS)
    assert not is_unique("mard", facts.LOCATION_STOCK, facts.PLANT_KEYS)
    assert not is_unique("mslb", facts.SPECIAL_STOCK, facts.BATCH_KEYS)
    assert not is_unique("qals", facts.INSPECTION_LOT, ["inspection_lot"])
    assert is_unique("qals", facts.INSPECTION_LOT, ["inspection_lot"], {"qals": ("prueflos",)})
    # A key that is cast may merge values.
    assert not is_unique("mchbh", facts.PERIOD, ["fiscal_year"], {"mchbh": ("LFGJA",)})
    assert keyed_tables([Rule("SAP", "A", "a", ("K",)), Rule("SAP", "B", "b")]) == {"a": ("K",)}
    assert len(KEYED) == 32


def test_schemas_merge(spark, table):
    """Old columns first, absent ones NULL, types as wide as both; names in any case."""
    store(spark.sql("select 1 a, cast(1.5 as float) f, 'x' gone, date'2024-01-01' d"), table)
    store(spark.sql("select timestamp'2024-02-02 01:00:00' d, 2.5D F, 3L A, true fresh"), table, merge_schema=True)
    found = spark.table(table)
    assert found.dtypes == [
        ("a", "bigint"), ("f", "double"), ("gone", "string"), ("d", "timestamp"), ("fresh", "boolean")
    ]
    assert [tuple(r) for r in found.collect()] == [(3, 2.5, None, datetime(2024, 2, 2, 1), True)]
    with pytest.raises(ValueError, match="a was bigint and is string"):
        store(spark.sql("select 'text' a"), table, merge_schema=True)
    assert spark.table(table).count() == 1
    store(spark.sql("select 'text' a"), table)
    assert spark.table(table).dtypes == [("a", "string")]


def test_a_column_that_an_extract_loses_stays(spark, tmp_path, layers):
    folder, place = tmp_path / "SAP", str(tmp_path / "layers")
    folder.mkdir()
    rules = [Rule("SAP", "A", "a", ("K",))]
    for text in ("K,V,W\n1,x,y\n", "W,K,N\n5,2,z\n"):
        (folder / "A.csv").write_text(text)
        outcome = load.run(spark, {"SAP": str(folder)}, rules, layers, location=place, as_of=AS_OF)
        assert all(o.ok for o in outcome.bronze + outcome.silver)
    for database, name in ((layers.bronze, "sap_a"), (layers.silver, "a")):
        found = spark.table(f"{database}.{name}")
        assert [c for c in found.columns if not c.startswith("_")] == ["K", "V", "W", "N"]
        assert found.select("K", "V", "W", "N").collect() == [("2", None, "5", "z")]
    load.run(spark, {"SAP": str(folder)}, rules, layers, location=place, as_of=AS_OF, merge_schema=False)
    assert [c for c in spark.table(f"{layers.silver}.a").columns if not c.startswith("_")] == ["W", "K", "N"]


def test_location_is_outside_of_the_table_name(spark, table):
    store(numbers(spark, 0, 1), table)
    first = location(spark, table)
    store(numbers(spark, 0, 1), table)
    assert first.endswith("/t--a") and location(spark, table).endswith("/t--b")
