from itertools import product

import pytest

from tristrata.operators import SkewPolicy, attach, as_dimension, attach_key, dimension_keys, hot_keys
from tristrata.operators.joins import _bytes
from tristrata.operators.skew import estimated_bytes
from tristrata.plans import facts

FORCED = SkewPolicy(broadcast_bytes=0, rows_per_task=10, buckets=16)
MANY = SkewPolicy(broadcast_bytes=0, rows_per_task=10, buckets=16, listed=1)


def brute(left, right, how):
    """Join (key, value) tuples by key; a None key matches nothing."""
    out = []
    for k, v in left:
        hits = [w for j, w in right if k is not None and j == k]
        out += [(k, v, w) for w in hits] or ([(k, v, None)] if how == "left" else [])
    return sorted(out, key=str)


LEFT_HOT = [("hot", i) for i in range(90)] + [("cold", 1), ("alone", 2)] + [(None, i) for i in range(40)]
RIGHT_HOT = [("hot", i) for i in range(70)] + [("cold", 5), ("other", 6), (None, 7)]
FEW = [("hot", 1), ("hot", 1), ("cold", 2), ("alone", 3), (None, 4)]


@pytest.mark.parametrize("policy", [FORCED, MANY], ids=["listed", "joined"])
@pytest.mark.parametrize("left, right, how", list(product([LEFT_HOT, FEW], [RIGHT_HOT, FEW], ["left", "inner"])))
def test_spread_join_equals_brute_force(spark, left, right, how, policy):
    lf = spark.createDataFrame(left, "k string, v int").repartition(5)
    rf = spark.createDataFrame(right, "k string, w int").repartition(3)
    out = attach(lf, rf, ["k"], how, policy)
    assert out.columns == ["k", "v", "w"]
    assert sorted(map(tuple, out.collect()), key=str) == brute(left, right, how)


def test_copies_of_one_row_are_spread(spark):
    """Rows that are all the same still leave for several tasks."""
    lf = spark.range(400, numPartitions=8).selectExpr("1 as k", "'same' as v")
    rf = spark.createDataFrame([(1, "x")], "k int, w string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = attach(lf, rf, ["k"], policy=FORCED)
        sizes = [n for n in out.rdd.mapPartitions(lambda p: [sum(1 for _ in p)]).collect() if n]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 400 and len(sizes) > 1


def test_hot_keys_are_exact(spark):
    df = spark.createDataFrame(
        [("a", 1)] * 50 + [("b", 1)] * 11 + [("b", 2)] * 10 + [(None, 3)] * 25, "x string, y int"
    )
    found = hot_keys(df, ["x", "y"], FORCED).collect()
    assert sorted(map(tuple, found), key=str) == [("a", 1, 50), ("b", 1, 11), (None, 3, 25)]
    assert hot_keys(df, ["x", "y"], SkewPolicy(rows_per_task=60)) is None


def test_a_small_share_is_hot_all_the_same(spark):
    """A key with less than a thousandth of its side, but more rows than a task is to have."""
    few = spark.range(30).selectExpr("-1L as k")
    df = spark.range(60_000).selectExpr("id as k").union(few)
    policy = SkewPolicy(broadcast_bytes=0, rows_per_task=20)
    assert hot_keys(df, ["k"], policy).collect() == [(-1, 30)]
    names = spark.createDataFrame([(-1, "hot"), (5, "cold")], "k bigint, name string")
    out = attach(df, names, ["k"], policy=policy)
    assert "__right_salt" in out._jdf.queryExecution().analyzed().toString()
    assert out.count() == 60_030 and out.where("name = 'hot'").count() == 30


@pytest.fixture
def counted(monkeypatch):
    """The keys of every counting pass."""
    passes = []

    def note(df, keys, policy):
        passes.append((tuple(df.columns), tuple(keys)))
        return None

    monkeypatch.setattr("tristrata.operators.skew.hot_keys", note)
    return passes


def frame(spark, columns):
    return spark.createDataFrame([tuple("1" for _ in columns.split())], ", ".join(f"{c} string" for c in columns.split()))


def test_inventory_counts_each_side_once(spark, counted):
    facts.inventory(
        frame(spark, "MATNR WERKS LGORT CHARG CLABS CUMLM CINSM CSPEM"),
        frame(spark, "MATNR WERKS LGORT LABST INSME SPEME"),
        frame(spark, "MATNR BWKEY VERPR STPRS PEINH BWTAR BKLAS"),
        frame(spark, "MATNR WERKS CHARG LBLAB"),
        policy=SkewPolicy(broadcast_bytes=-1),
    )
    assert [k for _, k in counted] == [("material_number", "plant"), ("material_number", "plant", "batch_number")]


def test_purchase_order_counts_no_joined_frame(spark, counted):
    facts.purchase_order(
        frame(spark, "EBELN BSART LIFNR EKORG EKGRP WAERS STATU BEDAT ERNAM AEDAT"),
        frame(spark, "EBELN EBELP MATNR BUKRS WERKS LGORT MATKL TXZ01 MEINS PSTYP MENGE NETPR"),
        frame(spark, "EBELN EBELP ETENR EINDT MENGE WEMNG"), frame(spark, "EBELN EBELP VGABE MENGE DMBTR"),
        frame(spark, "LIFNR NAME1"), frame(spark, "BUKRS BUTXT"), frame(spark, "WERKS NAME1"),
        frame(spark, "EKGRP EKNAM"), frame(spark, "EKORG EKOTX"), policy=SkewPolicy(broadcast_bytes=-1),
    )
    assert len(counted) == len(set(counted)) == 7
    assert {len(c) for c, _ in counted} == {len(facts.ORDER_HEADER), len(facts.ORDER_ITEM), len(facts.SCHEDULE_LINE)}


def test_keys_in_another_case(spark):
    df = spark.createDataFrame([(1, "a")], "Key int, v string")
    assert attach(df, df.withColumnRenamed("v", "w"), ["KEY"]).collect() == [(1, "a", "a")]


def test_unknown_sizes_are_large(spark):
    assert estimated_bytes(object()) > 1 << 60
    assert estimated_bytes(spark.range(3)) < 1 << 20


def test_unique_right_side(spark):
    lf = spark.createDataFrame(LEFT_HOT, "k string, v int")
    groups = spark.createDataFrame(FEW, "k string, w int").groupBy("k").agg({"w": "max"}).toDF("k", "w")
    out = attach(lf, groups, ["k"], policy=FORCED, unique=True)
    wanted = brute(LEFT_HOT, [tuple(r) for r in groups.collect()], "left")
    assert sorted(map(tuple, out.collect()), key=str) == wanted


def test_small_sides_are_not_counted(spark, monkeypatch):
    def fail(*_):
        raise AssertionError("counted")

    monkeypatch.setattr("tristrata.operators.skew.hot_keys", fail)
    df = spark.range(10).withColumnRenamed("id", "k")
    assert attach(df, df, ["k"]).count() == 10


def test_lookup_is_broadcast_within_the_limit(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    plan = attach(df, df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_key_types_must_agree(spark):
    with pytest.raises(ValueError, match="k is"):
        attach(spark.sql("select 1 k"), spark.sql("select '1' k"), ["k"])


@pytest.mark.parametrize("how", ["right", "full", "cross", "semi"])
def test_other_joins_are_refused(spark, how):
    df = spark.range(1)
    with pytest.raises(ValueError):
        attach(df, df, ["id"], how)


@pytest.mark.parametrize("text, size", [("10485760b", 10485760), ("-1", -1), ("10MB", 10 << 20),
                                        ("1g", 1 << 30), ("512k", 512 << 10), ("7", 7)])
def test_size_settings(text, size):
    assert _bytes(text) == size


def test_attach_key_keeps_the_grain(spark):
    dim = as_dimension(
        spark.createDataFrame([("s1", "o1", "m1"), ("s1", "o1", "m2"), ("s2", None, "m3")],
                              ["supplier", "org", "mail"]),
        "dim_supplier", ["supplier", "org"],
    )
    fact = spark.createDataFrame([(1, "s1", "o1"), (2, "s2", None), (3, "s9", "o1")], "n int, s string, o string")
    out = attach_key(fact, dim, "dim_supplier", {"S": "supplier", "o": "org"})
    assert out.columns == ["n", "s", "o", "dim_supplier_key"]
    keys = dimension_keys(dim, "dim_supplier", {"s": "supplier", "o": "org"})
    assert keys.columns == ["s", "o", "dim_supplier_key"] and keys.count() == 2
    got = {r.n: r.dim_supplier_key for r in out.collect()}
    known = {(r.supplier, r.org): r.dim_supplier_key for r in dim.collect()}
    assert got == {1: known["s1", "o1"], 2: None, 3: None}


@pytest.mark.parametrize("policy", [FORCED, MANY], ids=["listed", "joined"])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_keys_that_the_right_side_lacks(spark, how, policy):
    left = spark.createDataFrame([("gone", 1), ("hot", 2), ("alone", 3), (None, 4)], "k string, v int")
    counted = spark.createDataFrame([("gone", i) for i in range(50)] + [("hot", i) for i in range(50)], "k string, w int")
    right = counted.where("k = 'hot'")
    out = attach(left, right, ["k"], how, policy, right_keys_from=counted)
    wanted = brute([tuple(r) for r in left.collect()], [tuple(r) for r in right.collect()], how)
    assert sorted(map(tuple, out.collect()), key=str) == wanted


def test_lots_without_a_key_are_spread(spark):
    """Neither inspection lots nor decisions are cleansed by a key, so both are counted."""
    lots = spark.range(100).selectExpr("'1' as PRUEFLOS", *[f"'{c}' as {c}" for c in "MATNR WERK LIFNR EBELN EBELP ENSTEHDAT BUDAT".split()],
                                       "if(id % 2 = 0, '04', '01') as ART", "id as LOSMENGE", "id as GESSTICHPR")
    decisions = spark.range(3).selectExpr("'1' as PRUEFLOS", "cast(id as string) as VBEWERTUNG", "'d' as DBEWERTUNG", "'f' as VFOLGEAKTI",
                                          "'v' as VDATUM", "id as VAUSWAHLMG")
    for build, rows in ((facts.batch_release, 300), (facts.batch_release_external, 150)):
        out = build(lots, decisions, policy=FORCED)
        assert "__left_salt" in out._jdf.queryExecution().analyzed().toString()
        assert out.count() == rows


def test_small_sketches_find_every_hot_key(spark):
    """Fewer tracked keys than there are: hot keys are set aside, then buckets are added."""
    df = spark.range(20_000).selectExpr("if(id % 4 = 0, -(id % 3) - 1, id) as k")
    policy = SkewPolicy(broadcast_bytes=0, rows_per_task=60, buckets=1, tracked=32, listed=2)
    found = {r.k: r["__n"] for r in hot_keys(df, ["k"], policy).collect()}
    assert found == {-1: 1667, -2: 1667, -3: 1666}
    assert hot_keys(spark.range(20_000), ["id"], policy) is None
    assert hot_keys(spark.range(0), ["id"], policy) is None
