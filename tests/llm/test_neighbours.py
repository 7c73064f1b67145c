import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from tristrata.llm import neighbours

SCHEMA = "vec_id bigint, embedding array<float>, rank int, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "other") for i, v in rows], SCHEMA).repartition(3)


def vectors(n, width=16, seed=1):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(size=(12, width))
    found = centres[rnd.integers(12, size=n)] + 0.5 * rnd.normal(size=(n, width))
    return [(i, v.astype(np.float32).astype(float).tolist()) for i, v in enumerate(found)]


def search(spark, rows, **options):
    got = neighbours.nearest_neighbours(frame(spark, rows), F.col("vec_id") % 20 == 0, **options).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(found[r.query_id])
    return found


def test_recall_against_brute_force(spark):
    rows = vectors(3000)
    found = search(spark, rows, leaf_rows=64)
    ids, matrix = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    hits = total = 0
    for i in range(0, 3000, 20):
        want = brute.nearest(ids, matrix, i)
        hits += len({x for x, _ in want} & {x for x, _ in found[i]})
        total += len(want)
        for vec_id, score in found[i]:
            assert score == pytest.approx(matrix[i] @ matrix[vec_id], abs=1e-12)
    assert hits / total >= 0.9


def test_few_rows_copies_and_ties(spark):
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100 + i, [0.0, 1.0]) for i in range(5)] + [(0, [1.0, 0.0])]
    found = search(spark, rows)
    assert [v for v, _ in found[0]] == list(range(1, 21))
    assert [v for v, _ in found[20]] == list(range(20))
    assert [v for v, _ in found[100]] == [101, 102, 103, 104, *range(16)]
    assert search(spark, rows[:3])[0] == [(1, 1.0), (2, 1.0)]


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (20, [nan, nan])]
    assert search(spark, rows) == {0: [(1, 4.0)]}


def test_empty_and_single(spark):
    assert search(spark, []) == {}
    assert search(spark, [(0, [1.0])]) == {}


def test_traversal_visits_every_leaf_once():
    matrix = np.array([v for _, v in vectors(2000)])
    tree = neighbours.grow(matrix, 50)
    leaves = tree.visits(matrix[0], tree.leaves)
    assert sorted(leaves) == list(range(tree.leaves)) and tree.leaves > 20
    assert set(tree.assign(matrix).tolist()) <= set(leaves)


@pytest.mark.parametrize("scale", [1e-6, 1.0, 1e4, 1e8])
def test_ties_at_any_norm(spark, scale):
    """Scores that differ by rounding alone: the result is that of scores summed pair by pair."""
    rnd = np.random.default_rng(2)
    base = rnd.normal(size=48) * scale
    rows = [(i, (base * (1 + rnd.integers(-4, 5, 48) * 1.2e-16)).tolist()) for i in range(61)]
    wide = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = neighbours.nearest_neighbours(wide, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()
    found = {i: [(r.vec_id, r.score) for r in got if r.query_id == i] for i in range(0, 61, 20)}
    for i in found:
        mine = np.array(rows[i][1])
        score = {j: (mine * np.array(v)).sum() for j, v in rows if j != i}
        want = sorted(score, key=lambda j: (-score[j], j))[:20]
        assert [v for v, _ in found[i]] == want
