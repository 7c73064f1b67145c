import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute, odd
from tristrata.llm import exact_dedup, simhash, substrings
from tristrata.llm.components import components
from tristrata.llm.shared import new_index_name


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


def by_text(rows):
    return sorted(rows, key=lambda r: tuple(map(str, r)))


def passages(seed=3):
    """Documents that share passages of a few words more or less than a window."""
    rnd = random.Random(seed)
    stock = [[f"w{rnd.randrange(60)}" for _ in range(rnd.randrange(10, 40))] for _ in range(12)]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rnd.randrange(1, 5)):
            piece = rnd.choice(stock)
            a = rnd.randrange(max(len(piece) - 9, 1))
            parts += piece[a : a + rnd.randrange(5, 30)]
            parts += [f"own{rnd.randrange(10**6)}" for _ in range(rnd.randrange(4))]
        rows.append((rnd.randrange(120), rnd.choice([" ", "\n", "  "]).join(parts), "en", "s", 0))
    rows += [(500 + k, "a " * (10 + k), "en", "s", 0) for k in range(12)]
    return rows


@pytest.mark.parametrize("rows", [odd.ROWS, passages(), passages(4)], ids=["odd", "passages", "more"])
@pytest.mark.parametrize("buckets", [1, 5])
def test_substrings_equal_brute_force(spark, rows, buckets):
    got = substrings.without_repeats(odd.documents(spark, rows), buckets).collect()
    want = brute.without_repeats(pairs(rows))
    assert by_text(map(tuple, got)) == by_text(want)
    if rows is not odd.ROWS:
        assert sum(w[2] for w in want) > 100


def test_substrings_text_is_kept(spark):
    rows = [(1, "a b c d e f g h i j k l m tail"), (2, "head a b c d e f g h i j k l m end")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.kept_text for r in substrings.without_repeats(docs, 2, keep_text=True).collect()}
    assert got == {1: rows[0][1], 2: "head end"}


def test_substrings_buckets_follow_the_bytes_of_text(spark, monkeypatch):
    def sizes(keep_text):
        def run(key, table, sent):
            size = sum(len(t.as_py()) for t in table.column("text"))
            return pa.table({"doc_id": [0], "n_words": [size], "n_removed": [0], "kept_sha256": [""]})

        return run

    monkeypatch.setattr(substrings, "BUCKET_BYTES", 2_000, raising=False)
    monkeypatch.setattr(substrings, "_locate", sizes)
    docs = spark.createDataFrame([(i, f"{i:0100d}") for i in range(400)], "doc_id bigint, text string")
    found = [r.n_words for r in substrings.without_repeats(docs).collect()]
    assert sum(found) == 40_000 and max(found) <= 3 * 2_000


def test_substrings_of_a_document_with_the_id_minus_one(spark):
    shared = "a b c d e f g h i j k l m"
    docs = spark.createDataFrame([(-1, f"{shared} tail"), (4, f"head {shared} end")], "doc_id bigint, text string")
    got = {r.doc_id: r.n_removed for r in substrings.without_repeats(docs.coalesce(1), 1).collect()}
    assert got == {-1: 0, 4: 13}


def test_exact_copies_equal_brute_force(spark):
    index = exact_dedup.DigestIndex(spark, new_index_name(), 3)
    got = exact_dedup.group_copies(odd.documents(spark), index).collect()
    want = brute.copies(pairs(odd.ROWS))
    assert by_text((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == by_text(want)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_index_outlasts_a_batch(spark):
    index = exact_dedup.DigestIndex(spark, new_index_name(), 2)
    schema = "doc_id bigint, text string"
    first = spark.createDataFrame([(1, "a"), (2, "A"), (3, "b")], schema)
    assert sorted(r.doc_id for r in exact_dedup.without_copies(first, index).collect()) == [2, 3]
    again = exact_dedup.DigestIndex(spark, index.table, 2)
    later = spark.createDataFrame([(9, "a"), (10, "c"), (11, "c")], schema)
    assert [r.doc_id for r in exact_dedup.without_copies(later, again).collect()] == [11]
    assert again.entries().count() == 3


def test_index_is_not_shuffled(spark):
    """The anti-join meets the buckets without an exchange of the index."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = exact_dedup.DigestIndex(spark, new_index_name(), 4)
        fresh = spark.range(10).selectExpr("sha2(string(id), 256) as hex").selectExpr("unhex(hex) as digest").distinct()
        joined = fresh.join(index.entries().select("digest").hint("merge"), "digest", "left_anti")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def near_rows(seed=1):
    rnd = random.Random(seed)
    vocabulary = [f"word{i}" for i in range(300)]
    rows = []
    for i in range(25):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randrange(200, 500))]
        for _ in range(rnd.randrange(1, 7)):
            text = list(base)
            for _ in range(rnd.randrange(3)):
                text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
            rows.append((rnd.randrange(10**6), " ".join(text), "en", "s", 0))
    return rows


@pytest.mark.parametrize("rows", [odd.ROWS, near_rows(), near_rows(2)], ids=["odd", "near", "more"])
def test_near_copies_equal_brute_force(spark, rows):
    got = simhash.near_copies(odd.documents(spark, rows)).collect()
    want = brute.near_copies(pairs(rows))
    assert by_text(map(tuple, got)) == by_text(want)


def test_one_of_each_near_group_stays(spark):
    rows = near_rows() + near_rows()[:5]
    docs = odd.documents(spark, rows)
    out = simhash.without_near_copies(docs)
    assert out.columns == docs.columns
    want = {c for _, _, c in brute.near_copies(pairs(rows))}
    assert sorted(r.doc_id for r in out.collect()) == sorted(want)


@pytest.mark.parametrize("cell_rows", [4096, 3])
def test_links_connect_crowded_cells(spark, cell_rows):
    """Fingerprints close together, in one cell or dealt into chunks."""
    rnd = random.Random(9)
    marks = set()
    for _ in range(6):
        centre = rnd.getrandbits(64)
        for _ in range(40):
            mark = centre
            for _ in range(rnd.randrange(6)):
                mark ^= 1 << rnd.randrange(64)
            marks.add(mark)
    marks = sorted(m - (1 << 64) if m >> 63 else m for m in marks)
    values = spark.createDataFrame([(m,) for m in marks], "fp bigint")
    found = components(simhash.links(values, cell_rows=cell_rows)).collect()
    label = {r.node: r.label for r in found}
    roots = brute.connected(marks, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3)
    assert [label.get(m, m) for m in marks] == [marks[r] for r in roots]


def test_grids_lose_no_pair():
    """Any two fingerprints within the distance are equal under the mask of some grid."""
    rnd = random.Random(2)
    unsigned = [m & (1 << 64) - 1 for m in simhash.grid_masks()]
    odd_bits = 0x5555555555555555
    counts = lambda x: (x & odd_bits) ^ (x >> 1 & odd_bits) | (x & x >> 1 & odd_bits) << 1
    for _ in range(500):
        a = b = rnd.getrandbits(64)
        for bit in rnd.sample(range(64), 3):
            b ^= 1 << bit
        assert any(counts(a) & m == counts(b) & m for m in unsigned)


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 9), (9, 9), (20, 21), (22, 21)] + [(100 + i, 101 + i) for i in range(30)]
    found = components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()
    assert {r.node: r.label for r in found} == (
        {2: 1, 3: 1, 4: 1, 10: 9, 21: 20, 22: 20} | {101 + i: 100 for i in range(30)}
    )


@pytest.mark.parametrize("clashing", [True, False])
def test_empty_tables(spark, clashing):
    docs = odd.documents(spark, [], clashing)
    assert substrings.without_repeats(docs, 2).count() == 0
    assert simhash.near_copies(docs).count() == 0
    assert simhash.without_near_copies(docs).count() == 0
    index = exact_dedup.DigestIndex(spark, new_index_name(), 2)
    assert exact_dedup.group_copies(docs, index).count() == 0
    assert exact_dedup.without_copies(docs, index).count() == 0


def test_the_largest_id_is_no_null(spark):
    shared = "a b c d e f g h i j k l m"
    rows = [(2**63 - 1, f"{shared} tail"), (None, f"own {shared}"), (3, f"{shared} end")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r.n_removed for r in substrings.without_repeats(docs, 2).collect()}
    assert got == {2**63 - 1: 13, None: 13, 3: 0}


@pytest.mark.parametrize("batches", [1, 2, 3, 7])
def test_batches_give_what_one_load_gives(spark, batches):
    """Copies within a batch and across batches, rows without an id last."""
    rows = odd.ROWS + [(i, f"Text {i % 4}", "en", "a", 6) for i in range(20, 60)]
    index = exact_dedup.DigestIndex(spark, new_index_name(), 3)
    got = exact_dedup.group_in_batches(odd.documents(spark, rows), index, batches).collect()
    want = brute.copies(pairs(rows))
    assert by_text((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == by_text(want)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == index.entries().count()
    assert min(batches, 2) <= index.last_batch() <= batches
    assert exact_dedup.group_in_batches(odd.documents(spark, []), exact_dedup.DigestIndex(spark, new_index_name(), 2)).collect() == []


def test_a_second_load_is_met_by_the_index(spark):
    index = exact_dedup.DigestIndex(spark, new_index_name(), 2)
    schema = "doc_id bigint, text string"
    first = spark.createDataFrame([(1, "a"), (2, "b")], schema)
    assert all(r.kept for r in exact_dedup.group_copies(first, index).collect())
    later = spark.createDataFrame([(9, "A"), (10, "c"), (11, "c")], schema)
    for group in (exact_dedup.group_copies, exact_dedup.group_in_batches):
        got = {r.doc_id: (r.keep_id, r.kept) for r in group(later, index).collect()}
        assert got == {9: (1, False), 10: (11, False), 11: (11, group is exact_dedup.group_copies)}


def test_manhattan_distance_is_a_lower_bound():
    rnd = np.random.default_rng(1)
    a, b = (rnd.integers(0, 1 << 63, 500, np.uint64) for _ in range(2))
    b[:250] = a[:250] ^ (np.uint64(1) << rnd.integers(0, 64, 250, np.uint64))
    counts = [[(v >> 2 * s & 3).bit_count() for s in range(32)] for v in (*a.tolist(), *b.tolist())]
    plain = [sum(abs(x - y) for x, y in zip(p, q)) for p, q in zip(counts[:500], counts[500:])]
    packed = np.bitwise_count(simhash.unary_counts(a) ^ simhash.unary_counts(b))
    assert packed.tolist() == plain
    assert all(m <= h for m, h in zip(plain, np.bitwise_count(a ^ b).tolist()))
