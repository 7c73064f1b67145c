import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm import odd
from tristrata.llm import language, quality, toxicity
from tristrata.llm.grams import texts_of, words_of
from tristrata.llm.sparse import Rows, sampled_rows

DATA = "/root/testdata/sf0.01"


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels")}


def accuracy(scored, truth, *keys):
    rows = scored.join(truth, "doc_id").where("held_out").select(*keys).collect()
    return np.mean([a == b for a, b in rows])


def test_quality_on_held_out_documents(tables):
    model = quality.fit(tables["documents"], tables["labels"])
    scored = quality.scored(tables["documents"], model)
    assert accuracy(scored, tables["labels"], "predicted", "quality") > 0.9
    rows = scored.collect()
    assert len(rows) == tables["documents"].count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_toxicity_on_held_out_documents(tables):
    model = toxicity.fit(tables["documents"], tables["labels"])
    scored = toxicity.graded(tables["documents"], model)
    assert accuracy(scored, tables["labels"], "predicted", "toxic") > 0.9
    for r in scored.collect():
        assert 0 <= r.score <= 1 and 0 <= r.severity <= 2 and r.predicted == int(r.score >= 0.5)


def test_long_texts_do_not_shorten_the_toxicity_sample(spark, monkeypatch):
    """60 texts with 4,000 indicators or more each; the fit has them all and equals that on all indicators."""
    rnd = random.Random(4)
    rows = []
    for i in range(60):
        words = ["".join(rnd.choices("abcdefghij", k=8)) for _ in range(1000)]
        rows.append((i, " ".join(words + ["vile"] * (i % 2) + ["kind"] * (1 - i % 2))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    marks = labels(spark, [(i, 1, i % 2) for i in range(60)])
    sizes = []
    plain = toxicity.fit_rows
    monkeypatch.setattr(toxicity, "fit_rows", lambda r, g: sizes.append((len(r), len(r.index))) or plain(r, g))
    model = toxicity.fit(docs, marks)
    kept = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 != 0]
    train = marks.where(F.col("doc_id").isin(kept)).select("doc_id", F.col("toxic").alias("label"))
    whole = sampled_rows(docs, train, toxicity.features, 60, 10**9)
    want = plain(whole, toxicity.severity_grades(whole))
    assert np.array_equal(model.weights, want.weights) and np.array_equal(model.thresholds, want.thresholds)
    assert sizes[0][0] == len(kept) and sizes[0][1] < len(whole.index) / 10


def test_language_on_held_out_documents(tables):
    docs = tables["documents"]
    found = language.identified(docs, language.fit(docs))
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows if r.held_out]) > 0.98
    for r in rows:
        assert 0 <= r.score <= 1
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def plain_bits(counts, text):
    """Code length of a text from nested counts, position by position."""
    bits = 0.0
    data = bytes(3) + text
    for i in range(3, len(data)):
        p, scale = None, 1.0
        for order in (3, 2, 1, 0):
            seen = counts.get(data[i - order : i], {})
            n, d = sum(seen.values()), len(seen)
            if data[i] in seen:
                p = scale * seen[data[i]] / (n + d)
                break
            if n:
                scale *= d / (n + d)
        bits -= np.log2(p if p is not None else scale / 256)
    return bits


def test_code_lengths_equal_plain_ppm():
    rnd = random.Random(1)
    train = {"x": [b"abracadabra", b"a cat"], "y": [b"\xc3\xa9t\xc3\xa9 aa", b"zzz"]}
    grams, trees = {}, {}
    for lang, texts in train.items():
        trees[lang] = {}
        for t in texts:
            data = bytes(3) + t
            for i in range(3, len(data)):
                key = lang, int.from_bytes(data[i - 3 : i + 1], "big")
                grams[key] = grams.get(key, 0) + 1
                for order in range(4):
                    seen = trees[lang].setdefault(data[i - order : i], {})
                    seen[data[i]] = seen.get(data[i], 0) + 1
    langs = sorted(train)
    keys = list(grams)
    model = language.build(
        langs,
        np.array([langs.index(k[0]) for k in keys]),
        np.array([k[1] for k in keys]),
        np.array([grams[k] for k in keys]),
    )
    texts = ["", "abra cat", "été zz", "QQ", "日本"] + ["".join(rnd.choice("abctz é") for _ in range(20)) for _ in range(20)]
    got = model.code_lengths(texts_of(pa.array(texts)))
    for i, text in enumerate(texts):
        for j, lang in enumerate(langs):
            assert got[i, j] == pytest.approx(plain_bits(trees[lang], text.encode()), rel=1e-4, abs=1e-4)


def nested_counts(text):
    counts = {}
    data = bytes(3) + text
    for i in range(3, len(data)):
        for order in range(4):
            seen = counts.setdefault(data[i - order : i], {})
            seen[data[i]] = seen.get(data[i], 0) + 1
    return counts


def noise(size, seed=1):
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    return "".join(random.Random(seed).choices(letters, k=size))


def test_code_lengths_with_many_contexts_equal_plain_ppm():
    text = noise(300_000)
    grams, n = np.unique(language._packed(texts_of(pa.array([text]))), return_counts=True)
    model = language.build(["x"], np.zeros(len(grams), int), grams.astype(np.int64), n)
    counts = nested_counts(text.encode())
    for piece in (text[:400], text[-400:], noise(400, seed=2)):
        got = model.code_lengths(texts_of(pa.array([piece])))[0, 0]
        assert got == pytest.approx(plain_bits(counts, piece.encode()), rel=1e-5)


def test_a_rare_language_keeps_its_statistics_beside_a_large_one(spark):
    """All of its counts are one, and over 400,000 of the other language's are larger."""
    large, rare = noise(450_000), "kia ora koutou katoa"
    rows = [(0, large, "x"), (1, large, "x"), (2, rare, "mi"), (5, rare, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = {r.doc_id: r for r in language.identified(docs, language.fit(docs)).collect()}
    assert [found[i].lang_pred for i in (0, 1, 2, 5)] == ["x", "x", "mi", "mi"]
    assert found[5].held_out and found[5].score > 0.99


def test_parts_of_the_model_agree_with_one(spark, tables, monkeypatch):
    docs = tables["documents"].limit(300).unionByName(tables["documents"].limit(3))
    docs = docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.substring("text", 1, 9)).otherwise(F.col("text")))
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    whole = language.fit(docs)
    monkeypatch.setattr(language, "PART_COUNTS", 1)
    parts = language.fit(docs)
    assert (len(whole), len(parts)) == (1, 4)
    a, b = (sorted(language.identified(docs, m).collect()) for m in (whole, parts))
    assert [r[:3] for r in a] == [r[:3] for r in b]
    assert np.allclose([r.score for r in a], [r.score for r in b], rtol=1e-9)


def test_language_of_odd_documents(spark):
    docs = odd.documents(spark)
    rows = language.identified(docs, language.fit(docs)).collect()
    assert len(rows) == len(odd.ROWS)
    letters = {(i, t) for i, t, *_ in odd.ROWS if any(c.isalpha() for c in t or "")}
    known = {i for i, _ in letters}
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id not in known)
    assert {r.lang_pred for r in rows} <= {"en", "de", "fr", "es", "und"}
    assert {r.lang_pred for r in language.identified(docs, None).collect()} == {"und"}


@pytest.mark.parametrize("known", [[], [(1, 1, 0)], [(1, 1, 0), (6, 0, 1), (7, 0, None), (None, 1, 1), (7, None, 1)]])
def test_classifiers_take_odd_documents(spark, known):
    docs, marks = odd.documents(spark), labels(spark, known)
    assert quality.scored(docs, quality.fit(docs, marks)).count() == len(odd.ROWS)
    kept = quality.kept(docs, quality.fit(docs, marks))
    assert kept.columns == docs.columns and kept.count() <= len(odd.ROWS)
    assert toxicity.graded(docs, toxicity.fit(docs, marks)).count() == len(odd.ROWS)


def test_empty_tables(spark):
    docs, marks = odd.documents(spark, []), labels(spark, [])
    assert quality.scored(docs, quality.fit(docs, marks)).count() == 0
    assert toxicity.graded(docs, toxicity.fit(docs, marks)).count() == 0
    assert language.identified(docs, language.fit(docs)).count() == 0


def test_held_out_labels_are_not_read(spark, tables):
    """Turning the held-out labels round changes no score."""
    docs = tables["documents"]
    turned = tables["labels"].withColumn(
        "quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    a = quality.fit(docs, tables["labels"])
    b = quality.fit(docs, turned)
    assert np.array_equal(a.weights, b.weights) and a.slope == b.slope


def test_dual_descent_parts_separable_rows():
    rows = Rows(np.arange(0, 9, 2), np.array([0, 2, 0, 3, 1, 2, 1, 3]), np.array([1, 1, 0, 0]))
    w, bias = quality.dual_descent(rows, np.ones(4), np.array([1.0, 1, -1, -1]), np.full(4, 10.0), rounds=200)
    margin = (w[[0, 0, 1, 1]] + w[[2, 3, 2, 3]]) / np.sqrt(2) + bias
    assert np.all(margin * [1, 1, -1, -1] > 0.99)
    assert abs(w[2]) < 1e-2 and abs(w[3]) < 1e-2


def test_ordinal_thresholds_are_ordered():
    rnd = np.random.default_rng(1)
    grades = rnd.integers(0, 3, 600)
    index = np.concatenate([[g, 3 + rnd.integers(4)] for g in grades])
    rows = Rows(np.arange(0, 1201, 2), index, (grades > 0).astype(int))
    model = toxicity.fit_rows(rows, grades)
    assert np.all(np.diff(model.thresholds) > 0)
    assert model.weights[0] < model.weights[1] < model.weights[2]


def test_words_are_split_at_the_named_bytes():
    texts = ["a b", "", "  x\ty\x0bz\x1cq ", "é日 a"]
    found = words_of(texts_of(pa.array(texts)))
    data = "".join(texts).encode()
    assert [data[a:b].decode() for a, b in zip(found.start, found.end)] == ["a", "b", "x", "y", "z\x1cq", "é日", "a"]
    assert found.text.tolist() == [0, 0, 2, 2, 2, 3, 3]
    assert found.hash[0] == found.hash[-1] and len(set(found.hash.tolist())) == 6


def test_labels_of_absent_documents_take_no_place(spark):
    """Many labels without a document, fewer rows wanted than there are labels."""
    docs = spark.createDataFrame([(i, f"text {i % 3} words") for i in range(50)], "doc_id bigint, text string")
    marks = labels(spark, [(i, i % 2, 0) for i in range(5000)]).select("doc_id", F.col("quality").alias("label"))
    assert len(sampled_rows(docs, marks, quality.features, 100)) == 50
    twice = labels(spark, [(1, 1, 0), (1, 0, 0), (2, 1, 0)]).select("doc_id", F.col("quality").alias("label"))
    assert sorted(sampled_rows(docs, twice, quality.features, 100).label.tolist()) == [0, 1, 1]


def test_long_texts_do_not_shorten_the_quality_sample(spark, tables, monkeypatch):
    """Few indicators allowed: features go, rows stay, and held-out documents are told apart."""
    sizes = []
    plain = quality.fit_rows
    monkeypatch.setattr(quality, "fit_rows", lambda r: sizes.append((len(r), len(r.index))) or plain(r))
    docs, marks = tables["documents"], tables["labels"]
    whole = quality.fit(docs, marks)
    few = quality.fit(docs, marks, entries=sizes[0][1] // 4)
    assert sizes[1][0] == sizes[0][0] and 0 < sizes[1][1] <= sizes[0][1] // 4
    found = quality.scored(docs, few).where("held_out").join(marks, "doc_id").collect()
    right = sum(r.predicted == r.quality for r in found)
    assert right > 0.9 * len(found)
    monkeypatch.setattr(quality, "affordable", lambda inside, outside, entries: np.ones(len(inside), bool))
    assert np.array_equal(quality.fit(docs, marks).weights, whole.weights)


def test_the_most_telling_features_are_kept():
    inside, outside = np.array([100, 50, 0, 3]), np.array([100, 1, 40, 3])
    use = quality.affordable(inside, outside, 91)
    assert use.tolist() == [False, True, True, False]
    assert quality.affordable(inside, outside, 10**6).all()


@pytest.mark.parametrize("room, letters", [(500, 100), (3_000, 10**6)])
def test_shards_of_a_language_agree_with_the_whole(spark, tables, monkeypatch, room, letters):
    """Languages of which some or all are dealt into shards."""
    docs = tables["documents"].limit(60).withColumn("text", F.substring("text", 1, letters))
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    whole = language.fit(docs)
    monkeypatch.setattr(language, "SHARD_COUNTS", room)
    parts = language.fit(docs)
    assert len(whole) == 1 and len(parts) > 2 and any(p.value.is_shard for p in parts)
    assert all(len(t.grams[3]) < 3 * language.SHARD_COUNTS for p in parts for t in p.value.trees)
    a, b = (sorted(language.identified(docs, m).collect()) for m in (whole, parts))
    assert [r[:3] for r in a] == [r[:3] for r in b]
    assert np.allclose([r.score for r in a], [r.score for r in b], rtol=1e-6)
