"""Quality rules, fill-in-middle and spelling variants against brute force."""

import random
from collections import Counter

import numpy as np

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm import brute, odd
from tristrata.llm import fill_in_middle, quality_rules, spelling

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def plain(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def in_order(rows):
    return sorted(map(tuple, rows), key=str)


EMPTY = "doc_id bigint, text string, lang string, source string, n_chars bigint"


# Quality rules


def votes_as_numbers(votes):
    return [[{"b": -1, "-": 0, "g": 1}[c] for c in row] for row in votes]


def test_rules_equal_brute_force(docs, plain):
    out = quality_rules.rated(docs).collect()
    wanted = {i: brute.measures(t) for i, t in plain}
    assert {r.doc_id: tuple(r[1:6]) for r in out} == wanted
    quality = brute.label_model(votes_as_numbers(r.votes for r in out))
    for r, q in zip(out, quality):
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and r.quality == pytest.approx(q, abs=1e-6)
        assert r.kept == (not failed and q >= 0.5)


def test_rules_part_labelled_documents(spark):
    """Labels are no input; they tell good from poor documents among those that pass the hard rule."""
    folder = "/root/testdata/sf0.01"
    rated = quality_rules.rated(spark.read.parquet(f"{folder}/documents.parquet")).drop("quality")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = Counter(
        (r.quality, r.kept) for r in rated.where("not base_failed").join(labels, "doc_id").collect()
    )
    assert found[1, True] > 0.98 * (found[1, True] + found[1, False])
    assert found[0, False] > 0.9 * (found[0, True] + found[0, False])


def test_rules_on_odd_documents(spark):
    docs = odd.documents(spark)
    out = quality_rules.rated(docs).collect()
    wanted = [(i, *brute.measures(t)) for i, t, *_ in odd.ROWS]
    assert in_order(r[:6] for r in out) == in_order(wanted)
    assert not any(r.kept for r in out if r.n_words < 50)
    found = quality_rules.measured(docs)
    kept = quality_rules.without_poor(docs, quality_rules.fit(found))
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.kept for r in out)


def test_rules_on_an_empty_table(spark):
    empty = spark.createDataFrame([], EMPTY)
    assert quality_rules.rated(empty).collect() == []
    model = quality_rules.fit(quality_rules.measured(empty))
    assert quality_rules.without_poor(empty, model).collect() == []
    assert model.base == pytest.approx(np.log(4))


def test_kept_documents_are_those_that_are_judged_good(docs):
    found = quality_rules.measured(docs)
    model = quality_rules.fit(found)
    good = {r.doc_id for r in quality_rules.judged(found, model).where("kept").collect()}
    assert {r.doc_id for r in quality_rules.without_poor(docs, model).collect()} == good


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab \n\t#|é \x0b\x1c.", max_size=60))
def test_measures(text):
    assert quality_rules.measures(text.encode())[:5] == brute.measures(text)


def test_long_texts_have_exact_windows():
    ws = [b"w%d" % (i % 997) for i in range(5000)]
    assert quality_rules.repeated_words(ws) == 5000
    ws = [b"v%d" % i for i in range(5000)]
    assert quality_rules.repeated_words(ws) == 0
    assert quality_rules.repeated_words([*ws, *ws[10:13]]) == 6


def test_useless_rules_say_nothing():
    """A rule that votes as a coin does is worth nothing, one that is always right decides."""
    draw = random.Random(3)
    rows = Counter(
        ("b" if bad else "g") * 2 + draw.choice("bg") for bad in (draw.random() < 0.3 for _ in range(4000))
    )
    model = quality_rules.fit_patterns(list(rows), list(rows.values()))
    assert abs(model.bad[2]) < 0.2 and abs(model.good[2]) < 0.2
    assert model.bad[0] < -3 and model.good[0] > 1


# Fill-in-middle


def test_middle_equals_brute_force(docs, plain):
    out = fill_in_middle.transformed(docs)
    assert in_order(out.collect()) == in_order((i, *brute.fill_in_middle(i, t)) for i, t in plain)
    back = out.select("doc_id", fill_in_middle.restored(F.col("output"), F.col("form")).alias("text"))
    assert in_order(back.collect()) == in_order(plain)
    assert {r.form for r in out.collect()} == {"plain", "psm", "spm"}


def test_middle_of_odd_documents(spark):
    more = [(100 + i, t, "en", "a", 1) for i, t in enumerate(
        ["<P>", "a<S>b", "x<M>", "<", "<P", "P>", "><", "<<P", "S><M", "\x00\n", "é" * 3, "🙂a🙂", "ab" * 100_000]
    )]
    rows = odd.ROWS + more
    out = fill_in_middle.transformed(odd.documents(spark, rows))
    assert in_order(out.collect()) == in_order((r[0], *brute.fill_in_middle(r[0], r[1])) for r in rows)
    for r in fill_in_middle.digests(out).collect():
        assert r.restored_sha256 in {brute.sha(t or "") for i, t, *_ in rows if i == r.doc_id}
    assert fill_in_middle.digests(fill_in_middle.transformed(spark.createDataFrame([], EMPTY))).collect() == []


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10_000), st.text(alphabet="aB<>PSM é\n🙂", max_size=12))
def test_middle_of_texts_with_pieces_of_marks(doc_id, text):
    assert fill_in_middle.rewrite(doc_id, text) == brute.fill_in_middle(doc_id, text)


def test_marks_are_found_where_they_were_put(spark):
    """Texts made of pieces of marks come back whole."""
    draw = random.Random(5)
    texts = ["".join(draw.choices(["<", ">", "P", "S", "M", "a", "<P", "S>"], k=draw.randint(0, 9))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = fill_in_middle.transformed(docs, plain_share=0, spm_share=50)
    back = out.select("doc_id", fill_in_middle.restored(F.col("output"), F.col("form")).alias("text"))
    assert in_order(back.collect()) == in_order(enumerate(texts))
    forms = Counter(r.form for r in out.collect())
    assert forms["psm"] > 100 and forms["spm"] > 100


# Spelling variants


def test_variants_equal_brute_force(docs, plain):
    out = spelling.variants(docs).select("word", "form", "root", "n", "n_near", "form_n")
    assert in_order(out.collect()) == in_order(brute.variants(brute.spellings(plain)))


@pytest.fixture(scope="module")
def words():
    """Many near words, chains of forms and ties, letters of all kinds and some long words."""
    draw = random.Random(11)
    found = {}
    for _ in range(40):
        word = "".join(draw.choices("abcdeÀß÷ÿé", k=draw.randint(6, 9)))
        n = 5
        for _ in range(draw.randint(1, 12)):
            found.setdefault(word, n)
            at = draw.randrange(len(word))
            word = draw.choice([
                word[:at] + word[at + 1 :] + "a", word[:at] + draw.choice("abé") + word[at:],
                word[:at] + draw.choice("abÿ") + word[at + 1 :], word[:at] + word[at + 1 :],
            ])
            n = draw.choice([n, n * 5, n + 1])
    found |= {"ab" * 2000: 9, "ab" * 2000 + "c": 90, "ab" * 1999 + "ac": 9, "anagram": 5, "ragmana": 50}
    return found


@pytest.mark.parametrize(
    "blocks", [{}, {"classes": 1}, {"classes": 3, "block_words": 2}, {"classes": 2, "block_words": 7, "block_bytes": 50}]
)
def test_blocks_of_any_size_give_the_same(spark, words, blocks):
    """However the words are dealt: every word meets each near word once."""
    frame = spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)
    out = spelling.grouped(frame, **blocks).select("word", "form", "root", "n", "n_near", "form_n")
    assert in_order(out.collect()) == in_order(brute.variants(words))


def test_a_crowd_of_near_words(spark):
    """One block with all words, all of them near one hub."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    crowd = {"zzzzzzz": 10_000} | {"zzzzzzz"[:i] + c + "zzzzzzz"[i + 1 :]: 7 for i in range(7) for c in letters[:-1]}
    frame = spark.createDataFrame(list(crowd.items()), "word string, n bigint")
    out = spelling.grouped(frame, block_words=16).select("word", "form", "root", "n", "n_near", "form_n")
    assert in_order(out.collect()) == in_order(brute.variants(crowd))


def test_long_chains_of_forms(spark):
    chain = {"abcdef" + "g" * i: 5 ** (i + 1) for i in range(20)}
    frame = spark.createDataFrame(list(chain.items()), "word string, n bigint")
    roots = {r.word: r.root for r in spelling.grouped(frame).collect()}
    assert set(roots.values()) == {"abcdef" + "g" * 19}


def test_variants_of_odd_documents(spark):
    more = [(i, "Straße straße STRASSE naïve×naïve ABCDEFÉ abcdefÉ " * 3, "de", "a", 1) for i in range(20, 320)]
    rows = odd.ROWS * 3 + more
    out = spelling.variants(odd.documents(spark, rows), least_count=2).select(
        "word", "form", "root", "n", "n_near", "form_n"
    )
    wanted = brute.variants(brute.spellings([r[:2] for r in rows], least=2))
    assert in_order(out.collect()) == in_order(wanted)
    assert spelling.variants(spark.createDataFrame([], EMPTY)).collect() == []
    assert spelling.variants(odd.documents(spark, odd.ROWS[2:5])).collect() == []


def test_runs_of_a_long_text_are_counted_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "RUNS_AT_ONCE", 7)
    monkeypatch.setattr(spelling, "OPEN_WORDS", 5)
    rows = [(i, " ".join(f"{'xyzuvw'[k % 6] * 6}{'abcdefgh'[k % 8]}" for k in range(500))) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.word: r.n for r in spelling.occurrences(docs).where("n >= 5").collect()}
    assert found == brute.spellings(rows)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.text(alphabet="abé", min_size=5, max_size=5), min_size=1, max_size=5, unique=True),
    st.lists(st.text(alphabet="abé", min_size=5, max_size=6), min_size=1, max_size=6, unique=True),
)
def test_near_pairs(own, other):
    i, j = spelling.near_pairs([w.encode("latin-1") for w in own], [w.encode("latin-1") for w in other], 2)
    wanted = [(a, b) for a, x in enumerate(own) for b, y in enumerate(other) if brute.one_edit(x, y)]
    assert sorted(zip(i.tolist(), j.tolist())) == wanted
