import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute, odd
from tristrata.llm import bpe, mixing
from tristrata.llm.shared import NumberedRows

PATH = public_tokenizers.path("byte_bpe_50k.json")


def sized(spark, sources, seed=1):
    rnd = random.Random(seed)
    rows = [
        (rnd.randrange(10**9), "w " * rnd.randrange(0, 40), "en", source, 0)
        for source, n in sources.items()
        for _ in range(n)
    ]
    return rows, odd.documents(spark, rows)


@pytest.mark.parametrize(
    "sources",
    [{"a": 300, "b": 300, "c": 300}, {"a": 20, "b": 900, None: 100, "Z": 10}, {"x": 50}, {"a": 1, "b": 400, "c": 2}],
)
def test_targets_and_takes(spark, sources):
    rows, docs = sized(spark, sources)
    got = mixing.mixed(docs)
    again = sorted(map(tuple, mixing.mixed(docs.repartition(7)).collect()))
    found = got.collect()
    assert sorted(map(tuple, found)) == again
    sizes, taken, largest = {}, {}, {}
    of = {r[0]: r[3] for r in rows}
    size = {r[0]: len(brute.words(r[1])) for r in rows}
    for r in found:
        s = of[r.doc_id]
        assert r.size == size[r.doc_id]
        assert r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        sizes[s] = sizes.get(s, 0) + r.size
        taken[s] = taken.get(s, 0) + r.taken
        largest[s] = max(largest.get(s, 0), r.size)
    want = brute.targets(sizes)
    for r in found:
        s = of[r.doc_id]
        assert r.source_size == sizes[s]
        assert r.target == pytest.approx(want[s])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]


def test_odd_documents_are_mixed(spark):
    docs = odd.documents(spark)
    rows = mixing.mixed(docs).collect()
    assert len(rows) == len(odd.ROWS)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    words = sum(len(brute.words(r.text)) for r in out.collect())
    assert words == sum(r.taken for r in rows)
    assert mixing.mixed(odd.documents(spark, [])).count() == 0
    assert mixing.mix(odd.documents(spark, [])).count() == 0


def test_large_source_tables_are_not_broadcast(spark, monkeypatch):
    _, docs = sized(spark, {"a": 50, "b": 60, None: 20})
    want = sorted(map(tuple, mixing.mixed(docs).collect()))
    monkeypatch.setattr(mixing, "TABLE_ROWS", 1)
    assert sorted(map(tuple, mixing.mixed(docs).collect())) == want


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(open(PATH, encoding="utf-8").read())


def texts():
    rnd = random.Random(4)
    letters = "abcdefghijklmnop 'ABC.,\n\t0123éüñß日本語🙂|*%\u0085​"
    out = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(80))) for _ in range(1500)]
    out += ["".join(rnd.choice("thein or") for _ in range(300)) for _ in range(200)]
    out += ["", " ", "a" * 5000, " " * 3000, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "<|endoftext", "can't we'll I'D"]
    return out + [f"{chr(c)}a{chr(c)}{chr(c)}" for c in (*range(0xD800), *range(0xE000, 0x11000, 7))]


def test_encoding_equals_the_library(library, own, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 5000)  # several tries
    cases = texts()
    for at in range(0, len(cases), 500):
        part = cases[at : at + 500]
        want = library.encode_batch(part, add_special_tokens=False)
        for text, packed, encoding in zip(part, own.encode_all(part), want):
            assert np.frombuffer(packed, "<u4").tolist() == encoding.ids
            assert own.decode(packed) == library.decode(encoding.ids, skip_special_tokens=False) == text


def test_every_token_encodes_to_itself(own):
    for token, i in own.ids.items():
        if len(token) > 1:
            a, b, _ = own.made_of[i]
            assert own.tokens[a] + own.tokens[b] == token


def test_encoded_documents(spark, library):
    rows = bpe.encoded(odd.documents(spark), PATH, keep_tokens=True).collect()
    want = []
    for doc_id, text, *_ in odd.ROWS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((doc_id, len(ids), brute.sha(np.array(ids, "<u4").tobytes()), brute.sha(decoded), ids, decoded))
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert bpe.encoded(odd.documents(spark, []), PATH).count() == 0


def test_decoding_replaces_broken_bytes(own, library):
    ids = library.encode("日本🙂", add_special_tokens=False).ids
    for n in range(len(ids)):
        packed = np.array(ids[:n], "<u4").tobytes()
        assert own.decode(packed) == library.decode(ids[:n], skip_special_tokens=False)


def test_sizes_count_words_as_named(spark):
    text = "a\x1cb c d\te"
    df = spark.createDataFrame([(text,)], "text string").select(mixing.n_words(F.col("text")).alias("n"))
    assert df.first().n == len(brute.words(text)) == 3


def test_rows_that_share_an_id_are_sampled_one_by_one(spark):
    """A third of a source's rows without an id, others under one id: about as many are taken twice as of the rest."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"text {i} of ten words " + "w " * 5, "en", "a", 0) for i in range(900)]
    rows += [(10_000 + i, "w " * 30, "en", "b", 0) for i in range(900)]
    found = [r for r in mixing.mixed(odd.documents(spark, rows)).collect() if r.size == 10]
    share = lambda own: sum(r.taken > r.size for r in own) / len(own)
    parts = [share([r for r in found if r.doc_id is None]), share([r for r in found if r.doc_id == 7])]
    assert len(found) == 900 and 0.2 < share(found) < 0.8 or share(found) in (0, 1)
    assert all(abs(p - share(found)) < 0.1 for p in parts)


@pytest.mark.parametrize("most", [1, 3, 5])
def test_numbered_rows_are_taken_as_often_as_said(spark, most):
    """Rows of many and of few partitions, some of them empty, with columns of the names that are used within."""
    docs = spark.range(0, 1000, 1, 7).selectExpr("id as doc_id", "id as told", "id as row_no", "id as times", "id as part_no")
    docs = docs.union(docs.where("doc_id < 0")).union(docs.where("doc_id % 200 = 3"))
    rows = NumberedRows(docs)
    given = rows.frame.select(F.col(rows.row).alias("row"), (F.col("doc_id") % (most + 1)).alias("times"))
    taken = rows.taken(given.where("times > 0"), most)
    got = sorted((r[0], r[-1]) for r in taken.collect())
    want = sorted((r.doc_id, r.doc_id % (most + 1)) for r in docs.collect() if r.doc_id % (most + 1))
    assert got == want and taken.columns[:-1] == docs.columns
    assert rows.taken(given.where("false")).count() == 0


def test_whole_rows_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = NumberedRows(odd.documents(spark))
        times = rows.frame.select(F.col(rows.row).alias("row"), F.lit(1).alias("times"))
        plan = rows.taken(times)._jdf.queryExecution().executedPlan().toString()
        join = plan[plan.index("ShuffledHashJoin") :]
        streamed = join[: join.index("FileScan")]
        assert "Exchange" not in streamed and "Sort" not in streamed
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
