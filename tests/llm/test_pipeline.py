import corpus_pipeline
from tests.llm import brute, odd
from tristrata.llm.shared import staged

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = staged(stage(spark, docs, DATA))
        seen[name] = (before.collect(), docs.collect())
        if name != "bpe":
            assert docs.columns == COLUMNS
    pairs = lambda rows: [(r.doc_id, r.text) for r in rows]
    before, after = seen["quality"]
    assert 0 < len(after) <= len(before) and set(pairs(after)) <= set(pairs(before))
    before, after = seen["exact_dedup"]
    assert sorted(r.doc_id for r in after) == sorted({k for _, k, _, _ in brute.copies(pairs(before))})
    before, after = seen["near_dedup"]
    assert sorted(r.doc_id for r in after) == sorted({c for _, _, c in brute.near_copies(pairs(before))})
    before, after = seen["mixing"]
    sizes = {}
    for r in before:
        sizes[r.source] = sizes.get(r.source, 0) + len(brute.words(r.text))
    want = brute.targets(sizes)
    for source in sizes:
        taken = sum(len(brute.words(r.text)) for r in after if r.source == source)
        largest = max(len(brute.words(r.text)) for r in before if r.source == source)
        assert abs(taken - want[source]) <= largest
    before, after = seen["bpe"]
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before)
    texts = {r.doc_id: brute.sha(r.text) for r in before}
    assert all(r.decoded_sha256 == texts[r.doc_id] for r in after)


def test_run_is_registered(spark):
    rows = corpus_pipeline.QUERIES["pipeline"](spark, DATA)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and rows.count() > 0


def test_stages_take_odd_and_empty_documents(spark):
    for rows in (odd.ROWS, []):
        docs = odd.documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            out = staged(stage(spark, docs, DATA))
            if name != "bpe":
                assert out.columns == docs.columns
                docs = out
        assert out.count() == docs.count()
