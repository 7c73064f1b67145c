"""A corpus from raw documents to tokens, one operator after another.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all that the one before
kept; its result is written as Parquet and read again as the next one's documents. All but
the last return the columns of ``documents``, and more where they came with more, whatever those are called.
Null texts count as empty everywhere; texts of any length are read whole; an empty table goes through
as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.llm import bpe, exact_dedup, mixing, quality, simhash
from tristrata.llm.shared import new_index_name, read_table, ship, staged

TOKENIZER = "byte_bpe_50k.json"


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. Repeated rows stay or go together; an empty text has
    the score of the bias alone. Without labels the score is the same for all."""
    ship(spark)
    return quality.kept(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays, null being the smallest; of rows that repeat a
    doc_id as well, one."""
    index = exact_dedup.DigestIndex(spark, new_index_name())
    return exact_dedup.without_copies(docs, index)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id stays, null being the largest; of repeated
    rows one. Empty texts are one group."""
    ship(spark)
    return simhash.without_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: rows that repeat are sampled like others, empty texts are not
    taken, a null source is a source, ties in rank go by doc_id and size."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row of the mix, repeated ones included; an
    empty text has no tokens."""
    ship(spark)
    return bpe.encoded(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", good_quality),
    ("exact_dedup", first_copies),
    ("near_dedup", no_near_copies),
    ("mixing", mixed),
    ("bpe", tokens),
]

# A trained classifier, fingerprints and merges are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    return docs


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return run(spark, folder)


QUERIES = {"pipeline": pipeline}
