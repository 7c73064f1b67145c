"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.llm import (
    bpe,
    exact_dedup,
    fill_in_middle,
    language,
    mixing,
    neighbours,
    personal_data,
    quality,
    quality_rules,
    simhash,
    spelling,
    substrings,
    toxicity,
)
from tristrata.llm.shared import new_index_name, read_table, ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    @wraps(run)
    def shipped(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return run(spark, folder)

    QUERIES[run.__name__] = shipped
    return shipped


@query
def op1_substrings(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(read_table(spark, folder, "documents"))


@query
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return quality.scored(docs, quality.fit(docs, read_table(spark, folder, "labels")))


@query
def op3_bpe(spark: SparkSession, folder: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.encoded(read_table(spark, folder, "documents"), tokenizer)


@query
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return language.identified(docs, language.fit(docs))


@query
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(read_table(spark, folder, "documents"))


@query
def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.find(read_table(spark, folder, "documents"))


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    return toxicity.graded(docs, toxicity.fit(docs, read_table(spark, folder, "labels")))


@query
def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = read_table(spark, folder, "embeddings")
    return neighbours.nearest_neighbours(vectors, F.col("vec_id") % 20 == 0)


@query
def op9_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, brought to a new index in two batches."""
    index = exact_dedup.DigestIndex(spark, new_index_name())
    return exact_dedup.group_in_batches(read_table(spark, folder, "documents"), index)


@query
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_copies(read_table(spark, folder, "documents"))


@query
def op11_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.rated(read_table(spark, folder, "documents"))


@query
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.transformed(read_table(spark, folder, "documents")))


@query
def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(read_table(spark, folder, "documents"))
