"""Exact de-duplication against a persistent digest index.

The index is a table bucketed and sorted by digest. New rows are grouped by their
digest, met with the index by a sort-merge anti-join that does not shuffle the
index, and what is new is appended.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tristrata.llm.shared import NumberedRows, free_name, numbered

INDEX_SCHEMA = "digest binary, keep_id bigint, keep_row bigint, group_size bigint, batch int"


def normalised(text: Column) -> Column:
    """A-Z in lower case and nothing else changed; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def digest_of(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(text), 256))


class DigestIndex:
    """Digests of all texts seen so far, with the row that was kept for each.

    The table lives in the session's catalog, in ``buckets`` buckets of sorted files
    (default: the session's shuffle partitions). Every ``add`` appends one sorted file to a
    bucket; choose ``buckets`` for the size that the index is to reach.
    """

    def __init__(self, spark: SparkSession, table: str, buckets: int | None = None):
        self.spark, self.table = spark, table
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        if not spark.catalog.tableExists(table):
            self._append(spark.createDataFrame([], INDEX_SCHEMA))

    def _append(self, rows: DataFrame) -> None:
        # One task a bucket, so that a bucket gets one file from each batch.
        dealt = rows.repartition(self.buckets, "digest")
        dealt.write.bucketBy(self.buckets, "digest").sortBy("digest").mode("append").saveAsTable(
            self.table
        )

    def entries(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def last_batch(self) -> int:
        return self.entries().agg(F.coalesce(F.max("batch"), F.lit(0))).first()[0]

    def add(self, digests: DataFrame) -> None:
        """Index a batch of ``doc_id, digest, row_no``. Of equal digests within the batch the
        largest doc_id stays; a digest that is indexed already keeps its first entry."""
        fresh = (
            digests.groupBy("digest")
            .agg(
                F.max(F.struct("doc_id", F.negate("row_no").alias("back"))).alias("kept"),
                F.count(F.lit(1)).alias("group_size"),
            )
            .select(
                "digest",
                F.col("kept.doc_id").alias("keep_id"),
                F.negate("kept.back").alias("keep_row"),
                "group_size",
                F.lit(self.last_batch() + 1).alias("batch"),
            )
        )
        known = self.entries().select("digest").hint("merge")
        self._append(fresh.join(known, "digest", "left_anti"))


def group_copies(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Null and empty texts are equal. Of rows that repeat a text and a doc_id, one is kept;
    a null doc_id sorts below all others. An empty table gives no rows. Rows whose text an earlier batch brought are not kept.
    Other columns of ``docs`` play no part. Adaptive skew handling spreads a large group of
    copies over tasks; no text is shuffled.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), digest_of(F.col("text")).alias("digest"))
    digests = numbered(rows, "row_no")
    before = index.last_batch()
    index.add(digests)
    # A computed key hides the buckets: with a shuffle on both sides a large group can be split.
    return _judged(digests, index.entries().withColumn("digest", F.concat("digest", F.lit(b""))), before)


def group_in_batches(docs: DataFrame, index: DigestIndex, batches: int = 2) -> DataFrame:
    """The same of documents that are brought to an index in several batches, those with the largest
    ids first and those without an id last: what a batch shares with an earlier one is
    met by the anti-join and not indexed again. ``group_size`` counts the copies of all batches.

    An empty table gives no rows. Where the batches are cut does not change the result.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), digest_of(F.col("text")).alias("digest"))
    digests = numbered(rows, "row_no")
    before = index.last_batch()
    shares = [1 - i / batches for i in range(1, batches)]
    cuts = digests.agg(F.percentile_approx("doc_id", shares) if shares else F.array()).first()[0] or []
    upper = F.lit(True)
    for cut in cuts:
        index.add(digests.where(upper & (F.col("doc_id") > cut)))
        upper = F.col("doc_id") <= cut
    index.add(digests.where(F.coalesce(upper, F.lit(True))))
    sizes = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    first = index.entries().select("digest", "keep_id", "keep_row", "batch")
    groups = sizes.join(first, "digest").withColumn("digest", F.concat("digest", F.lit(b"")))
    return _judged(digests, groups, before)


def _judged(digests: DataFrame, groups: DataFrame, before: int) -> DataFrame:
    return digests.join(groups, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        ((F.col("row_no") == F.col("keep_row")) & (F.col("batch") > before)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``docs`` that stay, each once and with all its columns: one row of each text
    that the index does not have, by the rules of ``group_copies``. A load that dies after its texts
    were indexed must be run again with a new index, as its own texts are known by then. One writer at a time."""
    digest = free_name(docs, "digest")
    rows = NumberedRows(docs, **{digest: digest_of(F.col("text"))})
    before = index.last_batch()
    index.add(
        rows.frame.select(
            F.col("doc_id").cast("bigint"), F.col(digest).alias("digest"), F.col(rows.row).alias("row_no")
        )
    )
    fresh = index.entries().where(F.col("batch") > before)
    keep = fresh.select(F.col("keep_row").alias("row"), F.lit(1).alias("times"))
    return rows.taken(keep).select(*docs.columns)
