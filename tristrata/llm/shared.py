"""Folders and staged tables that every executor can see."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Spark hand this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    place = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(place, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(place))
    _SHIPPED.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; below the warehouse where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write a frame to shared storage and read it back: its work is done once, and a
    lost executor costs no more than the running tasks."""
    place = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def free_name(df: DataFrame, name: str) -> str:
    """A column name that no column of the frame has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def numbered(df: DataFrame, name: str, **more: Column) -> DataFrame:
    """The frame, staged, with a number for each row under ``name`` (and ``more`` columns): it
    tells repeated rows apart, and stays the same however often the frame is read."""
    return staged(df.withColumns(more | {name: F.monotonically_increasing_id()}))


# ``monotonically_increasing_id`` counts from zero in each partition, above this many bits is its number.
_IN_PART = 33


class NumberedRows:
    """A frame's rows, staged, with a number each under ``row``, and decisions about them by that number.

    The rows lie in buckets by the task that wrote them, so that whole rows stay where they are when decisions
    are joined to them: a task's decisions arrive as an array of a few bits a row.
    """

    def __init__(self, df: DataFrame, **more: Column):
        self.spark, self.columns = df.sparkSession, df.columns
        self.row, self.part = free_name(df, "row_no"), free_name(df, "part_no")
        rows = df.withColumns(more | {self.row: F.monotonically_increasing_id()})
        rows = rows.withColumn(self.part, F.shiftrightunsigned(self.row, _IN_PART))
        table = f"rows_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # A task writes to one bucket only, so its rows need no sorting for that.
        setting = "spark.sql.maxConcurrentOutputFileWriters"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, "1")
        try:
            writer = rows.write.option("path", shared_folder(self.spark)).option("compression", "zstd")
            writer.bucketBy(buckets, self.part).saveAsTable(table)
        finally:
            self.spark.conf.set(setting, before)
        self.frame = self.spark.table(table)

    def taken(self, times: DataFrame, most: int = 1) -> DataFrame:
        """The rows that ``times`` (``row, times``, each row once, 1 to ``most``) names, with the columns
        that the frame had and ``times``, under a name that no column has."""
        digits = range(most.bit_length())
        name, count = free_name(self.frame, "told"), free_name(self.frame, "times")
        word, bit = _place(F.col("row"))
        none = self.frame.select(F.col(self.row).alias("row"), F.lit(0).cast("bigint").alias("times"))
        every = none.union(times.select("row", F.col("times").cast("bigint")))
        digit = lambda d: F.shiftright("times", d).bitwiseAND(F.lit(1))
        # Rows without a decision make the words of 64 bits gapless from zero on.
        part = F.shiftrightunsigned("row", _IN_PART).alias(self.part)
        words = every.groupBy(part, word.alias("word")).agg(
            *[F.bit_or(F.call_function("shiftleft", digit(d), bit)).alias(f"digit{d}") for d in digits]
        )
        listed = F.sort_array(F.collect_list(F.struct("word", *[f"digit{d}" for d in digits])))
        told = words.groupBy(self.part).agg(listed.alias(name))
        met = self.frame.join(told.hint("shuffle_hash"), self.part)
        word, bit = _place(F.col(self.row))
        said = lambda d: F.call_function("shiftrightunsigned", F.col(name)[word][f"digit{d}"], bit)
        found = sum((F.shiftleft(said(d).bitwiseAND(F.lit(1)), d) for d in digits), F.lit(0))
        return met.select(*self.columns, found.cast("int").alias(count)).where(F.col(count) > 0)


def _place(row: Column) -> tuple[Column, Column]:
    """The word and the bit of a row's decision among those of its task."""
    offset = row.bitwiseAND(F.lit((1 << _IN_PART) - 1))
    return F.shiftright(offset, 6).cast("int"), offset.bitwiseAND(F.lit(63)).cast("int")


def new_index_name() -> str:
    """A table name that no other index has."""
    return f"digests_{uuid.uuid4().hex}"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
