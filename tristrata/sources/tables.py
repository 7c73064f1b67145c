"""Layer databases and their tables.

A table is written beside the one that it replaces and takes its name when it is complete, so a load that
fails leaves rows, schema and partitions as they were. Its files lie in one of three folders
next to each other (``<table>--a``, ``--b``, ``--c``), each load taking one that no table reads: nothing is
copied or moved by the swap, which renames catalog entries, and jobs that run on the old table can finish. What was counted while a table was written is kept among its properties and swaps with it.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tristrata.functions.text import quoted
from tristrata.operators.schema import data_columns

TABLE_FORMAT = "parquet"
# A table lies in storage twice and is read a few times, so its size counts more than its writing.
COMPRESSION = "zstd"
# What a load needs of its session. Joins whose keys have some in common share one shuffle by these, and a
# write's shuffle files go with it: otherwise those of a whole load stay until the driver collects garbage.
LOAD_SETTINGS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
SLOTS = "abc"
# What a table in place is called that is complete but not yet in place, or on its way out.
FRESH, RETIRED = "__fresh", "__retired"
RECORD = "tristrata.record"
# Some catalogs bound the length of a property.
RECORD_PART = 3000
_OWN_FOLDER = re.compile(rf"--[{SLOTS}](/load_target=\d+)?/?$")


@dataclass(frozen=True)
class Layers:
    """Database names of the three layers."""

    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    def comments(self) -> dict[str, str]:
        return {
            self.bronze: "Raw extracts with load metadata",
            self.silver: "Cleansed and de-duplicated tables",
            self.gold: "Star schema of dimensions and facts",
        }


@contextmanager
def load_settings(spark: SparkSession) -> Iterator[None]:
    """Run loads under ``LOAD_SETTINGS``; they change no result. The session's own come back afterwards."""
    before = {name: spark.conf.get(name, None) for name in LOAD_SETTINGS}
    try:
        for name, value in LOAD_SETTINGS.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def create_layers(
    spark: SparkSession, layers: Layers = Layers(), location: str | None = None
) -> list[str]:
    """Create the layer databases, below ``location`` where given, and list all databases."""
    for name, comment in layers.comments().items():
        place = f" LOCATION '{location.rstrip('/')}/{name}'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` COMMENT '{comment}'{place}")
    return [d.name for d in spark.catalog.listDatabases()]


def use_layer(spark: SparkSession, name: str) -> None:
    """Make a layer the one that unqualified table names refer to."""
    spark.catalog.setCurrentDatabase(name)


@dataclass(frozen=True)
class Written:
    """What was counted while a table was written."""

    rows: int
    bad: int = 0
    nulls: dict[str, int] | None = None


def _split(spark: SparkSession, table: str) -> tuple[str, str]:
    *database, name = table.replace("`", "").split(".")
    return (database[-1] if database else spark.catalog.currentDatabase()), name


def _entry(spark: SparkSession, table: str, suffix: str = "") -> str:
    database, name = _split(spark, table)
    return f"`{database}`.`{name}{suffix}`"


def _exists(spark: SparkSession, table: str, suffix: str = "") -> bool:
    return spark.catalog.tableExists(_entry(spark, table, suffix))


def location(spark: SparkSession, table: str, suffix: str = "") -> str | None:
    """The folder that a table's files lie in."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {_entry(spark, table, suffix)}").collect()
    return next((r.data_type for r in rows if r.col_name == "Location"), None)


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop a table and empty the folders of its loads."""
    for suffix in ("", FRESH, RETIRED):
        if _exists(spark, table, suffix):
            place = location(spark, table, suffix)
            frame = spark.table(_entry(spark, table, suffix)).limit(0)
            spark.sql(f"DROP TABLE {_entry(spark, table, suffix)}")
            if place and _OWN_FOLDER.search(place):
                _emptied(frame, place)


def _emptied(frame: DataFrame, place: str) -> None:
    """Spark has no command that deletes the files of an external table, but writes over them."""
    frame.sparkSession.createDataFrame([], frame.schema).write.mode("overwrite").parquet(place)


def settle(spark: SparkSession, table: str) -> bool:
    """Finish or undo what a run that died left of a swap; whether the table is there then.

    A fresh table without one in place was about to take its place and is complete. A fresh one beside
    it belongs to a load that did not get that far, and goes."""
    if not _exists(spark, table):
        left = next((s for s in (FRESH, RETIRED) if _exists(spark, table, s)), None)
        if left is None:
            return False
        _rename(spark, table, left, "")
    for suffix in (FRESH, RETIRED):
        spark.sql(f"DROP TABLE IF EXISTS {_entry(spark, table, suffix)}")
    return True


def readable_rows(spark: SparkSession, table: str) -> tuple[bool, int | None]:
    """Whether a table can be read, and its rows if those were recorded; runs no job."""
    if not settle(spark, table):
        return False, None
    known = recorded(spark, table)
    return True, known and known.rows


def _rename(spark: SparkSession, table: str, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {_entry(spark, table, old)} RENAME TO {_entry(spark, table, new)}")


def _swap(spark: SparkSession, table: str) -> None:
    """Put the fresh table in place. Whatever happens between these steps, ``settle`` can go on."""
    if _exists(spark, table):
        _rename(spark, table, "", RETIRED)
    _rename(spark, table, FRESH, "")
    spark.sql(f"DROP TABLE IF EXISTS {_entry(spark, table, RETIRED)}")


def _slot(spark: SparkSession, tables: Sequence[str]) -> str:
    """A folder for a new load of some tables that none of them reads. Where a run died between the
    swaps of two tables, these read different loads; a third folder is free even then."""
    database, _ = _split(spark, tables[0])
    name = "--".join(_split(spark, t)[1] for t in tables)
    used = [f"{location(spark, t)}/" for t in tables if _exists(spark, t)]
    free = next(s for s in SLOTS if not any(f"/{name}--{s}/" in u for u in used))
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/{name}--{free}"


def _files(df: DataFrame) -> str:
    """A digest of the names of a table's files."""
    names = sorted(f.rsplit("/", 1)[-1] for f in df.inputFiles())
    return hashlib.sha1("\n".join(names).encode()).hexdigest()


def _note(spark: SparkSession, table: str, written: Written) -> None:
    """Keep what was counted with the fresh table."""
    entry = _entry(spark, table, FRESH)
    found = {"files": _files(spark.table(entry)), "rows": written.rows, "bad": written.bad, "nulls": written.nulls}
    text = json.dumps(found).encode().hex()
    parts = [text[i : i + RECORD_PART] for i in range(0, len(text), RECORD_PART)]
    pairs = ", ".join(f"'{RECORD}.{i}' = '{part}'" for i, part in enumerate(parts))
    spark.sql(f"ALTER TABLE {entry} SET TBLPROPERTIES ({pairs})")


def recorded(spark: SparkSession, table: str) -> Written | None:
    """What was counted when a table was written, read from the catalog without a job. Nothing where the
    table was not written by this module, or has had files added or taken away since."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {_entry(spark, table)}").collect()
    parts = {r.key.rsplit(".", 1)[-1]: r.value for r in rows if r.key.startswith(f"{RECORD}.")}
    if not parts:
        return None
    found = json.loads(bytes.fromhex("".join(parts[k] for k in sorted(parts, key=int))))
    if found["files"] != _files(spark.table(_entry(spark, table))):
        return None
    return Written(found["rows"], found["bad"], found["nulls"])


@dataclass(frozen=True)
class Layout:
    """How a table's files are laid out: folders by partition columns, or sorted buckets.

    Tables that are joined by their bucket columns, with equal numbers of buckets, need no shuffle."""

    partition_by: Sequence[str] = ()
    buckets: int = 0
    bucket_by: Sequence[str] = ()

    def arranged(self, df: DataFrame) -> DataFrame:
        if self.buckets:
            # One task a bucket, so that a bucket is one sorted file.
            return df.repartition(self.buckets, *[quoted(c) for c in self.bucket_by])
        # Few files per partition, while Spark still splits a partition too large for one task.
        return df.hint("rebalance", *self.partition_by) if self.partition_by else df

    def save(self, df: DataFrame, entry: str, place: str) -> None:
        writer = df.write.format(TABLE_FORMAT).mode("overwrite")
        writer = writer.options(path=place, partitionOverwriteMode="static", compression=COMPRESSION)
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        if self.buckets:
            writer = writer.bucketBy(self.buckets, *self.bucket_by).sortBy(*self.bucket_by)
        writer.saveAsTable(entry)


# Types that hold all values of those before them.
_WIDER = [
    ["tinyint", "smallint", "int", "bigint"],
    ["float", "double"],
    ["date", "timestamp"],
]


def merged(df: DataFrame, old: StructType) -> DataFrame:
    """The frame with the columns of an older schema, in their order, before those that are new.

    A column that the frame lacks is NULL, one whose type differs takes the wider of both types. Where
    neither holds the other's values, such as text and numbers, the schemas do not merge."""
    mine = {f.name.lower(): f for f in df.schema.fields}
    out, left = [], dict(mine)
    for f in old.fields:
        new = left.pop(f.name.lower(), None)
        if new is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        names = [f.dataType.simpleString(), new.dataType.simpleString()]
        if names[0] == names[1]:
            out.append(quoted(new.name).alias(f.name))
            continue
        line = next((w for w in _WIDER if set(names) <= set(w)), None)
        if line is None:
            raise ValueError(f"{f.name} was {names[0]} and is {names[1]}: the schemas do not merge")
        out.append(quoted(new.name).cast(max(names, key=line.index)).alias(f.name))
    return df.select(*out, *[quoted(f.name) for f in left.values()])


def store(
    df: DataFrame,
    table: str,
    layout: Layout = Layout(),
    bad_rows: str | None = None,
    profile: bool = False,
    merge_schema: bool = False,
) -> Written:
    """Overwrite a table, schema included, and tell what was counted on the way. With
    ``merge_schema`` the table keeps the columns that it has; see ``merged``.

    Rows, those where the column ``bad_rows`` (which is not written) is not NULL and, with ``profile``, the NULLs of every
    data column are counted while they are written, so nothing runs twice. If the load fails, the
    old table stays. ``df`` may read the table that it replaces. Not for two writers of one table at a time.
    """
    spark = df.sparkSession
    if settle(spark, table) and merge_schema:
        df = merged(df, spark.table(_entry(spark, table)).schema)
    seen = Observation()
    names = [c for c in data_columns(df) if c != bad_rows] if profile else []
    counts = [F.count(F.lit(1)).alias("rows")]
    if bad_rows:
        counts.append(F.count(quoted(bad_rows)).alias("bad"))
    counts += [F.count_if(quoted(c).isNull()).alias(f"n{i}") for i, c in enumerate(names)]
    # The last step before the write: a shuffle's map tasks may run twice, and count twice.
    out = layout.arranged(df).observe(seen, *counts).drop(*[bad_rows] if bad_rows else [])
    layout.save(out, _entry(spark, table, FRESH), _slot(spark, [table]))
    found = seen.get
    nulls = {c: found[f"n{i}"] for i, c in enumerate(names)} if profile else None
    written = Written(found["rows"], found.get("bad", 0), nulls)
    _note(spark, table, written)
    _swap(spark, table)
    return written


def store_split(df: DataFrame, tables: Mapping[str, Column]) -> dict[str, Written]:
    """Overwrite several tables of one database in one pass over ``df``: a row goes to the first table whose
    condition it meets, or to none. All are written before the first is swapped; see ``store``."""
    spark = df.sparkSession
    if "load_target" in (c.lower() for c in df.columns):
        raise ValueError("load_target is the name of the folders that the tables are in")
    names = list(tables)
    for table in names:
        settle(spark, table)
    target = F.lit(None).cast("int")
    for i, table in reversed(list(enumerate(names))):
        target = F.when(tables[table], i).otherwise(target)
    dealt = df.withColumn("load_target", target).where("load_target is not null")
    seen = Observation()
    counts = [F.count_if(F.col("load_target") == i).alias(f"n{i}") for i in range(len(names))]
    place = _slot(spark, names)
    writer = dealt.observe(seen, *counts).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy("load_target").parquet(place, compression=COMPRESSION)
    out = {table: Written(seen.get[f"n{i}"]) for i, table in enumerate(names)}
    for i, table in enumerate(names):
        part = f"{place}/load_target={i}"
        if not out[table].rows:
            _emptied(df, part)
        spark.catalog.createTable(_entry(spark, table, FRESH), part, TABLE_FORMAT, df.schema)
        _note(spark, table, out[table])
    for table in names:
        _swap(spark, table)
    return out


def write_table(
    df: DataFrame,
    table: str,
    partition_by: Sequence[str] = (),
    replace: bool = False,
    bad_rows: str | None = None,
) -> int | tuple[int, int]:
    """Overwrite a table by ``store`` and return the number of rows written, and of bad rows where
    those are asked for. ``replace`` also empties the folder that the old table was in."""
    spark = df.sparkSession
    before = location(spark, table) if settle(spark, table) and replace else None
    old = spark.table(_entry(spark, table)).limit(0) if before else None
    written = store(df, table, Layout(partition_by), bad_rows)
    if before and before != location(spark, table):
        _emptied(old, before)
    return (written.rows, written.bad) if bad_rows else written.rows
