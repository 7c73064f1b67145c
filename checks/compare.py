"""Run registered queries against their SQL in DuckDB and report differences.

    python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.bindings import TABLES
from checks.oracle import ORACLE
from checks.queries import QUERIES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def sorted_rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(r[i] for i in order) for r in rows]
    return sorted(picked, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs between a Spark result and a SQL result, or nothing."""
    wanted = con.execute(sql)
    names = [d[0] for d in wanted.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    ours = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = sorted_rows(names, wanted.fetchall())
    if len(ours) != len(theirs):
        return f"{len(ours)} rows for {len(theirs)}"
    for mine, other in zip(ours, theirs):
        if mine != other:
            pairs = zip(sorted(names), mine, other)
            return "; ".join(f"{n}: {a!r} for {b!r}" for n, a, b in pairs if a != b)
    return None


def types(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> dict[str, tuple[str, str]]:
    """Columns whose types have different names on the two sides."""
    same = {
        "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DATE": "date",
        "BOOLEAN": "boolean", "DOUBLE": "double",
    }
    ours = dict(df.dtypes)
    found = {}
    for name, kind, *_ in con.execute(f"DESCRIBE {sql}").fetchall():
        expected = same.get(kind, kind.lower())
        if ours[name] != expected:
            found[name] = (ours[name], kind)
    return found


def local_session(cores: str = "8") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tristrata")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def main(folder: str = "/root/testdata/sf0.01", *only: str) -> int:
    spark, con = local_session(), connect(folder)
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name, run in QUERIES.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            problem = differences(df, con, ORACLE[name]) if name in ORACLE else "no SQL"
            odd = types(df, con, ORACLE[name]) if name in ORACLE else {}
        except Exception as error:  # noqa: BLE001
            problem, odd = str(error)[:600], {}
        failed += problem is not None
        print(f"{name:28} {time.time() - start:6.2f}s {problem or 'ok'} {odd or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
