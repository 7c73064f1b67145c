"""CSV extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    infer: bool = False,
    sep: str = ",",
    multi_line: bool = False,
    escape: str = '"',
    bad_rows: str | None = None,
) -> DataFrame:
    """Read a CSV extract with a header line.

    Without a schema every column is a string: codes such as ``0001`` keep their
    zeros and no extra pass over the file is needed. ``infer`` lets Spark guess the
    types instead, at the price of that pass. ``multi_line`` accepts quoted line
    breaks, but then a file can no longer be split between tasks; deliver a large extract
    as several files. A quote within a quoted text is written twice, unless
    ``escape`` names another character.

    ``bad_rows`` names an added column with the text of each row that has too many or too few
    cells, or a cell that does not fit the schema; it is NULL for good rows.
    """
    reader = spark.read.options(header=True, sep=sep, multiLine=multi_line, escape=escape)
    if schema is None:
        found = reader.options(inferSchema=infer)
        if bad_rows is None:
            return found.csv(path)
        schema = found.csv(path).schema
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if bad_rows is None:
        return reader.schema(schema).csv(path)
    watched = StructType([*schema.fields, StructField(bad_rows, StringType())])
    return reader.schema(watched).option("columnNameOfCorruptRecord", bad_rows).csv(path)
