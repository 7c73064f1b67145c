"""Folders in the storage that all executors share."""

from __future__ import annotations

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """One place per application and name, below the session's checkpoint folder or, where
    none is set, its warehouse. A query that runs again overwrites what it left."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/tristrata-{spark.sparkContext.applicationId}/{name}"
