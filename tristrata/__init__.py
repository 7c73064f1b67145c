"""Layered analytics tables on Spark: raw extracts -> cleansed tables -> star schema.

Every operator is a plain function from DataFrames to a DataFrame (or to a
Column), so it composes with ``DataFrame.transform`` and stays inside Catalyst.
Only ``tristrata.sources`` touches storage and only ``tristrata.plans`` runs
jobs over many tables.
"""
