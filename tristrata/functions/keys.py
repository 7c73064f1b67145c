"""Hashed keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tristrata.functions.text import quoted

# How key parts are joined, and what a missing part reads as.
SEPARATOR = "||"
MISSING = "NULL"


def surrogate_key(*names: str) -> Column:
    """md5 over the named columns. A missing part reads as the text ``NULL``, so
    the key is never NULL; it also cannot be told from that literal text."""
    parts = [F.coalesce(quoted(n).cast("string"), F.lit(MISSING)) for n in names]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def single_key(name: str) -> Column:
    """md5 of one column; a missing value has no key."""
    return F.md5(quoted(name).cast("string"))
