"""Text expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """The column with exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def blank_to_null(text: Column) -> Column:
    """Strip outer spaces; a value with nothing left becomes NULL."""
    return F.nullif(F.trim(text), F.lit(""))


def decode(code: Column, labels: Mapping[str | None, str], default: str) -> Column:
    """Label a code. The key ``None`` labels a missing code; anything else not
    listed, a missing code included, gets ``default``."""
    chosen = None
    for value, label in labels.items():
        test = code.isNull() if value is None else code == value
        chosen = F.when(test, label) if chosen is None else chosen.when(test, label)
    return F.lit(default) if chosen is None else chosen.otherwise(default)
