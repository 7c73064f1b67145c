"""Load time as a column, with an optional fixed time (in the session's time zone)
for repeatable runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def now(as_of: datetime | None = None) -> Column:
    return F.current_timestamp() if as_of is None else F.lit(as_of.isoformat(sep=" ")).cast("timestamp")


def today(as_of: datetime | None = None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of.date())
