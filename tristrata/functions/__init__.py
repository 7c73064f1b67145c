"""Column expressions."""

from tristrata.functions.calendar import calendar_attributes
from tristrata.functions.clock import now, today
from tristrata.functions.dates import compact_date, month_end, period_start
from tristrata.functions.keys import single_key, surrogate_key
from tristrata.functions.text import blank_to_null, decode, quoted

__all__ = [
    "blank_to_null",
    "calendar_attributes",
    "compact_date",
    "decode",
    "month_end",
    "now",
    "period_start",
    "quoted",
    "single_key",
    "surrogate_key",
    "today",
]
