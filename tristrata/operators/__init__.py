"""DataFrame -> DataFrame operators."""

from tristrata.operators.cleanse import blanks_to_null, cleanse, keep_latest, parse_dates
from tristrata.operators.joins import attach
from tristrata.operators.profile import TableCheck, check_table, null_counts, preview
from tristrata.operators.projection import Field, apply_mapping, fields, project
from tristrata.operators.schema import (
    clean_name,
    clean_names,
    columns_of_type,
    data_columns,
    measure_columns,
    without_metadata,
)
from tristrata.operators.skew import SkewPolicy, hot_keys
from tristrata.operators.stamps import stamp_cleansed, stamp_fact, stamp_raw, stamp_validity
from tristrata.operators.star import (
    as_dimension,
    as_fact,
    attach_key,
    calendar,
    dimension_keys,
    distinct_values,
)

__all__ = [
    "Field",
    "SkewPolicy",
    "TableCheck",
    "apply_mapping",
    "as_dimension",
    "as_fact",
    "attach",
    "attach_key",
    "blanks_to_null",
    "calendar",
    "check_table",
    "clean_name",
    "clean_names",
    "cleanse",
    "columns_of_type",
    "data_columns",
    "dimension_keys",
    "distinct_values",
    "fields",
    "hot_keys",
    "keep_latest",
    "measure_columns",
    "null_counts",
    "parse_dates",
    "preview",
    "project",
    "stamp_cleansed",
    "stamp_fact",
    "stamp_raw",
    "stamp_validity",
    "without_metadata",
]
