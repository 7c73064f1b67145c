"""Reading extracts, reading and writing layer tables."""

from tristrata.sources.csv import read_csv
from tristrata.sources.sheets import mapping_sheet, read_mapping_sheet
from tristrata.sources.tables import (
    Layers,
    Layout,
    Written,
    create_layers,
    drop_table,
    load_settings,
    readable_rows,
    recorded,
    settle,
    store,
    store_split,
    use_layer,
    write_table,
)

__all__ = [
    "Layers",
    "Layout",
    "Written",
    "create_layers",
    "drop_table",
    "load_settings",
    "mapping_sheet",
    "read_csv",
    "read_mapping_sheet",
    "readable_rows",
    "recorded",
    "settle",
    "store",
    "store_split",
    "use_layer",
    "write_table",
]
