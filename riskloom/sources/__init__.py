"""Sources and sinks."""

from riskloom.sources.files import (
    drop_vector_columns,
    land_csv,
    materialize,
    read_csv,
    read_csv_checked,
    read_table,
    save_metrics,
    save_table,
    string_schema,
)
from riskloom.sources.fixtures import RAW_COLUMNS, mixed_layout_dates, raw_transactions, table
from riskloom.sources.stages import Stages, input_digest

__all__ = [
    "RAW_COLUMNS",
    "Stages",
    "drop_vector_columns",
    "input_digest",
    "land_csv",
    "materialize",
    "mixed_layout_dates",
    "raw_transactions",
    "read_csv",
    "read_csv_checked",
    "read_table",
    "save_metrics",
    "save_table",
    "string_schema",
    "table",
]
