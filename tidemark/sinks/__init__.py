from tidemark.sinks.batches import BatchLog
from tidemark.sinks.outputs import (
    RunStamp,
    bands_output,
    require_values,
    save,
    with_bar_day,
    zscore_output,
)
from tidemark.sinks.schemas import BANDS_COLUMNS, BANDS_TABLE, ZSCORE_COLUMNS, ZSCORE_TABLE
from tidemark.sinks.tables import TableLayout, create_table, plan_table_layout, table_layout

__all__ = [
    "BANDS_COLUMNS",
    "BANDS_TABLE",
    "BatchLog",
    "RunStamp",
    "TableLayout",
    "ZSCORE_COLUMNS",
    "ZSCORE_TABLE",
    "bands_output",
    "create_table",
    "plan_table_layout",
    "require_values",
    "save",
    "table_layout",
    "with_bar_day",
    "zscore_output",
]
