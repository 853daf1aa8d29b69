from tidemark.sources.history import (
    HISTORY_COLUMNS,
    day_range,
    history,
    read_history,
    read_table,
    with_row_identity,
)
from tidemark.sources.jdbc import JdbcTable, jdbc_url
from tidemark.sources.slices import quantile_bounds, slice_predicates

__all__ = [
    "HISTORY_COLUMNS",
    "JdbcTable",
    "day_range",
    "history",
    "jdbc_url",
    "quantile_bounds",
    "read_history",
    "read_table",
    "slice_predicates",
    "with_row_identity",
]
