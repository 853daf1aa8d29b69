"""Report text for numbers and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "-"


def number_text(column: Column, decimals: int = 2) -> Column:
    """Fixed decimals without thousands separators; ``-`` where missing.

    ``format_number`` rounds the exact value of the double, half to even, which is what
    C-style formatting does; ``format_string`` rounds its shortest decimal form instead
    (0.125 and 2.675 come out differently).
    """
    pattern = "0." + "0" * decimals if decimals else "0"
    text = F.call_function("format_number", column.cast("double"), F.lit(pattern))
    return F.coalesce(text, F.lit(MISSING))


def minute_text(column: Column) -> Column:
    """``yyyy-MM-dd HH:mm``; ``-`` where missing.

    Cutting the text form works on zoned and zone-less timestamps alike, without a
    detour through the session time zone.
    """
    return F.coalesce(F.substring(column.cast("string"), 1, 16), F.lit(MISSING))


def count_text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(MISSING))
