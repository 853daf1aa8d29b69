"""What a series is: which columns identify it, order it and carry its value."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SeriesSpec:
    """A family of series stored as rows.

    ``keys`` name one series, ``order`` is its time axis and ``value`` the observed
    column. ``tie_breakers`` settle rows that share a key and a time; ``value`` always
    comes last in the order, so that equal times never make the statistics depend on
    the order in which rows arrive.
    """

    keys: tuple[str, ...] = ("Symbol",)
    order: str = "BarDateTime"
    value: str = "ClosePrice"
    tie_breakers: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        """The columns the statistics need, in a stable order and without repeats."""
        return list(dict.fromkeys([*self.keys, *self.sequence]))

    @property
    def sequence(self) -> list[str]:
        """The columns that put the rows of one series in order."""
        return list(dict.fromkeys([self.order, *self.tie_breakers, self.value]))

    def ascending(self) -> list[Column]:
        return [F.col(c).asc_nulls_first() for c in self.sequence]

    def ordinal(self) -> WindowSpec:
        """All rows of a series in order."""
        return Window.partitionBy(*self.keys).orderBy(*self.ascending())

    def trailing(self, n: int) -> WindowSpec:
        """The current row and the ``n - 1`` rows before it."""
        if n < 1:
            raise ValueError(f"window size must be at least 1, got {n}")
        return self.ordinal().rowsBetween(1 - n, Window.currentRow)


BARS = SeriesSpec()
