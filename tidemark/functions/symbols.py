"""Cleaning symbols, as plain values and as columns."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the characters a symbol may consist of.
SYMBOL_CHARACTERS = r"[A-Za-z0-9.\-]+"

# Fixed value: every character that counts as white space, also outside ASCII.
WHITE_SPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(column: Column) -> Column:
    """Remove white space of any kind at both ends (plain ``trim`` removes spaces only)."""
    return F.btrim(column, F.lit(WHITE_SPACE))


@dataclass(frozen=True)
class SymbolRule:
    """What a symbol is: a row of allowed characters, read without case and outer white space.

    One rule for symbols that are given as values and for those that are data.
    """

    characters: str = SYMBOL_CHARACTERS

    def read(self, text: str) -> str:
        return text.strip().upper()

    def holds(self, symbol: str) -> bool:
        return re.fullmatch(self.characters, symbol) is not None

    def require(self, symbols: Iterable[str]) -> tuple[str, ...]:
        """The different symbols in the order given, blanks left out.

        One error names everything that is no symbol; having none left is an error as well.
        """
        found = dict.fromkeys(filter(None, map(self.read, symbols)))
        wrong = [s for s in found if not self.holds(s)]
        if wrong or not found:
            reason = ", ".join(map(repr, wrong)) or "an empty list"
            raise ValueError(f"expected symbols, got {reason}")
        return tuple(found)

    def judged(self, df: DataFrame, column: str) -> DataFrame:
        """(Symbol, IsValid) for every value of a column; blanks and nulls are dropped."""
        symbol = F.upper(strip(F.col(column)))
        valid = F.col("Symbol").rlike(rf"^(?:{self.characters})\z")
        return df.select(symbol.alias("Symbol")).where("Symbol <> ''").withColumn("IsValid", valid)


SYMBOLS = SymbolRule()


def symbol_list(column: Column) -> Column:
    """Split comma-separated text into trimmed items without blanks, case kept."""
    return F.filter(F.transform(F.split(column, ","), strip), lambda item: item != "")


def split_symbols(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """One row per item of a comma-separated column.

    Exploding before trimming keeps every step inside generated code, which the array
    functions of `symbol_list` are not.
    """
    items = df.select(*keep, F.explode(F.split(column, ",")).alias("Symbol"))
    return items.withColumn("Symbol", strip(F.col("Symbol"))).where(F.col("Symbol") != "")
