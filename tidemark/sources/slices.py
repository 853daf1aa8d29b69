"""Slices of a database table that hold about equally many rows.

Equal strides of time make one hot slice where most bars lie close together. Slices between
quantiles do not: the bounds come from a table of the values (a sample, a copy, or counts per value
that the database has grouped itself), and every slice is a predicate of its own.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_VALUES = 10_000
_ACCURACY = 100_000  # of approximate quantiles: an error of at most 1/100,000 of the rows


def quantile_bounds(values: DataFrame, column: str, slices: int, weight: str | None = None) -> list:
    """Up to ``slices - 1`` rising values that cut the rows of ``values`` into equal parts.

    ``weight`` names a column that says how many rows a value stands for. Numbers, days and times
    are cut at approximate quantiles of all rows; other types, and weighted values, at those of
    `SAMPLE_VALUES` rows drawn at random (with a chance in proportion to the weight). Missing
    values are left out. A value that stands for more than a slice's share is not cut, so fewer
    bounds may come back.
    """
    if slices < 1:
        raise ValueError(f"slices must be at least 1, got {slices}")
    known = values.where(F.col(column).isNotNull())
    kind = values.schema[column].dataType
    shares = [i / slices for i in range(1, slices)]
    if not shares:
        return []
    if weight is None and isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        found = known.agg(F.percentile_approx(column, shares, _ACCURACY).alias("found")).first()["found"] or []
    else:
        # The smallest of -ln(u) / w make a weighted sample; without weights, any random numbers do.
        heavy = F.lit(1.0) if weight is None else F.col(weight).cast("double")
        draw = -F.log(F.rand(11)) / heavy
        rows = (
            known.where(heavy > 0)
            .select(F.col(column).alias("value"), heavy.alias("weight"), draw.alias("draw"))
            .orderBy("draw")
            .limit(SAMPLE_VALUES)
            .orderBy("value")
            .collect()
        )
        # All values of a small table keep their weights; in a sample they have done their part.
        if len(rows) == SAMPLE_VALUES:
            rows = [(r["value"], 1.0) for r in rows]
        total, so_far, found, shares = sum(r[1] for r in rows), 0.0, [], list(shares)
        for value, heft, *_ in rows:
            so_far += heft
            while shares and so_far >= shares[0] * total:
                found.append(value)
                shares.pop(0)
    return sorted(set(found))


def slice_predicates(column: str, bounds: Sequence) -> list[str]:
    """SQL conditions that every row fulfils exactly one of; the first takes missing values as well.

    A bound is the last value of its slice.
    """
    if not bounds:
        return ["1 = 1"]
    texts = [_literal(b) for b in bounds]
    inner = [f"{column} > {a} AND {column} <= {b}" for a, b in zip(texts, texts[1:])]
    return [f"{column} <= {texts[0]} OR {column} IS NULL", *inner, f"{column} > {texts[-1]}"]


def _literal(value) -> str:
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"
