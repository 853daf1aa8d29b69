"""Comparing a Spark frame with a DuckDB query, cell by cell."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(os.path.join(sf_dir, "*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What is different, ignoring row and column order; empty when all is equal."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    order = sorted(names)
    theirs = [tuple(_cell(row[names.index(c)]) for c in order) for row in expected.fetchall()]
    ours = [tuple(_cell(row[c]) for c in order) for row in df.collect()]
    problems = []
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows != {len(theirs)}")
    ours_count, theirs_count = Counter(ours), Counter(theirs)
    for row in list((ours_count - theirs_count))[:3]:
        problems.append(f"only in Spark: {row}")
    for row in list((theirs_count - ours_count))[:3]:
        problems.append(f"only in SQL: {row}")
    return problems


def _cell(value):
    # Type and value: 1 and 1.0 are different cells, and so are 0.0 and -0.0.
    return (type(value).__name__, repr(value))
