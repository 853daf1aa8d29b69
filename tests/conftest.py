import contextlib
import io
import os
import sys
from datetime import datetime, timedelta

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from tidemark.session import spark_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SCHEMA = "Symbol string, BarDateTime timestamp_ntz, ClosePrice double"
T0 = datetime(2024, 3, 4, 9, 30)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = spark_session(
        "tidemark-tests",
        master="local[8]",
        shuffle_partitions=8,
        settings={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_bars(spark):
    """Bars one minute apart from lists of closes by symbol."""

    def make(schema=SCHEMA, **closes):
        rows = [
            (symbol, T0 + timedelta(minutes=i), close)
            for symbol, series in closes.items()
            for i, close in enumerate(series)
        ]
        return spark.createDataFrame(rows, schema)

    return make


def by_row(df, *columns):
    """Values in time order, as tuples."""
    return [tuple(r) for r in df.orderBy("Symbol", "BarDateTime").select(*columns).collect()]


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
