"""Every registered query against its SQL."""

import os
import subprocess
import sys

import pytest
from conftest import ROOT, SF_SMALL

import __spark_entry__ as registry
import oracle

# The text operators have tests of their own, which go with them.
SQL = registry.oracle_sql()
QUERIES = {name: query for name, query in registry.queries().items() if name in registry._QUERIES}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    assert oracle.differences(QUERIES[name](spark, SF_SMALL), con, SQL[name]) == []


def test_entry(spark):
    out = registry.entry(spark)
    assert out.columns[:3] == ["Symbol", "BarDateTime", "ClosePrice"] and out.count() == 1000


def test_entry_module_works_without_the_text_operators():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = sys.modules['tidemark.llm'] = None;"
        "import __spark_entry__ as e; assert set(e.queries()) == set(e._QUERIES) == set(e.oracle_sql())"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)


def test_modules_compile():
    for folder, _, files in os.walk(os.path.join(ROOT, "tidemark")):
        for name in files:
            if name.endswith(".py"):
                with open(os.path.join(folder, name)) as source:
                    compile(source.read(), name, "exec")
