import os
import sys

import pytest

sys.path.append(os.path.dirname(os.path.abspath(__file__)))

from tidemark.llm.deploy import workers_find_package  # noqa: E402
from tidemark.scratch import ensure_checkpoint_dir  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def ready(spark):
    workers_find_package(spark)
    ensure_checkpoint_dir(spark)


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
