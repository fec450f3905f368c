from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from helpers_llm import SCHEMA, awkward, rows_of


@pytest.fixture(scope="session")
def make(spark):
    def frame(pairs):
        return spark.createDataFrame(rows_of(pairs), SCHEMA)

    return frame


@pytest.fixture(scope="session")
def odd_docs(make):
    return make(awkward()).cache()


@pytest.fixture(scope="session")
def no_docs(make):
    return make([])
