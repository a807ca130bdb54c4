import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_data import SCHEMA, prose, rows  # noqa: E402


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, a very long one, ties, and rows that repeat."""
    texts = [None, "", " \t\n", "one", "One", prose(30_000, 1), prose(200, 2), prose(200, 2), "é ü", "a  b\tc d"]
    got = rows(texts) + rows(texts)[5:8]
    got += [(None, "one", None, None, None, None, None, None, None), (None, None, None, "s1", 0, 0, "", "", "")]
    return spark.createDataFrame(got, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
