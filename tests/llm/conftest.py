import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from edges import SCHEMA, edge_docs, stored  # noqa: E402


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    """The edge rows as a stored table."""
    return stored(spark, edge_docs(spark), tmp_path_factory.mktemp("edge"))


@pytest.fixture(scope="session")
def empty(spark, tmp_path_factory):
    return stored(spark, spark.createDataFrame([], SCHEMA), tmp_path_factory.mktemp("empty"))
