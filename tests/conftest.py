import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    conf = {"spark.sql.warehouse.dir": str(warehouse), "spark.sql.shuffle.partitions": "3"}
    session = local_session(8, app="tests", **conf)
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Build a frame from a schema string and tuples."""

    def build(schema, *data):
        return spark.createDataFrame(list(data), schema)

    return build


def values(df):
    """All rows as tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
