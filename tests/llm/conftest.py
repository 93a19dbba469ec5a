import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)


@pytest.fixture
def frame(spark):
    """A DataFrame from rows and a schema, over several partitions."""

    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts) if rows else spark.createDataFrame([], schema)

    return make
