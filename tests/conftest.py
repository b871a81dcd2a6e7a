import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cadence.schema import EVENT_SCHEMA  # noqa: E402
from cadence.session import build_spark, checkpoint_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_spark("local[8]", app="cadence-tests", shuffle_partitions=8)
    checkpoint_root(s)
    yield s
    s.stop()


@pytest.fixture
def make_events(spark):
    def make(rows):
        return spark.createDataFrame(rows, EVENT_SCHEMA)

    return make
