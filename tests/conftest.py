import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from abtest_spark.schema import RAW_SCHEMA  # noqa: E402
from abtest_spark.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark(app="abtest_spark_tests", master="local[*]", shuffle_partitions=8)
    yield s


@pytest.fixture
def raw_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, RAW_SCHEMA)

    return make


GOLD_SCHEMA = "day date, experiment_name string, variant_id string, users long, purchases long"


@pytest.fixture
def gold_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, GOLD_SCHEMA)

    return make
