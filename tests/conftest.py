import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sirenlog.schemas import ENVELOPE  # noqa: E402
from sirenlog.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return configure(session)


@pytest.fixture(scope="session")
def make_log(spark):
    """A log of the given values, in order."""
    def build(values, first_offset=0, partitions=2):
        rows = [("incident-events", 0, first_offset + i, None, v, {}) for i, v in enumerate(values)]
        return spark.createDataFrame(rows, ENVELOPE).repartition(partitions)
    return build
