import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickspark.session import CHUNK_ROWS, DEFAULT_CHUNK_ROWS, get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def small_ranges(spark):
    """Every series longer than 40 rows is cut into ranges."""
    spark.conf.set(CHUNK_ROWS, "40")
    yield
    spark.conf.set(CHUNK_ROWS, str(DEFAULT_CHUNK_ROWS))
