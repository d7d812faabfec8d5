"""One session for all tests, with small shuffles."""

import os
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [HERE, os.path.join(HERE, "tests", "llm")]
os.environ["PYTHONPATH"] = HERE + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "3").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.host", "127.0.0.1").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    s.sparkContext.environment["PYTHONPATH"] = HERE
    yield s
    s.stop()
