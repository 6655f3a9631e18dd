import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Lines DataFrame from texts; a text without a time gets the standard one."""

    def make(*texts, file="2024_x.txt"):
        rows = [
            (file, i, t if t[:1].isdigit() or not t.strip() else "4/22 05:27:15.478  " + t)
            for i, t in enumerate(texts, 1)
        ]
        return spark.createDataFrame(rows, "file string, line_no bigint, raw string")

    return make
