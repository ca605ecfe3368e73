import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """Make a caption frame from (split, text_id, text, image_ids) rows."""

    def make(*rows):
        data = [(s, at, i, t, ids, None) for at, (s, i, t, ids) in enumerate(rows)]
        return spark.createDataFrame(
            data,
            "split string, ord bigint, text_id bigint, text string, image_ids array<bigint>, source_text_id bigint",
        )

    return make


@pytest.fixture
def images(spark):
    """Make an image frame from (split, image_id, base64) rows."""

    def make(*rows):
        data = [(s, at, i, b) for at, (s, i, b) in enumerate(rows)]
        return spark.createDataFrame(data, "split string, ord bigint, image_id bigint, image_b64 string")

    return make
