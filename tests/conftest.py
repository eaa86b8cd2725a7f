import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skytally.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def docs(spark):
    """JSON texts → one VARIANT ``doc`` per row, in order ``ix``."""
    from pyspark.sql import functions as F

    def build(*texts):
        rows = spark.createDataFrame(list(enumerate(texts)), "ix int, text string")
        return rows.select("ix", F.parse_json("text").alias("doc"))

    return build
