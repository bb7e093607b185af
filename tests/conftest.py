import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from docsettle.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Values of a column expression over a list of texts."""

    def run(function, texts):
        from pyspark.sql import functions as F

        frame = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
        rows = frame.select("n", function(F.col("t")).alias("v")).orderBy("n").collect()
        return [row["v"] for row in rows]

    return run
