import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from plenary.session import build_session  # noqa: E402

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g", "spark.log.level": "ERROR",
        "spark.ui.showConsoleProgress": "false"})
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Applies a Column function to literal strings and gives back the results in order."""

    def apply(function, values, kind="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
        return [row[1] for row in df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()]

    return apply
