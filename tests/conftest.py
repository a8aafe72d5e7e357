import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from turnwise.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Applies a column function to texts and gives the results in order."""

    def apply(values, function, **kwargs):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(list(enumerate(values)), "i int, c string")
        out = rows.select("i", function(F.col("c"), **kwargs).alias("o")).orderBy("i").collect()
        return [r["o"] for r in out]

    return apply
