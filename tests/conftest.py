import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from quillmill import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__host="127.0.0.1",
        spark__driver__bindAddress="127.0.0.1",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Values of a column expression over one string column ``c``."""

    def run(expression, inputs):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, c string")
        return [r.v for r in rows.select("i", expression(F.col("c")).alias("v")).orderBy("i").collect()]

    return run
