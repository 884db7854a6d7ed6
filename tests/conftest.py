import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """``column(values, build)``: the results of a column expression over text values."""
    from pyspark.sql import functions as F

    def run(values, build):
        df = spark.createDataFrame(list(enumerate(values)), "i long, s string")
        rows = df.select("i", build(F.col("s")).alias("r")).collect()
        return [r.r for r in sorted(rows, key=lambda r: r.i)]

    return run
