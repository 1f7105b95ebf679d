import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from leafmill.session import local_session  # noqa: E402
from leafmill.sources.files import files_from_table  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(app="tests", cores="4", spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def files(spark):
    """files rows from (path, bytes) pairs."""
    from pyspark.sql import functions as F

    def build(*pairs):
        rows = spark.createDataFrame([(p, bytearray(b)) for p, b in pairs], "path string, content binary").coalesce(1)
        return files_from_table(rows, F.col("path"), F.col("content"))

    return build


@pytest.fixture(scope="session")
def column(spark):
    """Values of a column function over a list of inputs, in order."""
    from pyspark.sql import functions as F

    def run(values, kind, fn):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}").coalesce(1)
        return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]

    return run
