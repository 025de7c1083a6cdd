import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hourmill.session import build_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", app="hourmill-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture
def scratch(spark, request):
    """A fresh folder under the shared checkpoint root for one test."""
    return scratch_path(spark, "t-" + request.node.name[:40].replace("[", "-").replace("]", ""))


def ts_frame(spark, rows, schema):
    """createDataFrame, then cast columns named ts/timestamp from text to TIMESTAMP."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, schema)
    for c in df.columns:
        if c in ("ts", "timestamp"):
            df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df
