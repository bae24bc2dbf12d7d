import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from evenkeel.session import build  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build(
        "tests",
        {
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def text(spark):
    """Build a frame of text columns from tuples."""

    def make(names, rows):
        return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names.split()))

    return make


def values(df, *order):
    """Rows as sorted tuples; None sorts first."""
    rows = [tuple(r) for r in df.collect()]
    return sorted(rows, key=lambda r: [(v is not None, str(v)) for v in r])
