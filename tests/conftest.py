import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from voxgauge.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
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


@pytest.fixture(scope="session")
def values(spark):
    """Evaluates a column expression over literal inputs: ``values(fn, *inputs)`` gives a list."""

    def run(fn, inputs, kind="string"):
        rows = [(i, x) for i, x in enumerate(inputs)]
        df = spark.createDataFrame(rows, f"i int, x {kind}")
        return [r[0] for r in df.select(fn("x").alias("y"), "i").orderBy("i").collect()]

    return run
