import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from reviewloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4, 3]", shuffle_partitions=4,
                            **{"spark.driver.memory": "4g",
                               "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """``column(values, fn)``: the values of ``fn('v')`` over one string column."""
    def run(values, fn, type_="string"):
        df = spark.createDataFrame(list(enumerate(values)), f"i int, v {type_}")
        return [r[1] for r in df.select("i", fn("v").alias("out")).orderBy("i").collect()]
    return run


def executed_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
