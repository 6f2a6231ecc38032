import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from locusframe.session import get_session

    s = get_session("tests", "local[8]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def lines(spark):
    def make(text, path="x"):
        rows = [(path, i, t) for i, t in enumerate(text.split("\n"))]
        return spark.createDataFrame(rows, "path string, ord bigint, value string")
    return make
