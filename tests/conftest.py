from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tools"))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from tastemill.session import local_session

    session = local_session("4", "tests", "6g")
    session.sparkContext.setLogLevel("ERROR")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SMALL


@pytest.fixture(scope="session")
def ratings(spark):
    """The 5 x 5 table of the worked example; Alice has not rated E. The golden results need them."""
    table = {
        "Alice": {"A": 5, "B": 3, "C": 4, "D": 4},
        "user1": {"A": 3, "B": 1, "C": 2, "D": 3, "E": 3},
        "user2": {"A": 4, "B": 3, "C": 4, "D": 3, "E": 5},
        "user3": {"A": 3, "B": 3, "C": 1, "D": 5, "E": 4},
        "user4": {"A": 1, "B": 5, "C": 5, "D": 2, "E": 1},
    }
    rows = [(u, i, float(r), 1000 * k) for u, m in table.items() for k, (i, r) in enumerate(m.items())]
    return spark.createDataFrame(rows, "user_id string, item_id string, rating double, ts long")
