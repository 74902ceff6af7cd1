import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tastemap.session import build_session
    s = build_session(master="local[4]", shuffle_partitions=4, extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture
def ratings_df(spark):
    """Hand case: 3 users x 4 items, user 3 a constant rater, item 40 rated once."""
    rows = [(1, 10, 5.0), (1, 20, 3.0), (1, 30, 4.0),
            (2, 10, 4.0), (2, 20, 1.0), (2, 30, 2.0), (2, 40, 5.0),
            (3, 10, 3.0), (3, 20, 3.0), (3, 30, 3.0)]
    return spark.createDataFrame(rows, "user long, item long, rating double")


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
