import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from churnloom.schema import LOG_COLUMNS, LOG_SCHEMA  # noqa: E402
from churnloom.session import build_session  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        {
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_log(spark):
    """A log from partial rows; unnamed columns get plain values."""
    plain = {
        "userId": "1", "firstName": "A", "lastName": "B", "gender": "F", "location": "City, ST", "userAgent": "x",
        "level": "free", "registration": 1_700_000_000_000, "artist": None, "song": None, "length": None,
        "auth": "Logged In", "itemInSession": 0, "method": "GET", "page": "Home", "sessionId": 1, "status": 200,
        "ts": 1_700_086_400_000,
    }

    def make(*rows):
        return spark.createDataFrame([tuple({**plain, **r}[c] for c in LOG_COLUMNS) for r in rows], LOG_SCHEMA)

    return make


@pytest.fixture(scope="session")
def stored(spark):
    """V2 features of the small tables."""
    from churnloom.queries.common import stored_features

    return stored_features(spark, f"{DATA}/sf0.01")
