import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tarmac import schemas
from tarmac.session import build_session

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[4]",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tarmac-tests-"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def change(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


FLIGHTS = [
    # airline, origin, destination, departure, month, day, distance, taxi, delay, canc., div.
    ("AA", "AAA", "BBB", "0005", "1", "1", "150", "10", "-5", "0", "0"),
    ("AA", "AAA", "CCC", "0630", "1", "2", "200", "20", "15", "0", "0"),
    ("BB", "BBB", "AAA", "1200", "2", "3", "2999", "12", "3", "0", "0"),
    ("BB", "BBB", "AAA", "1800", "2", "4", "3100", "8", "0", "0", "0"),
    ("AA", "AAA", "BBB", "0559", "3", "5", "400", "14", "5", "0", "0"),
    ("CC", "CCC", "AAA", "2400", "3", "6", "50", "30", "-1", "0", "0"),
    ("AA", "AAA", "BBB", "0700", "1", "1", "150", None, None, "1", "0"),
    ("BB", "BBB", "AAA", "0700", "1", "1", "150", "9", None, "0", "1"),
    ("BB", "12345", "AAA", "0700", "1", "1", "150", "9", "40", "0", "0"),
    ("ZZ", "AAA", "BBB", "0600", "1", "1", "150", "16", "7", "0", "0"),
]
AIRLINES = [("AA", "American"), ("BB", "Blue, Inc."), ("CC", "Coastal")]
AIRPORTS = [
    ("AAA", "Alpha Field", "40.0", "-75.0", "NY"),
    ("BBB", "Bravo, Intl", "-35.5", "-135.0", "AK"),
    ("CCC", "Charlie", None, None, "PR"),
]


@pytest.fixture(scope="session")
def flights(spark):
    return spark.createDataFrame(FLIGHTS, schemas.RAW_FLIGHTS)


@pytest.fixture(scope="session")
def airlines(spark):
    return spark.createDataFrame(AIRLINES, schemas.RAW_AIRLINES)


@pytest.fixture(scope="session")
def airports(spark):
    return spark.createDataFrame(AIRPORTS, schemas.RAW_AIRPORTS)


def rows(table):
    return sorted((tuple(r) for r in table.collect()), key=repr)


def plan(table):
    """The physical plan as text, the final one if the table has run."""
    return table._jdf.queryExecution().executedPlan().toString()
