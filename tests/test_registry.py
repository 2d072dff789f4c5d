"""Every registered query against its SQL, and free of operators that do not scale."""

import pytest

import __spark_entry__ as registry
from tests.conftest import DATA, plan
from tools.compare import compare, connect

SLOW = (
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
    "ArrowEvalPython",
    "BatchEvalPython",
    "MapInPandas",
)


@pytest.fixture(scope="module")
def connection():
    return connect(DATA)


@pytest.mark.parametrize("name", sorted(registry.OWN_QUERIES))
def test_query(spark, connection, name):
    table = registry.queries()[name](spark, DATA)
    assert compare(connection, table, name) is None
    text = plan(table)
    for bad in SLOW:
        assert bad not in text


def test_only_regressions_and_tree_text_lack_sql():
    assert set(registry.OWN_QUERIES) - set(registry.oracle_sql()) == {
        "logistic_evaluation",
        "logistic_certificate",
        "model_report",
        "tree_description",
    }


def test_entry(spark):
    board = registry.entry(spark)
    assert board.columns == ["rank", "airline", "average_delay"]
    assert board.count() == 25
