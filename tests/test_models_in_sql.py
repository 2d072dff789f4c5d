"""Fitted models replayed by another engine from what the library says about them."""

import duckdb
import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tarmac.constants import FEATURE_ORDER
from tarmac.operators import certificates, trees
from tarmac.plans import training
from tarmac.sources.stage import keep
from tests.conftest import DATA


@pytest.fixture(scope="module")
def features(spark):
    return keep(registry._features(spark, DATA), "features")


def _encoded(fitted, features, vector):
    """The model's inputs by name, with its label and prediction."""
    x = vector_to_array(vector)
    columns = [x[i].alias(name) for i, name in enumerate(FEATURE_ORDER)]
    return fitted.transform(features).select(*columns, "DelayIndex", "prediction").toPandas()


def test_tree_is_replayed_on_every_row(spark, features):
    fitted, _ = training.train_and_evaluate(features, "tree")
    nodes = trees.tree_nodes(spark, fitted.stages[-1])
    rows = _encoded(fitted, features, "features")  # noqa: F841, read by the query
    guess = trees.prediction_sql(nodes)
    wrong = duckdb.sql(f"SELECT count(*) FROM rows WHERE prediction <> ({guess})").fetchall()[0][0]
    assert wrong == 0 and len(rows) == features.count()
    again = fitted.transform(features).select(*FEATURE_ORDER, "prediction")
    assert again.where(F.col("prediction") != F.expr(guess)).isEmpty()


def test_nodes_hold_the_rows_of_their_children(spark, features):
    fitted, _ = training.train_and_evaluate(features, "tree")
    model = fitted.stages[-1]
    rows = {r["node"]: r for r in trees.tree_nodes(spark, model).collect()}
    assert len(rows) == model.numNodes and max(r["depth"] for r in rows.values()) == model.depth
    for node, row in rows.items():
        if row["feature"] is None:
            assert 2 * node not in rows and row["gain"] is None
            continue
        children = rows[2 * node], rows[2 * node + 1]
        assert row["on_time"] == sum(c["on_time"] for c in children)
        assert row["late"] == sum(c["late"] for c in children)
        assert (row["bound"] is None) != (row["categories"] is None) and row["gain"] > 0


def test_certificate_agrees_with_sql_and_with_differences(spark, features):
    """Loss and slopes in DuckDB from single rows, and slopes as differences of the loss."""
    fitted, _ = training.train_and_evaluate(features, "logistic")
    model = fitted.stages[-1]
    encoded = fitted.transform(features).withColumn("weight", F.lit(1))
    found = certificates.logistic_certificate(encoded, model).collect()
    assert [r["term"] for r in found] == [certificates.INTERCEPT, *FEATURE_ORDER]
    rows = _encoded(fitted, features, "normalized_features")  # noqa: F841, read by the query
    margin = " + ".join(
        [repr(float(model.intercept))]
        + [f"{float(c)!r} * {n}" for c, n in zip(model.coefficients, FEATURE_ORDER)]
    )
    slopes = ", ".join(f"avg(wrong * {n})" for n in FEATURE_ORDER)
    expected = duckdb.sql(f"""
        SELECT avg(ln(1 + exp(m)) - DelayIndex * m), avg(wrong), {slopes}
        FROM (SELECT *, 1 / (1 + exp(-m)) - DelayIndex AS wrong
              FROM (SELECT *, {margin} AS m FROM rows))
    """).fetchall()[0]
    assert [r["loss"] for r in found] == pytest.approx([expected[0]] * len(found))
    assert [r["slope"] for r in found] == pytest.approx(list(expected[1:]), abs=1e-9)
    x, y = rows[list(FEATURE_ORDER)].to_numpy(), rows["DelayIndex"].to_numpy()
    c = np.array(model.coefficients.toArray())

    def loss(intercept, coefficients):
        m = intercept + x @ coefficients
        return np.mean(np.logaddexp(0, m) - y * m)

    for i, row in enumerate(found[1:]):
        step = np.zeros(len(c))
        step[i] = 1e-4
        slope = (loss(model.intercept, c + step) - loss(model.intercept, c - step)) / 2e-4
        assert row["slope"] == pytest.approx(slope, abs=1e-6)


def test_more_iterations_flatten_the_slopes(spark, features, monkeypatch):
    """The promise of a fit: where it may run to its end, no slope is left."""
    monkeypatch.setattr(training, "LOGISTIC_MAX_ITER", 500)
    rows = training.split_and_compact(features)
    train = rows.where("set = 'Train'")
    fitted = training.PipelineModel(training.fit_encoders(train, "logistic")).transform(train)
    model = training._logistic().fit(fitted)
    found = certificates.logistic_certificate(fitted, model).collect()
    assert max(abs(r["slope"]) for r in found) < 1e-3
