"""What a fitted regression promises, worked out from the rows again."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tarmac.constants import FEATURE_ORDER

INTERCEPT = "(intercept)"


def logistic_certificate(
    encoded,
    model,
    vector="normalized_features",
    label="DelayIndex",
    weight="weight",
    names=FEATURE_ORDER,
):
    """Each term with its coefficient and the slope of the loss along it, and the loss itself.

    The loss is the mean over weighted rows of -log of the probability a row's label gets. At
    the best coefficients every slope is zero; a fit that was stopped early shows how far it
    got. All sums come from one aggregate over the rows.
    """
    coefficients = [float(c) for c in model.coefficients]
    x = vector_to_array(vector)
    parts = [F.lit(c) * x[i] for i, c in enumerate(coefficients)]
    margin = sum(parts, F.lit(float(model.intercept)))
    rows = encoded.select(x.alias("x"), margin.alias("margin"), label, weight)
    # log(1 + exp(m)) in the form that does not overflow.
    loss = F.greatest("margin", F.lit(0.0)) + F.log1p(F.exp(-F.abs("margin")))
    wrong = F.col(weight) * (1 / (1 + F.exp(-F.col("margin"))) - F.col(label))
    sums = rows.agg(
        F.sum(weight).alias("n"),
        F.sum(F.col(weight) * (loss - F.col(label) * F.col("margin"))).alias("loss"),
        F.sum(wrong).alias("slope"),
        *[F.sum(wrong * F.col("x")[i]).alias(f"slope{i}") for i in range(len(coefficients))],
    )
    terms = [(INTERCEPT, float(model.intercept), "slope")]
    terms += [(n, c, f"slope{i}") for i, (n, c) in enumerate(zip(names, coefficients))]
    found = [
        F.struct(
            F.lit(term).alias("term"),
            F.lit(coefficient).alias("coefficient"),
            (F.col(slope) / F.col("n")).alias("slope"),
            (F.col("loss") / F.col("n")).alias("loss"),
        )
        for term, coefficient, slope in terms
    ]
    return sums.select(F.inline(F.array(*found)))
