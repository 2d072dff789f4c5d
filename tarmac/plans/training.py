"""Training and evaluation of the delay classifiers."""

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.sql import functions as F

from tarmac.constants import LOGISTIC_MAX_ITER, TREE_MAX_DEPTH, TREE_MIN_BINS
from tarmac.operators.encoding import (
    assembler,
    bucketizer,
    check_bucket_bounds,
    compact,
    dealt,
    fit_category_indexer,
    label_indexer,
    normalizer,
    spread,
)
from tarmac.operators.metrics import confusion_metrics, report_lines
from tarmac.operators.sampling import hash_split_weights, random_split
from tarmac.plans.features import read_features
from tarmac.sources.sinks import write_lines
from tarmac.sources.stage import job, keep, shuffle_partitions_for

MODELS = ("tree", "logistic")


def _tree(bins):
    return DecisionTreeClassifier(
        featuresCol="features",
        labelCol="DelayIndex",
        weightCol="weight",
        maxDepth=TREE_MAX_DEPTH,
        maxBins=bins,
    )


def _logistic():
    return LogisticRegression(
        featuresCol="normalized_features",
        labelCol="DelayIndex",
        weightCol="weight",
        maxIter=LOGISTIC_MAX_ITER,
    )


def split_and_compact(features, by_content=True):
    """Train and Test rows in model form, written once so that both sets stay fixed.

    This is the only time the features are read. Values outside the buckets show in the written
    rows, which are few, and fail there.
    """
    with shuffle_partitions_for(features):
        if by_content:
            rows = compact(hash_split_weights(features), "set", weight="weight")
        else:
            rows = compact(random_split(features), "set")
        rows = keep(rows, "training-rows")
    check_bucket_bounds(rows)
    return rows


def fit_encoders(train, model, index_path=None):
    """The stages from compact rows to the model's input vector."""
    stages = [fit_category_indexer(train, "weight", index_path), label_indexer(), assembler()]
    return stages if model == "tree" else [*stages, normalizer()]


def fit_classifier(train, encoders, model):
    """Fit the classifier on encoded compact rows.

    A tree is the same as on single rows, as it sees only sums of weights. It needs at
    least as many bins as the largest category has values, the spare one included.

    A regression has the same optimum as on single rows, but scales its inputs by a
    deviation that weights change slightly, so its last digits may differ.
    """
    if model != "tree":
        return _logistic().fit(dealt(train))
    largest = max(encoders[0].sizes.values()) + 1
    bins = max(TREE_MIN_BINS, largest)
    return _tree(bins).fit(dealt(spread(train, bins)))


def evaluate(classifier, encoded):
    """Accuracy, precision, recall and auc per set, by one pass over the encoded rows."""
    return confusion_metrics(classifier.transform(encoded), by=["set"], weight="weight").select(
        "set", "accuracy", "precision", "recall", "auc"
    )


def train_and_evaluate(features, model, by_content=True, index_path=None):
    """The fitted pipeline, from feature rows to predictions, and its evaluation.

    The features are read once, to split and compact them. The compact rows are encoded once
    and written, for all passes of the training and for the evaluation. The pipeline reads the
    categories from their written index, which ``index_path`` lets outlive a job.
    """
    if model not in MODELS:
        raise ValueError(f"model must be one of {MODELS}, not {model!r}")
    rows = split_and_compact(features, by_content)
    encoders = fit_encoders(rows.filter(F.col("set") == "Train"), model, index_path)
    vector = encoders[-1].getOutputCol()
    encoded = keep(
        PipelineModel(encoders).transform(rows).select("set", vector, "DelayIndex", "weight"),
        "encoded-rows",
    )
    classifier = fit_classifier(encoded.filter(F.col("set") == "Train"), encoders, model)
    fitted = PipelineModel([bucketizer(), *encoders, classifier])
    return fitted, evaluate(classifier, encoded)


def tree_description(spark, fitted):
    """The tree's rules as numbered lines; the depth limit bounds their number."""
    lines = fitted.stages[-1].toDebugString.splitlines()
    return spark.createDataFrame(list(enumerate(lines)), "line_no int, line string")


def run_training(spark, features, output, model, file_format="parquet", by_content=True):
    """Train, evaluate and write the report and the categories, for a tree also its rules.

    The stages are deleted at the end, so a regression's training summary has no rows then.
    """
    table = read_features(spark, features, file_format)
    with job(spark):
        fitted, evaluation = train_and_evaluate(
            table, model, by_content, f"{output}/{model}/categories"
        )
        write_lines(report_lines(evaluation), f"{output}/{model}/model-evaluation")
        if model == "tree":
            write_lines(tree_description(spark, fitted), f"{output}/{model}/tree-model")
    return fitted
