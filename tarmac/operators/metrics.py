"""Quality of hard 0/1 predictions, by one aggregate instead of one job per count."""

from pyspark.sql import functions as F


def confusion_counts(predictions, prediction="prediction", label="DelayIndex", by=(), weight=None):
    """Rows per kind of hit and miss; ``weight`` names a column of repeat counts."""
    hit, late = F.col(prediction) == 1, F.col(label) == 1
    times = F.lit(1) if weight is None else F.col(weight)

    def count(condition):
        return F.coalesce(F.sum(F.when(condition, times)), F.lit(0)).cast("long")

    return predictions.groupBy(*by).agg(
        count(hit & late).alias("tp"),
        count(hit & ~late).alias("fp"),
        count(~hit & late).alias("fn"),
        count(~hit & ~late).alias("tn"),
    )


def area_under_roc(tp, fp, fn, tn):
    """Area under the ROC curve that a single threshold gives.

    Without late flights it is 0, with nothing else 1, for no flights at all null.
    """
    late, on_time = tp + fn, fp + tn
    return (
        F.when(late + on_time == 0, None)
        .when(late == 0, F.lit(0.0))
        .when(on_time == 0, F.lit(1.0))
        .otherwise((F.try_divide(tp, late) + F.try_divide(tn, on_time)) / 2)
    )


def confusion_metrics(
    predictions, prediction="prediction", label="DelayIndex", by=(), weight=None
):
    """Counts with accuracy, precision, recall and auc; a ratio over nothing is null."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return confusion_counts(predictions, prediction, label, by, weight).select(
        *by,
        "tp",
        "fp",
        "fn",
        "tn",
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        area_under_roc(tp, fp, fn, tn).alias("auc"),
    )


def report_lines(evaluation):
    """The evaluation as numbered text lines, one block of lines per set."""
    # Fixed format of the report.
    labels = (
        ("Accuracy ({}): ", "accuracy"),
        ("Precision ({}): ", "precision"),
        ("Recall ({}):  ", "recall"),
        ("Area under ROC curve ({}): ", "auc"),
    )
    first = F.when(F.col("set") == "Train", 0).otherwise(100)
    entries = [F.struct(first.alias("line_no"), F.lit("").alias("line"))]
    for position, (label, metric) in enumerate(labels, start=1):
        before, after = label.split("{}")
        value = F.coalesce(F.col(metric).cast("string"), F.lit("NaN"))
        entries.append(
            F.struct(
                (first + position).alias("line_no"),
                F.concat(F.lit(before), F.col("set"), F.lit(after), value).alias("line"),
            )
        )
    return evaluation.select(F.inline(F.array(*entries)))
