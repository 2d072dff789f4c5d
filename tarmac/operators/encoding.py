"""Model inputs: buckets, indexed categories, assembled and normalized vectors."""

from pyspark.ml import Transformer
from pyspark.ml.feature import (
    Bucketizer,
    Normalizer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import functions as F

from tarmac.constants import (
    AVERAGE_DELAY_SPLITS,
    DISTANCE_SPLITS,
    FEATURE_ORDER,
    TAXI_OUT_SPLITS,
)
from tarmac.operators.joins import BROADCAST_LIMIT
from tarmac.operators.ranking import with_rank
from tarmac.sources.stage import keep

CATEGORIES = ("Airline", "TimeSlot", "OriginState", "DestinationState", "OriginAirport")
BUCKETS = {
    "Distance": DISTANCE_SPLITS,
    "AverageAirlineDelay": AVERAGE_DELAY_SPLITS,
    "AverageTaxiOut": TAXI_OUT_SPLITS,
}


def bucketizer(*columns):
    columns = columns or tuple(BUCKETS)
    return Bucketizer(
        inputCols=list(columns),
        outputCols=[f"{c}Bucketed" for c in columns],
        splitsArray=[BUCKETS[c] for c in columns],
    )


OUTSIDE = -1.0
# Rows that a task of a training holds decoded, at some 150 bytes each.
TASK_ROWS = 250_000
# Bytes of an index row besides its name.
_ROW_BYTES = 40


def _nominal(name, values):
    """Tells a model that a column holds categories 0, 1, ..., and how many."""
    return {"ml_attr": {"type": "nominal", "name": name, "num_vals": values}}


def bucket(column):
    """Number of the bucket of a value; ``OUTSIDE`` if it is missing, no number or too low."""
    number = F.when(F.isnan(column), F.lit(OUTSIDE))
    for position in reversed(range(len(BUCKETS[column]) - 1)):
        number = number.when(F.col(column) >= BUCKETS[column][position], F.lit(float(position)))
    return number.otherwise(OUTSIDE)


def check_bucket_bounds(compact_rows):
    """Fail with column names and counts if compact rows stand for values outside the buckets."""
    outside = compact_rows.agg(
        *[
            F.coalesce(F.sum(F.when(F.col(f"{c}Bucketed") == OUTSIDE, F.col("weight"))), F.lit(0))
            .cast("long")
            .alias(c)
            for c in BUCKETS
        ]
    ).first()
    found = {c: outside[c] for c in BUCKETS if outside[c]}
    if found:
        raise ValueError(f"rows outside the bucket bounds, per column: {found}")


def compact(features, *keep_columns, weight=None):
    """Features in buckets, equal rows as one row with their number as ``weight``.

    All model inputs are categories or small whole numbers, so the table shrinks from
    one row per flight to one per combination, and each later pass of a training reads
    the small table. Partial counts before the shuffle take care of frequent rows. ``weight``
    names a column of repeat counts that the rows have already.
    """
    number = F.count("*") if weight is None else F.sum(weight)
    inputs = {c.removesuffix("Index") for c in FEATURE_ORDER}
    buckets = [
        bucket(c).alias(f"{c}Bucketed", metadata=_nominal(f"{c}Bucketed", len(splits) - 1))
        for c, splits in BUCKETS.items()
    ]
    bucketed = features.select("*", *buckets)
    return bucketed.groupBy(*keep_columns, *sorted(inputs), "Delay").agg(
        number.alias("weight")
    )


def spread(rows, least_rows):
    """Compact rows with their weight split over more rows, if they are fewer than asked.

    A tree takes no more bins than it sees rows. Weights stay whole, so sums stay exact.
    """
    if rows.limit(least_rows).count() >= least_rows:
        return rows
    parts = F.least(F.col("weight"), F.lit(least_rows))
    part = F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part")
    others = [c for c in rows.columns if c != "weight"]
    share = F.expr("weight div parts") + (F.col("part") < F.col("weight") % F.col("parts")).cast("long")
    return rows.withColumn("parts", parts).select("*", part).select(*others, share.alias("weight"))


def dealt(rows):
    """Training rows in partitions of bounded size.

    A training keeps its rows decoded and reads each partition whole in every pass. A file's
    part of bounded bytes can hold any number of compact rows, as they compress well.
    """
    number = rows.count()
    if number <= TASK_ROWS:
        return rows
    parts = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(parts, -(-number // TASK_ROWS)))


def category_counts(table, weight=None):
    """Rows per column and category; ``weight`` names a column of repeat counts."""
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in CATEGORIES
    ]
    times = F.lit(1) if weight is None else F.col(weight)
    return (
        table.select(F.inline(F.array(*pairs)), times.alias("times"))
        .filter("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(F.sum("times").alias("n"))
    )


def category_index(table, weight=None, path=None):
    """(column, value, index): categories by falling frequency, ties by name, from 0 on.

    Ranked without a task that sees all names of a column, and written, at ``path`` if given.
    """
    order = [F.desc("n"), F.asc("value")]
    ranked = with_rank(category_counts(table, weight), order, ["column"])
    index = (F.col("rank") - 1).cast("double").alias("index")
    return keep(ranked.select("column", "value", index), "category-index", path=path)


class CategoryIndexer(Transformer):
    """Adds the index of each category; an unseen or missing one gets a spare index.

    The names stay in a table that is joined, a column's part being broadcast only if it is
    measured to fit. The driver knows their numbers alone, which the index columns carry as
    metadata.
    """

    def __init__(self, index, limit=BROADCAST_LIMIT):
        super().__init__()
        self.index, self.limit = index, limit
        width = F.octet_length("value").cast("long") + _ROW_BYTES
        found = index.groupBy("column").agg(F.count("*").alias("n"), F.sum(width).alias("bytes"))
        found = {r["column"]: r for r in found.collect()}
        self.sizes = {c: found[c]["n"] if c in found else 0 for c in CATEGORIES}
        self.bytes = {c: found[c]["bytes"] if c in found else 0 for c in CATEGORIES}

    def _transform(self, dataset):
        indexed = dataset
        for c in CATEGORIES:
            lookup = self.index.where(F.col("column") == c).select(
                F.col("value").alias(f"{c}Value"), F.col("index").alias(f"{c}Found")
            )
            if self.bytes[c] <= self.limit:
                lookup = F.broadcast(lookup)
            indexed = indexed.join(lookup, F.col(c) == F.col(f"{c}Value"), "left")
        return indexed.select(
            *dataset.columns,
            *[
                F.coalesce(f"{c}Found", F.lit(float(self.sizes[c]))).alias(
                    f"{c}Index", metadata=_nominal(f"{c}Index", self.sizes[c] + 1)
                )
                for c in CATEGORIES
            ],
        )


def fit_category_indexer(table, weight=None, path=None):
    """The indexer of a table's categories; ``path`` says where their index is to stay."""
    return CategoryIndexer(category_index(table, weight, path))


def label_indexer():
    """Index of the label; 1 always means late, whichever label is more frequent."""
    return StringIndexerModel.from_labels(
        ["0.0", "1.0"], inputCol="Delay", outputCol="DelayIndex", handleInvalid="error"
    )


def assembler():
    return VectorAssembler(inputCols=list(FEATURE_ORDER), outputCol="features")


def normalizer():
    return Normalizer(inputCol="features", outputCol="normalized_features", p=2.0)
