"""Ranks over tables of any size, without a window over the rows."""

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.operators.joins import broadcast_if_small
from tarmac.sources.stage import keep


def with_rank(table, order, within=(), rank="rank"):
    """Add the 1-based position of each row by ``order`` inside its ``within`` group.

    The rows are range-partitioned by the sort key, sorted and numbered while they are
    written as a stage. A row's rank follows from its number, the first number of its
    group in its range, and the group's rows in earlier ranges. A group that spans
    several ranges is thus numbered by several tasks. ``within`` holds column names; null is
    a group like any other.
    """
    within = list(within)
    keys = [F.col(c) for c in within] + list(order)
    placed = keep(
        table.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumns({"_range": F.spark_partition_id(), "_row": F.monotonically_increasing_id()}),
        "ranked",
    )
    earlier = (
        Window.partitionBy(*within)
        .orderBy("_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    # One row per range and group, so the window without groups sees few rows.
    parts = placed.groupBy("_range", *within).agg(
        F.count("*").alias("_count"), F.min("_row").alias("_first")
    )
    before = F.coalesce(F.sum("_count").over(earlier), F.lit(0))
    parts = parts.select(
        F.col("_range").alias("_part"),
        *[F.col(c).alias(f"_in{i}") for i, c in enumerate(within)],
        (before - F.col("_first") + 1).alias("_offset"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_in{i}")) for i, c in enumerate(within)]
    on = reduce(lambda a, b: a & b, same, F.col("_range") == F.col("_part"))
    return (
        placed.join(broadcast_if_small(parts)[0], on)
        .withColumn(rank, F.col("_row") + F.col("_offset"))
        .select(rank, *table.columns)
    )
