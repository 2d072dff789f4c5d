"""Joins of a large fact with a dimension whose size is measured first."""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql import types as T

# Uncompressed bytes up to which a dimension is sent to every executor.
BROADCAST_LIMIT = 64 * 1024 * 1024
_ROW_OVERHEAD = 16


def _measure(table, name):
    width = F.lit(_ROW_OVERHEAD)
    for field in table.schema.fields:
        width = width + 8
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    return table.agg(
        F.lit(name).alias("name"), F.coalesce(F.sum(width.cast("long")), F.lit(0)).alias("bytes")
    )


def measured_bytes(*tables):
    """Uncompressed size of each table, by one job over all of them."""
    sizes = reduce(
        lambda a, b: a.unionByName(b), [_measure(t, i) for i, t in enumerate(tables)]
    ).collect()
    return [row["bytes"] for row in sorted(sizes, key=lambda row: row["name"])]


def broadcast_if_small(*dimensions, limit=BROADCAST_LIMIT):
    """The dimensions, with a broadcast hint on each that is measured to fit.

    One over the limit is joined by a shuffle of both sides; AQE then splits the
    partition of a hot key over several tasks.
    """
    sizes = measured_bytes(*dimensions)
    return [F.broadcast(d) if size <= limit else d for d, size in zip(dimensions, sizes)]


def lookup_join(fact, dimension, on, limit=BROADCAST_LIMIT):
    """Inner join that leaves the fact where it is while the dimension is small.

    Duplicate dimension keys fan out.
    """
    return fact.join(broadcast_if_small(dimension, limit=limit)[0], on, "inner")
