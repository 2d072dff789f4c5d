"""Diagnostics of a table: schema, first rows, descriptive statistics."""

from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_rows(table, rows=5):
    return table.limit(rows)


def print_overview(table, rows=5):
    """Schema, first rows and descriptive statistics on the console."""
    table.printSchema()
    first_rows(table, rows).show(truncate=False)
    describe_columns(table).show(len(table.columns), truncate=False)


def describe_columns(table):
    """One row per column: count, mean, stddev and extremes, by one pass over the table.

    Extremes of numbers and of texts have separate columns, so both keep their type.
    """
    described = []
    for field in table.schema.fields:
        column = F.col(field.name)
        text = isinstance(field.dataType, T.StringType)
        number, string = F.lit(None).cast("double"), F.lit(None).cast("string")
        described.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.count(column).alias("n"),
                (number if text else F.avg(column)).alias("mean"),
                (number if text else F.stddev_samp(column)).alias("stddev"),
                (number if text else F.min(column).cast("double")).alias("min_number"),
                (number if text else F.max(column).cast("double")).alias("max_number"),
                (F.min(column) if text else string).alias("min_text"),
                (F.max(column) if text else string).alias("max_text"),
            )
        )
    return table.agg(F.array(*described).alias("rows")).select(F.inline("rows"))
