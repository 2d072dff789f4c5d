"""From clean tables to the two leaderboards, written as CSV in rank order."""

from tarmac.operators.leaderboards import (
    airline_delay_statistic,
    airport_slot_taxi_statistic,
)
from tarmac.plans.preprocessing import read_clean
from tarmac.schemas import AIRLINE_STATISTIC, AIRPORT_STATISTIC
from tarmac.sources.csv_tables import read_positional_csv
from tarmac.sources.sinks import show_table, write_csv
from pyspark.sql import functions as F


def run_airline_leaderboard(
    spark, clean, output, file_format="parquet", files=None, show=False
):
    result = airline_delay_statistic(
        read_clean(spark, clean, "flights", file_format),
        read_clean(spark, clean, "airlines", file_format),
    )
    order = [F.desc("average_delay"), F.asc("airline")]
    write_csv(result, f"{output}/airlines", files=files, order=order)
    if show:
        show_table(read_positional_csv(spark, f"{output}/airlines", AIRLINE_STATISTIC))


def run_airport_leaderboard(
    spark, clean, output, file_format="parquet", files=None, show=False
):
    result = airport_slot_taxi_statistic(
        read_clean(spark, clean, "flights", file_format),
        read_clean(spark, clean, "airports", file_format),
    )
    order = [F.desc("average_taxi_out"), F.asc("airport"), F.asc("time_slot")]
    write_csv(result, f"{output}/airports", files=files, order=order)
    if show:
        show_table(read_positional_csv(spark, f"{output}/airports", AIRPORT_STATISTIC))


def read_statistics(spark, output):
    """Both written leaderboards, typed."""
    return (
        read_positional_csv(spark, f"{output}/airlines", AIRLINE_STATISTIC),
        read_positional_csv(spark, f"{output}/airports", AIRPORT_STATISTIC),
    )
