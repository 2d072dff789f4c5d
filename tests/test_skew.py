"""Keys that hold a third of all rows, more suppliers than codes, and forced shuffles."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tarmac.operators import cleaning, enrichment, leaderboards
from tarmac.sources import binding
from tests.conftest import DATA, plan, rows
from tools.compare import compare, connect

TABLES = ("nation", "supplier", "customer", "orders", "lineitem")
LINES = 12_000


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A third of the lines in one order, of one supplier; a third of the orders of one customer."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    number = lambda seed, n: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n))
    hot = lambda key: F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(key).cast("long")
    pick = lambda seed, *texts: F.element_at(
        F.array(*[F.lit(t) for t in texts]), (number(seed, len(texts)) + 1).cast("int")
    )
    tables = {
        "nation": spark.read.parquet(f"{DATA}/nation.parquet"),
        "supplier": spark.range(2500).select(
            F.col("id").alias("s_suppkey"),
            F.format_string("Supplier#%06d", "id").alias("s_name"),
            number(1, 25).cast("int").alias("s_nationkey"),
        ),
        "customer": spark.range(100).select(
            F.col("id").alias("c_custkey"), number(2, 25).cast("int").alias("c_nationkey")
        ),
        "orders": spark.range(1000).select(
            F.col("id").alias("o_orderkey"), hot(number(3, 100)).alias("o_custkey")
        ),
        "lineitem": spark.range(0, LINES, 1, 6).select(
            hot(number(4, 1000)).alias("l_orderkey"),
            number(5, 200).alias("l_partkey"),
            hot(number(6, 2500)).alias("l_suppkey"),
            (number(7, 7) + 1).cast("int").alias("l_linenumber"),
            (number(8, 50) + 1).cast("double").alias("l_quantity"),
            (number(9, 9_000_000) / 100).alias("l_extendedprice"),
            (number(10, 11) / 100).alias("l_discount"),
            (number(11, 9) / 100).alias("l_tax"),
            pick(12, "R", "A", "N").alias("l_returnflag"),
            pick(13, "F", "O").alias("l_linestatus"),
            F.timestamp_seconds(number(14, 100_000_000) + 800_000_000)
            .cast("timestamp_ntz")
            .alias("l_shipdate"),
        ),
    }
    for name, table in tables.items():
        table.write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.mark.parametrize(
    "name",
    [
        "flights_raw",
        "clean_airports",
        "airline_delay_leaderboard",
        "airport_slot_taxi_leaderboard",
        "airport_rank_within_slot",
        "enrich_airport_stats",
        "feature_table",
        "string_index",
        "split_hash_70_30",
    ],
)
def test_skewed_tables(spark, conf, folder, name):
    for key, value in (
        ("spark.sql.autoBroadcastJoinThreshold", "-1"),
        ("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"),
        ("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "10000"),
        ("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5"),
        ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10000"),
        ("spark.sql.shuffle.partitions", "8"),
    ):
        conf(key, value)
    table = registry.queries()[name](spark, folder)
    assert compare(connect(folder, TABLES), table, name) is None
    if name == "flights_raw":
        assert table.count() == LINES
        assert "skew=true" in plan(table)


def test_shuffled_features_equal_broadcast_ones(spark, conf, folder):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    flights = cleaning.feature_flights(binding.flights_raw(spark, folder))
    airlines, airports = binding.airlines_raw(spark, folder), binding.airports_raw(spark, folder)
    airline_statistic = leaderboards.airline_delay_statistic(flights, airlines)
    airport_statistic = leaderboards.airport_slot_taxi_statistic(flights, airports)
    found = []
    for limit in (0, 1 << 26):
        table = enrichment.feature_table(
            flights, airlines, airports, airline_statistic, airport_statistic, limit
        )
        found.append(rows(table))
    assert len(found[0]) > 0 and found[0] == found[1]
