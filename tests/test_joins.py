import pytest
from pyspark.sql import functions as F

from tarmac.operators import enrichment
from tarmac.operators.joins import broadcast_if_small, lookup_join, measured_bytes
from tests.conftest import plan, rows


def _fact(spark, n=20000):
    """A third of the rows share one key."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500)
    return spark.range(0, n, 1, 8).select("id", key.cast("string").alias("k"))


def _dimension(spark):
    return spark.range(500).select(F.col("id").cast("string").alias("code"), F.lit("x").alias("name"))


def test_measured_bytes(spark):
    table = spark.createDataFrame([("ab", 1), (None, 2)], "s string, i int")
    assert measured_bytes(table) == [2 * (16 + 8 + 8) + 2]
    assert measured_bytes(table.limit(0), table) == [0, measured_bytes(table)[0]]


def test_small_dimension_is_broadcast_without_moving_the_fact(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = lookup_join(_fact(spark), _dimension(spark), F.col("k") == F.col("code"))
    joined.collect()
    text = plan(joined)
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_large_dimension_is_shuffled_and_a_hot_key_split(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "20000")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "10000")
    conf("spark.sql.shuffle.partitions", "16")
    on = F.col("k") == F.col("code")
    joined = lookup_join(_fact(spark), _dimension(spark), on, limit=100)
    found = rows(joined)
    text = plan(joined)
    assert "BroadcastHashJoin" not in text
    assert "skew=true" in text
    assert found == rows(lookup_join(_fact(spark), _dimension(spark), on))


def test_each_dimension_is_sized_on_its_own(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    small, large = broadcast_if_small(
        _dimension(spark).limit(2), _dimension(spark), limit=200
    )
    joined = _fact(spark).join(small, F.col("k") == small["code"])
    assert "BroadcastHashJoin" in plan(joined)
    joined = _fact(spark).join(large, F.col("k") == large["code"])
    assert "BroadcastHashJoin" not in plan(joined)


@pytest.mark.parametrize("limit", [0, 1 << 26])
def test_enrichment_does_not_depend_on_the_strategy(spark, conf, flights, airports, limit):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = enrichment.enrich_origin_destination(flights, airports, limit)
    assert joined.count() == 9
    assert ("BroadcastHashJoin" in plan(joined)) == (limit > 0)
