from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.operators.ranking import with_rank
from tests.conftest import plan, rows


def _table(spark, n=5000):
    """A third of the rows in one group, many ties."""
    h = F.pmod(F.xxhash64("id"), F.lit(1000))
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), h % 5)).alias("g"),
        (h % 7).cast("double").alias("v"),
        F.lpad(F.col("id").cast("string"), 6, "0").alias("name"),
    )


def test_global_rank_equals_a_window(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    table = _table(spark)
    order = [F.desc("v"), F.asc("name")]
    ranked = with_rank(table, order)
    expected = table.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long"))
    assert rows(ranked) == rows(expected.select(*ranked.columns))
    assert ranked.select("rank").distinct().count() == 5000


def test_group_rank_equals_a_window(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    table = _table(spark)
    order = [F.desc("v"), F.asc("name")]
    ranked = with_rank(table, order, within=["g"])
    window = Window.partitionBy("g").orderBy(*order)
    expected = table.withColumn("rank", F.row_number().over(window).cast("long"))
    assert rows(ranked) == rows(expected.select(*ranked.columns))


def test_hot_group_is_ranked_by_several_tasks(spark, conf):
    conf("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf("spark.sql.shuffle.partitions", "16")
    table = _table(spark)
    placed = table.repartitionByRange("g", F.desc("v"), F.asc("name"))
    parts = placed.withColumn("p", F.spark_partition_id()).filter("g = 'hot'")
    assert parts.select("p").distinct().count() > 3


def test_no_single_partition_window_over_the_rows(spark):
    ranked = with_rank(_table(spark), [F.desc("v"), F.asc("name")])
    ranked.collect()
    text = plan(ranked)
    assert "_range" in [x for x in text.splitlines() if "Window" in x][0]
    assert "row_number" not in text


def test_null_groups_keep_their_rows(spark):
    table = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4)], "g string, v int")
    ranked = with_rank(table, [F.desc("v")], within=["g"])
    assert rows(ranked) == [(1, "a", 3), (1, "b", 4), (1, None, 2), (2, None, 1)]


def test_empty_table(spark):
    assert with_rank(_table(spark).filter("v > 100"), [F.desc("v")]).collect() == []
