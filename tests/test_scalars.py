import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.functions import rules, scalars, sql_names
from tarmac.functions.sql_names import register_sql_functions

SLOTS = [
    ("0000", "Night"), ("0559", "Night"), ("0600", "Morning"), ("1159", "Morning"),
    ("1200", "Afternoon"), ("1759", "Afternoon"), ("1800", "Evening"), ("2359", "Evening"),
    ("2400", "Evening"), ("9900", "Evening"), ("-100", "Evening"), ("05", "Night"),
]


def test_time_slot_edges(spark):
    table = spark.createDataFrame(SLOTS, "t string, expected string")
    wrong = table.withColumn("slot", scalars.time_slot("t")).filter("slot != expected")
    assert wrong.collect() == []


@pytest.mark.parametrize("text", ["ab12", "5", "", " 512", "5:12", None])
def test_time_without_hour_fails(spark, text):
    table = spark.createDataFrame([(text,)], "t string")
    with pytest.raises(Exception, match="no hour in departure time"):
        table.select(scalars.time_slot("t")).collect()
    register_sql_functions(spark)
    table.createOrReplaceTempView("times")
    with pytest.raises(Exception, match="no hour in departure time"):
        spark.sql("SELECT extractTimeSlot(t) FROM times").collect()


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 2400), min_size=1, max_size=50))
def test_time_slot_follows_the_hour(times):
    from pyspark.sql import SparkSession

    session = SparkSession.getActiveSession()
    names = ["Night", "Morning", "Afternoon", "Evening", "Evening"]
    table = session.createDataFrame([(f"{t:04d}", names[t // 600]) for t in times], "t string, s string")
    assert table.filter(scalars.time_slot("t") != F.col("s")).count() == 0


def test_ordinals(spark):
    table = spark.createDataFrame([(i,) for i in range(4)], "i int")
    names = [r[0] for r in table.select(scalars.slot_from_ordinal("i")).collect()]
    assert names == ["Morning", "Afternoon", "Evening", "Night"]
    back = table.select(scalars.slot_ordinal(rules.slot_from_ordinal("i")))
    assert [r[0] for r in back.collect()] == [0, 1, 2, 3]
    for bad in (-1, 4):
        with pytest.raises(Exception, match="no time slot"):
            spark.range(1).select(scalars.slot_from_ordinal(str(bad))).collect()
    unknown = spark.range(1).select(scalars.slot_ordinal("'Noon'")).first()[0]
    assert unknown is None


def test_delay_label(spark):
    table = spark.createDataFrame([(-1,), (0,), (1,), (None,)], "d int")
    labels = [r[0] for r in table.select(scalars.delay_label("d")).collect()]
    assert labels == [0.0, 0.0, 1.0, None]


def test_areas(spark):
    values = [-60.0, -45.0, -30.01, -30.0, 0.0, float("nan")]
    table = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in table.select(scalars.latitude_area("x")).collect()] == [
        0, 0, 0, 3, 3, 3
    ]
    values = [-131.0, -130.0, -111.0, -110.0, -91.0, -90.0, 10.0]
    table = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in table.select(scalars.longitude_area("x")).collect()] == [
        0, 1, 1, 2, 2, 3, 3
    ]


def test_double_or_default(spark):
    table = spark.createDataFrame([("1.5",), ("x",), ("",), (None,)], "s string")
    found = [r[0] for r in table.select(scalars.double_or_default("s")).collect()]
    assert found == [1.5, -80.0, -80.0, -80.0]


@pytest.mark.parametrize("cast", [scalars.strict_double, scalars.strict_int])
def test_strict_numbers_fail_on_bad_text(spark, cast):
    table = spark.createDataFrame([("12",), ("x1",)], "s string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        table.select(cast("s")).collect()


def test_sql_functions_equal_columns(spark):
    register_sql_functions(spark)
    table = spark.createDataFrame(
        [(t, n, float(x)) for (t, _), n, x in zip(SLOTS, range(-3, 9), range(-150, 90, 20))],
        "t string, n int, x double",
    )
    table.createOrReplaceTempView("inputs")
    by_name = spark.sql(
        """SELECT extractTimeSlot(t), extractDelayLabel(n), extractLatitudeArea(x),
                  extractLongitudeArea(x), stringToInt(cast(n AS string)), intToDouble(n),
                  stringToDouble('x') FROM inputs"""
    )
    by_column = table.select(
        scalars.time_slot("t"),
        scalars.delay_label("n").cast("int").cast("string"),
        scalars.latitude_area("x").cast("string"),
        scalars.longitude_area("x").cast("string"),
        "n",
        scalars.int_to_double("n"),
        F.lit(-80.0),
    )
    assert [tuple(r) for r in by_name.collect()] == [tuple(r) for r in by_column.collect()]


def test_strict_sql_double(spark):
    register_sql_functions(spark, strict_double=True)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.sql("SELECT stringToDouble(s) FROM VALUES ('x') AS t(s)").collect()
    register_sql_functions(spark)
    row = spark.sql(
        "SELECT stringToDouble(s), stringToDouble('1.5', true) FROM VALUES ('x') AS t(s)"
    ).first()
    assert tuple(row) == (-80.0, 1.5)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.sql("SELECT stringToDouble(s, true) FROM VALUES ('x') AS t(s)").collect()


def test_one_text_for_each_rule(spark):
    """What a function is registered with is the text its column is made of."""
    assert rules.time_slot("hhmm") in sql_names._FUNCTIONS[
        "extractTimeSlot(hhmm STRING) RETURNS STRING"
    ]
    for name in ("latitude_area", "longitude_area"):
        text = getattr(rules, name)(name.partition("_")[0])
        assert any(text in body for body in sql_names._FUNCTIONS.values())
