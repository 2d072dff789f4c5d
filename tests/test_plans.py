"""Shapes of the physical plans that matter at scale."""

from pyspark.sql import functions as F

from tarmac import schemas
from tarmac.operators import cleaning, enrichment, leaderboards
from tarmac.plans.features import build_features
from tarmac.sources import binding, stage
from tarmac.sources.csv_tables import read_header_csv
from tarmac.sources.sinks import write_csv
from tests.conftest import DATA, plan, rows


def test_filters_and_columns_reach_a_parquet_scan(spark, conf, flights, tmp_path):
    conf("spark.sql.maxMetadataStringLength", "1000")
    path = str(tmp_path / "flights")
    flights.write.parquet(path)
    text = plan(leaderboards.airline_delay_state(cleaning.clean_flights(spark.read.parquet(path))))
    assert "EqualTo(CANCELLED,0)" in text and "EqualTo(DIVERTED,0)" in text
    schema = text[text.index("ReadSchema"):].split(">")[0]
    for unused in ("TAXI_OUT", "DISTANCE", "SCHEDULED_DEPARTURE"):
        assert unused not in schema


def test_averages_are_summed_before_the_shuffle(spark):
    text = plan(leaderboards.airline_delay_state(binding.flights_raw(spark, DATA)))
    assert "partial_sum" in text


def test_line_items_are_shuffled_once(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    text = plan(binding.flights_raw(spark, DATA))
    exchanges = [x for x in text.splitlines() if "Exchange hashpartitioning" in x]
    assert len([x for x in exchanges if "l_orderkey" in x]) == 1
    assert len(exchanges) == 4


def test_all_suppliers_describe_their_airport(spark, tmp_path):
    """Suppliers that share a code are one airport, and none vanishes from it."""
    folder = str(tmp_path)
    spark.range(5000).select(
        F.col("id").alias("s_suppkey"),
        F.concat(F.lit("s"), F.col("id")).alias("s_name"),
        (F.col("id") % 25).cast("int").alias("s_nationkey"),
    ).write.parquet(f"{folder}/supplier.parquet")
    spark.read.parquet(f"{DATA}/nation.parquet").write.parquet(f"{folder}/nation.parquet")
    found = binding.airports_raw(spark, folder)
    assert found.count() == found.select("IATA_CODE").distinct().count() == 1000
    assert found.filter("IATA_CODE = '007'").first().AIRPORT == "s1007 and 4"


def test_the_slot_is_worked_out_once(spark, flights, airports):
    """Its test for null would repeat the whole expression in the filter."""
    text = plan(
        leaderboards.airport_slot_taxi_statistic(cleaning.clean_flights(flights), airports)
    )
    assert "isnotnull(CASE" not in text and "isnotnull(coalesce(CASE" not in text


def test_filters_and_columns_reach_a_csv_scan(spark, conf, flights, tmp_path):
    conf("spark.sql.maxMetadataStringLength", "1000")
    path = str(tmp_path / "flights.csv")
    write_csv(flights, path, header=True)
    raw = read_header_csv(spark, path, schemas.RAW_FLIGHTS.names)
    text = plan(leaderboards.airline_delay_state(cleaning.clean_flights(raw)))
    assert "EqualTo(CANCELLED,0)" in text and "EqualTo(DIVERTED,0)" in text
    schema = text[text.index("ReadSchema"):].split(">")[0]
    for unused in ("TAXI_OUT", "DISTANCE", "SCHEDULED_DEPARTURE"):
        assert unused not in schema


def test_flights_are_parsed_once_and_read_twice(spark, conf, flights, airlines, airports):
    """Raw rows pass one time; the typed stage feeds the state and the features."""
    conf("spark.sql.maxMetadataStringLength", "1000")
    passed = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch

    counted = flights.mapInArrow(count, flights.schema)
    with stage.job(spark):
        features = build_features(counted, airlines, airports)
        text = plan(features)
        assert features.count() == 6
    assert passed.value == flights.count()
    assert text.count("arrival_delay:int") == 1 and ",taxi_out:double" not in text
    assert "MapInArrow" not in text and text.count("SCHEDULED_DEPARTURE") == 0


def test_statistics_roll_up_from_one_state(flights, airlines, airports):
    clean = cleaning.clean_flights(flights)
    state = leaderboards.delay_and_taxi_state(
        enrichment.feature_facts(cleaning.feature_flights(flights))
    )
    by_airline, by_airport = leaderboards.statistics_of_state(state, airlines, airports)
    assert rows(by_airline) == rows(leaderboards.airline_delay_statistic(clean, airlines))
    expected = leaderboards.airport_slot_taxi_statistic(clean, airports)
    assert rows(by_airport) == rows(expected.select(by_airport.columns))
