"""Hand-computed results on ten flights."""

from pyspark.sql import functions as F

from tarmac.operators import cleaning, encoding, enrichment, leaderboards, summary
from tarmac.plans.features import build_features
from tarmac.sources import binding
from tests.conftest import AIRLINES, DATA, FLIGHTS, rows


def kept(number):
    return FLIGHTS[number - 1]


def test_clean_flights_keep_seven_rows(flights):
    clean = cleaning.clean_flights(flights)
    assert clean.columns == [
        "AIRLINE", "ORIGIN_AIRPORT", "SCHEDULED_DEPARTURE", "TAXI_OUT", "ARRIVAL_DELAY"
    ]
    expected = [
        (r[0], r[1], r[3], r[7], r[8]) for r in map(kept, [1, 2, 3, 4, 5, 6, 10])
    ]
    assert rows(clean) == sorted(expected, key=repr)


def test_null_in_a_tested_column_drops_the_row(flights):
    for column in ("ORIGIN_AIRPORT", "CANCELLED", "DIVERTED"):
        blanked = flights.withColumn(column, F.lit(None).cast("string"))
        assert cleaning.clean_flights(blanked).count() == 0


def test_clean_dimensions(airlines, airports):
    assert rows(cleaning.clean_airlines(airlines)) == sorted(AIRLINES)
    assert cleaning.clean_airports(airports).columns == ["IATA_CODE", "AIRPORT"]


def test_airline_leaderboard(flights, airlines):
    board = leaderboards.airline_delay_leaderboard(cleaning.clean_flights(flights), airlines)
    assert [tuple(r) for r in board.collect()] == [
        (1, "American", 5.0),
        (2, "Blue, Inc.", 1.5),
        (3, "Coastal", -1.0),
    ]


def test_sql_text_gives_the_same_averages(flights, airlines):
    board = leaderboards.airline_delay_sql(cleaning.clean_flights(flights), airlines)
    assert [tuple(r) for r in board.collect()] == [
        ("American", 5.0), ("Blue, Inc.", 1.5), ("Coastal", -1.0)
    ]


def test_airport_leaderboard_breaks_ties_by_name(flights, airports):
    board = leaderboards.airport_slot_taxi_leaderboard(cleaning.clean_flights(flights), airports)
    assert [tuple(r) for r in board.collect()] == [
        (1, "Charlie", "Evening", 30.0),
        (2, "Alpha Field", "Morning", 18.0),
        (3, "Alpha Field", "Night", 12.0),
        (4, "Bravo, Intl", "Afternoon", 12.0),
        (5, "Bravo, Intl", "Evening", 8.0),
    ]


def test_rank_within_slot(flights, airports):
    board = leaderboards.airport_rank_within_slot(cleaning.clean_flights(flights), airports)
    assert [tuple(r)[:3] for r in board.collect()] == [
        (1, "Bravo, Intl", "Afternoon"),
        (1, "Charlie", "Evening"),
        (2, "Bravo, Intl", "Evening"),
        (1, "Alpha Field", "Morning"),
        (1, "Alpha Field", "Night"),
    ]


def test_states_hold_sum_count_and_average(flights):
    clean = cleaning.clean_flights(flights)
    assert rows(leaderboards.airline_delay_state(clean)) == [
        ("AA", 15.0, 3, 5.0), ("BB", 3.0, 2, 1.5), ("CC", -1.0, 1, -1.0), ("ZZ", 7.0, 1, 7.0)
    ]
    assert ("AAA", "Night", 24.0, 2, 12.0) in rows(leaderboards.airport_slot_taxi_state(clean))


def test_merged_states_equal_the_state_of_all(flights):
    clean = cleaning.clean_flights(flights)
    parts = [clean.filter("TAXI_OUT < 12"), clean.filter("TAXI_OUT >= 12")]
    merged = leaderboards.merge_states(
        [leaderboards.airport_slot_taxi_state(p) for p in parts], ["ORIGIN_AIRPORT", "time_slot"]
    )
    assert rows(merged) == rows(leaderboards.airport_slot_taxi_state(clean))


def test_blank_measures_do_not_count(flights, airlines):
    clean = cleaning.clean_flights(flights)
    blank = clean.withColumn(
        "ARRIVAL_DELAY", F.when(F.col("ARRIVAL_DELAY") != "15", F.col("ARRIVAL_DELAY"))
    )
    assert ("American", 0.0) in rows(leaderboards.airline_delay_statistic(blank, airlines))
    assert ("AA", 0.0, 2, 0.0) in rows(leaderboards.airline_delay_state(blank))


def test_feature_table(flights, airlines, airports):
    features = build_features(flights, airlines, airports)
    by_departure = {
        (r.Airline, r.Month, r.DayOfWeek): r for r in features.collect()
    }
    assert len(by_departure) == features.count() == 6
    order = [("AA", 1, 1), ("AA", 1, 2), ("BB", 2, 3), ("BB", 2, 4), ("AA", 3, 5), ("CC", 3, 6)]
    found = [by_departure[k] for k in order]
    assert [r.Delay for r in found] == [0, 1, 1, 0, 1, 0]
    assert [r.TimeSlot for r in found] == [
        "Night", "Morning", "Afternoon", "Evening", "Night", "Evening"
    ]
    areas = {
        r.OriginAirport: (r.OriginLatitudeArea, r.OriginLongitudeArea, r.OriginState)
        for r in found
    }
    assert areas == {"AAA": (3, 3, "NY"), "BBB": (0, 0, "AK"), "CCC": (0, 3, "PR")}
    assert found[1].DestinationState == "PR" and found[1].DestinationLatitudeArea == 0
    assert [r.AverageAirlineDelay for r in found] == [5.0, 5.0, 1.5, 1.5, 5.0, -1.0]
    assert [r.AverageTaxiOut for r in found] == [12, 18, 12, 8, 12, 30]

    buckets = encoding.bucketizer().transform(features)
    found = {
        (r.Airline, r.Month, r.DayOfWeek): r for r in buckets.collect()
    }
    found = [found[k] for k in order]
    assert [r.DistanceBucketed for r in found] == [0, 1, 14, 14, 2, 0]
    assert [r.AverageAirlineDelayBucketed for r in found] == [2, 2, 0, 0, 2, 0]
    assert [r.AverageTaxiOutBucketed for r in found] == [2, 3, 2, 1, 2, 5]


def test_feature_table_equals_the_joins_one_by_one(flights, airlines, airports):
    clean = cleaning.clean_flights(flights)
    airline_statistic = leaderboards.airline_delay_statistic(clean, airlines)
    airport_statistic = leaderboards.airport_slot_taxi_statistic(clean, airports)
    usable = cleaning.feature_flights(flights)
    joined = enrichment.enrich_airport_stats(
        enrichment.enrich_airline_stats(
            enrichment.enrich_airline(
                enrichment.enrich_origin_destination(usable, airports), airlines
            ),
            airline_statistic,
        ),
        airport_statistic,
    )
    stepwise = joined.select(
        "AIRLINE", "TIME_SLOT", F.col("DISTANCE").cast("double"), "ORIGIN_STATE",
        "DESTINATION_STATE", "ORIGIN_AIRPORT", "STATISTICS_AVG_DELAY", "AVG_TAXI_OUT",
    )
    table = enrichment.feature_table(
        usable, airlines, airports, airline_statistic, airport_statistic
    ).select(
        "Airline", "TimeSlot", "Distance", "OriginState", "DestinationState", "OriginAirport",
        "AverageAirlineDelay", "AverageTaxiOut",
    )
    assert rows(table) == rows(stepwise)


def test_equal_names_fan_out(spark, flights, airlines, airports):
    """Statistics are found by name, so two airlines of one name see both averages."""
    namesakes = spark.createDataFrame(
        [("AA", "American"), ("BB", "American"), ("CC", "Coastal")], airlines.schema
    )
    features = build_features(flights, namesakes, airports)
    assert features.count() == 3 * 2 + 2 * 2 + 1
    assert {
        r.AverageAirlineDelay for r in features.filter("Airline = 'BB'").collect()
    } == {5.0, 1.5}


def test_duplicate_codes_fan_out(flights, airlines):
    doubled = airlines.union(airlines.filter("IATA_CODE = 'AA'").withColumn("AIRLINE", F.lit("Other")))
    statistic = leaderboards.airline_delay_statistic(cleaning.clean_flights(flights), doubled)
    assert ("American", 5.0) in rows(statistic) and ("Other", 5.0) in rows(statistic)


def test_describe_columns(flights):
    described = {r.column: r for r in summary.describe_columns(
        cleaning.typed_measures(cleaning.clean_flights(flights))).collect()}
    taxi = described["TAXI_OUT"]
    assert (taxi.n, taxi.mean, taxi.min_number, taxi.max_number) == (7, 110 / 7, 8.0, 30.0)
    assert described["AIRLINE"].min_text == "AA" and described["AIRLINE"].mean is None


def test_overview(flights, capsys):
    summary.print_overview(flights)
    shown = capsys.readouterr().out
    assert "|-- ORIGIN_AIRPORT: string" in shown and "max_text" in shown


def test_first_rows(flights):
    assert summary.first_rows(flights).count() == 5


def test_any_fact_and_dimension(spark):
    """The operators know flights only by their default columns."""
    nations = spark.read.parquet(f"{DATA}/nation.parquet")
    suppliers = spark.read.parquet(f"{DATA}/supplier.parquet")
    averages = leaderboards.named_averages(
        suppliers, nations, "s_nationkey", "s_acctbal", "n_nationkey", "n_name"
    )
    board = leaderboards.average_leaderboard(averages, "average", "n_name").collect()
    assert board[0].average == max(r.average for r in board)
    assert [r["rank"] for r in board] == list(range(1, len(board) + 1))


def test_text_state_and_frame_versions_agree(spark):
    clean = cleaning.clean_flights(binding.flights_raw(spark, DATA))
    airlines = binding.airlines_raw(spark, DATA)
    frame = rows(leaderboards.airline_delay_statistic(clean, airlines))
    assert frame == rows(leaderboards.airline_delay_sql(clean, airlines))
    state = leaderboards.airline_delay_state(clean).select("AIRLINE", "average")
    names = airlines.withColumnRenamed("AIRLINE", "name")
    by_state = state.join(names, F.col("AIRLINE") == F.col("IATA_CODE")).select("name", "average")
    assert frame == rows(by_state)


def test_layout_does_not_matter(flights, airlines, airports):
    results = []
    for partitions in (1, 7):
        spread = flights.repartition(partitions)
        clean = cleaning.clean_flights(spread)
        results.append(
            (
                rows(leaderboards.airline_delay_leaderboard(clean, airlines)),
                rows(leaderboards.airport_slot_taxi_leaderboard(clean, airports)),
                rows(build_features(spread, airlines, airports)),
            )
        )
    assert results[0] == results[1]


def test_only_flown_flights_need_a_departure(spark, flights, airlines, airports, tmp_path):
    """A bad time on a dropped flight must not fail the job, wherever the plan puts the test."""
    broken = flights.withColumn(
        "SCHEDULED_DEPARTURE",
        F.when(F.col("CANCELLED") == "1", "??").otherwise(F.col("SCHEDULED_DEPARTURE")),
    )
    broken.write.parquet(str(tmp_path / "flights"))
    for table in (broken, spark.read.parquet(str(tmp_path / "flights"))):
        clean = cleaning.clean_flights(table)
        airline_statistic = leaderboards.airline_delay_statistic(clean, airlines)
        airport_statistic = leaderboards.airport_slot_taxi_statistic(clean, airports)
        for limit in (0, 1 << 26):
            features = enrichment.feature_table(
                cleaning.feature_flights(table), airlines, airports,
                airline_statistic, airport_statistic, limit,
            )
            assert features.count() == 6
            assert len(rows(features)) == 6
        assert len(rows(airport_statistic)) == 5


def test_bad_numbers_on_dropped_flights_do_not_matter(flights, airlines, airports):
    broken = flights.withColumns(
        {
            c: F.when(F.col("CANCELLED") == "1", "??").otherwise(F.col(c))
            for c in ("MONTH", "DISTANCE", "ARRIVAL_DELAY", "TAXI_OUT")
        }
    )
    assert build_features(broken, airlines, airports).count() == 6
