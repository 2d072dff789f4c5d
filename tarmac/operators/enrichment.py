"""Joins of flights with dimensions and statistics, and the feature table."""

from pyspark.sql import functions as F

from tarmac.functions import rules
from tarmac.functions.scalars import (
    delay_label,
    int_to_double,
    latitude_area,
    longitude_area,
    strict_double,
    strict_int,
    time_slot,
)
from tarmac.operators.joins import BROADCAST_LIMIT, broadcast_if_small, lookup_join
from tarmac.schemas import FEATURES


def _airports_as(airports, prefix):
    return airports.select(
        F.col("IATA_CODE").alias(f"{prefix}_IATA_CODE"),
        F.col("AIRPORT").alias(f"{prefix}_AIRPORT_NAME"),
        F.col("LATITUDE").alias(f"{prefix}_LATITUDE"),
        F.col("LONGITUDE").alias(f"{prefix}_LONGITUDE"),
        F.col("STATE").alias(f"{prefix}_STATE"),
    )


def enrich_origin_destination(flights, airports, limit=BROADCAST_LIMIT):
    """Flights with name, place and state of both airports."""
    (airports,) = broadcast_if_small(airports, limit=limit)
    for prefix in ("ORIGIN", "DESTINATION"):
        flights = flights.join(
            _airports_as(airports, prefix),
            F.col(f"{prefix}_AIRPORT") == F.col(f"{prefix}_IATA_CODE"),
        )
    return flights


def enrich_airline(flights, airlines, limit=BROADCAST_LIMIT):
    """Flights with the airline's name."""
    names = airlines.select(
        F.col("IATA_CODE").alias("AIRLINES_IATA_CODE"), F.col("AIRLINE").alias("AIRLINES_NAME")
    )
    return lookup_join(flights, names, F.col("AIRLINE") == F.col("AIRLINES_IATA_CODE"), limit)


def enrich_airline_stats(flights, airline_statistic, limit=BROADCAST_LIMIT):
    """Flights with their airline's average delay, matched on the airline's name."""
    statistic = airline_statistic.select(
        F.col("airline").alias("STATISTIC_AIRLINES_NAME"),
        F.col("average_delay").alias("STATISTICS_AVG_DELAY"),
    )
    return lookup_join(
        flights, statistic, F.col("AIRLINES_NAME") == F.col("STATISTIC_AIRLINES_NAME"), limit
    )


def enrich_airport_stats(flights, airport_statistic, limit=BROADCAST_LIMIT):
    """Flights with their origin's average taxi-out in the slot, matched on name and slot."""
    statistic = airport_statistic.select(
        F.col("airport").alias("STATISTIC_AIRPORT_NAME"),
        F.col("time_slot").alias("STATISTIC_TIME_SLOT"),
        F.col("average_taxi_out").alias("AVG_TAXI_OUT"),
    )
    slotted = flights.withColumn("TIME_SLOT", time_slot("SCHEDULED_DEPARTURE"))
    return lookup_join(
        slotted,
        statistic,
        (F.col("ORIGIN_AIRPORT_NAME") == F.col("STATISTIC_AIRPORT_NAME"))
        & (F.col("TIME_SLOT") == F.col("STATISTIC_TIME_SLOT")),
        limit,
    )


def _airline_profile(airlines, airline_statistic):
    """Per airline code: the average delay found under the airline's name."""
    names = airlines.select(F.col("IATA_CODE").alias("airline_code"), F.col("AIRLINE").alias("name"))
    averages = airline_statistic.select(
        F.col("airline").alias("name"), F.col("average_delay").alias("AverageAirlineDelay")
    )
    return names.join(averages, "name").drop("name")


def _areas(airports, prefix):
    return airports.select(
        F.col("IATA_CODE").alias(f"{prefix}_code"),
        F.col("AIRPORT").alias(f"{prefix}_name"),
        latitude_area(rules.double_or_default("LATITUDE")).alias(f"{prefix}LatitudeArea"),
        longitude_area(rules.double_or_default("LONGITUDE")).alias(f"{prefix}LongitudeArea"),
        F.col("STATE").alias(f"{prefix}State"),
    )


def _origin_profile(airports, airport_statistic):
    """Per airport code and slot: area, state and the average found under the name."""
    averages = airport_statistic.select(
        F.col("airport").alias("Origin_name"),
        F.col("time_slot").alias("origin_slot"),
        F.col("average_taxi_out").alias("AverageTaxiOut"),
    )
    return _areas(airports, "Origin").join(averages, "Origin_name").drop("Origin_name")


def feature_facts(flights):
    """Flights with the typed columns that features and statistics are made of.

    A malformed number or a departure without an hour fails whatever reads them.
    """
    return flights.select(
        F.col("AIRLINE").alias("Airline"),
        time_slot("SCHEDULED_DEPARTURE").alias("TimeSlot"),
        strict_int("MONTH").alias("Month"),
        strict_int("DAY_OF_WEEK").alias("DayOfWeek"),
        int_to_double(rules.strict_int("DISTANCE")).alias("Distance"),
        F.col("ORIGIN_AIRPORT").alias("OriginAirport"),
        F.col("DESTINATION_AIRPORT").alias("destination"),
        strict_int("ARRIVAL_DELAY").alias("arrival_delay"),
        strict_double("TAXI_OUT").alias("taxi_out"),
    )


def feature_table(
    flights, airlines, airports, airline_statistic, airport_statistic, limit=BROADCAST_LIMIT
):
    """One row of 15 model inputs per valid flight that finds all its partners.

    The statistics cover all flights, so also those a model is later tested on.
    """
    profiles = dimension_profiles(airlines, airports, airline_statistic, airport_statistic)
    return features_of_facts(feature_facts(flights), *profiles, limit=limit)


def dimension_profiles(airlines, airports, airline_statistic, airport_statistic):
    """What features take from an airline, from an origin in a slot, and from a destination.

    The statistics are joined to their dimensions by name, and the areas are worked out per
    airport: inner joins may be regrouped, and the flights, the large side, then take part in
    three joins instead of five.
    """
    return (
        _airline_profile(airlines, airline_statistic),
        _origin_profile(airports, airport_statistic),
        _areas(airports, "Destination").drop("Destination_name"),
    )


def features_of_facts(facts, by_airline, by_origin, by_destination, limit=BROADCAST_LIMIT):
    """The feature table of typed facts and the profiles of their dimensions."""
    by_airline, by_origin, by_destination = broadcast_if_small(
        by_airline, by_origin, by_destination, limit=limit
    )
    return (
        facts.withColumn("Delay", delay_label("arrival_delay"))
        .join(by_airline, F.col("Airline") == F.col("airline_code"))
        .join(
            by_origin,
            (F.col("OriginAirport") == F.col("Origin_code"))
            & (F.col("TimeSlot") == F.col("origin_slot")),
        )
        .join(by_destination, F.col("destination") == F.col("Destination_code"))
        .select(*FEATURES.names)
    )
