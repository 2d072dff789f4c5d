"""Averages per key and the leaderboards built from them.

Every aggregate runs before its join, with partial sums on the map side: a hot key
reaches the shuffle as one row per map task.
"""

from functools import reduce

from pyspark.sql import functions as F

from tarmac.functions.scalars import strict_double, time_slot
from tarmac.operators.ranking import with_rank


def _with_average(state):
    return state.withColumn("average", F.try_divide(F.col("total"), F.col("n")))


def average_state(fact, keys, measure):
    """Sum and count of a measure per key, with the average they give.

    Unlike an average, sum and count of separate inputs can be merged.
    """
    return _with_average(
        fact.groupBy(*keys).agg(F.sum(measure).alias("total"), F.count(measure).alias("n"))
    )


def merge_states(states, keys):
    """One state from several that cover disjoint inputs."""
    union = reduce(lambda a, b: a.unionByName(b), states)
    return _with_average(
        union.groupBy(*keys).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    )


def _delays(clean):
    return clean.select("AIRLINE", strict_double("ARRIVAL_DELAY").alias("ARRIVAL_DELAY"))


def _taxi_times(clean):
    return clean.select(
        "ORIGIN_AIRPORT",
        time_slot("SCHEDULED_DEPARTURE").alias("time_slot"),
        strict_double("TAXI_OUT").alias("TAXI_OUT"),
    )


def airline_delay_state(clean):
    return average_state(_delays(clean), ["AIRLINE"], "ARRIVAL_DELAY")


def airport_slot_taxi_state(clean):
    return average_state(_taxi_times(clean), ["ORIGIN_AIRPORT", "time_slot"], "TAXI_OUT")


def named_averages(fact, dimension, key, measure, code, name, by=(), average="average"):
    """Average of a measure per name a dimension gives to the key, and per ``by`` column.

    The result calls the name as the dimension does, in lower case.
    """
    averages = fact.groupBy(key, *by).agg(F.avg(measure).alias(average))
    names = dimension.select(F.col(code).alias("_code"), F.col(name).alias("_name"))
    return averages.join(names, F.col(key) == F.col("_code")).select(
        F.col("_name").alias(name.lower()), *by, average
    )


def airline_delay_statistic(clean, airlines):
    """Average arrival delay per airline name."""
    return named_averages(
        _delays(clean),
        airlines,
        key="AIRLINE",
        measure="ARRIVAL_DELAY",
        code="IATA_CODE",
        name="AIRLINE",
        average="average_delay",
    )


def airport_slot_taxi_statistic(clean, airports):
    """Average taxi-out time per airport name and time slot."""
    return named_averages(
        _taxi_times(clean),
        airports,
        key="ORIGIN_AIRPORT",
        measure="TAXI_OUT",
        code="IATA_CODE",
        name="AIRPORT",
        by=["time_slot"],
        average="average_taxi_out",
    )


def delay_and_taxi_state(facts):
    """Sums and counts of both measures per airline, airport and slot.

    Both statistics roll up from it, so the flights are read once for the two.
    """
    return facts.groupBy("Airline", "OriginAirport", "TimeSlot").agg(
        F.sum(F.col("arrival_delay").cast("double")).alias("delay_total"),
        F.count("arrival_delay").alias("delay_n"),
        F.sum("taxi_out").alias("taxi_total"),
        F.count("taxi_out").alias("taxi_n"),
    )


def _rolled_up(state, keys, measure):
    parts = state.select(
        *keys, F.col(f"{measure}_total").alias("total"), F.col(f"{measure}_n").alias("n")
    )
    return merge_states([parts], list(keys))


def statistics_of_state(state, airlines, airports):
    """The averages per airline name, and per airport name and slot, of the common state."""
    names = airlines.select(F.col("IATA_CODE").alias("Airline"), F.col("AIRLINE").alias("airline_name"))
    by_airline = _rolled_up(state, ["Airline"], "delay").join(names, "Airline").select(
        F.col("airline_name").alias("airline"), F.col("average").alias("average_delay")
    )
    names = airports.select(F.col("IATA_CODE").alias("OriginAirport"), F.col("AIRPORT").alias("airport"))
    by_airport = _rolled_up(state, ["OriginAirport", "TimeSlot"], "taxi").join(names, "OriginAirport")
    return by_airline, by_airport.select(
        "airport", F.col("TimeSlot").alias("time_slot"), F.col("average").alias("average_taxi_out")
    )


def average_leaderboard(averages, average, *ties, within=()):
    """Averages ranked from the highest down, equal ones by the ``ties`` columns."""
    order = [F.desc(average), *[F.asc(c) for c in ties]]
    return with_rank(averages, order, within).orderBy(*within, "rank")


def airline_delay_leaderboard(clean, airlines):
    """Airlines from the latest to the most punctual, ties by name."""
    return average_leaderboard(
        airline_delay_statistic(clean, airlines), "average_delay", "airline"
    )


def airport_slot_taxi_leaderboard(clean, airports):
    """Airports and slots from the longest to the shortest taxi-out, ties by name, slot."""
    return average_leaderboard(
        airport_slot_taxi_statistic(clean, airports), "average_taxi_out", "airport", "time_slot"
    )


def airport_rank_within_slot(clean, airports):
    """Airports ranked by taxi-out time inside each time slot."""
    return average_leaderboard(
        airport_slot_taxi_statistic(clean, airports),
        "average_taxi_out",
        "airport",
        within=["time_slot"],
    )


AIRLINE_DELAY_SQL = """
WITH state AS (
    SELECT AIRLINE AS code, sum(ARRIVAL_DELAY) AS total, count(ARRIVAL_DELAY) AS n
    FROM {flights}
    GROUP BY ALL
)
SELECT a.AIRLINE AS airline, try_divide(state.total, state.n) AS average_delay
FROM {airlines} AS a, state
WHERE a.IATA_CODE = state.code
ORDER BY 2 DESC, 1
"""


def airline_delay_sql(clean, airlines):
    """The airline averages as SQL text over views."""
    return clean.sparkSession.sql(AIRLINE_DELAY_SQL, flights=_delays(clean), airlines=airlines)
