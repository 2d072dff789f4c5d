"""Table layouts."""

from pyspark.sql import types as T


def _strings(*names):
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


RAW_FLIGHTS = _strings(
    "AIRLINE",
    "ORIGIN_AIRPORT",
    "DESTINATION_AIRPORT",
    "SCHEDULED_DEPARTURE",
    "MONTH",
    "DAY_OF_WEEK",
    "DISTANCE",
    "TAXI_OUT",
    "ARRIVAL_DELAY",
    "CANCELLED",
    "DIVERTED",
)
RAW_AIRLINES = _strings("IATA_CODE", "AIRLINE")
RAW_AIRPORTS = _strings("IATA_CODE", "AIRPORT", "LATITUDE", "LONGITUDE", "STATE")

CLEAN_FLIGHTS = _strings(
    "AIRLINE", "ORIGIN_AIRPORT", "SCHEDULED_DEPARTURE", "TAXI_OUT", "ARRIVAL_DELAY"
)
CLEAN_AIRLINES = RAW_AIRLINES
CLEAN_AIRPORTS = _strings("IATA_CODE", "AIRPORT")

AIRLINE_STATISTIC = T.StructType(
    [
        T.StructField("airline", T.StringType()),
        T.StructField("average_delay", T.DoubleType()),
    ]
)
AIRPORT_STATISTIC = T.StructType(
    [
        T.StructField("airport", T.StringType()),
        T.StructField("time_slot", T.StringType()),
        T.StructField("average_taxi_out", T.DoubleType()),
    ]
)

FEATURES = T.StructType(
    [
        T.StructField("Airline", T.StringType()),
        T.StructField("TimeSlot", T.StringType()),
        T.StructField("Month", T.IntegerType()),
        T.StructField("DayOfWeek", T.IntegerType()),
        T.StructField("Distance", T.DoubleType()),
        T.StructField("OriginLatitudeArea", T.IntegerType()),
        T.StructField("OriginLongitudeArea", T.IntegerType()),
        T.StructField("OriginState", T.StringType()),
        T.StructField("DestinationLatitudeArea", T.IntegerType()),
        T.StructField("DestinationLongitudeArea", T.IntegerType()),
        T.StructField("DestinationState", T.StringType()),
        T.StructField("OriginAirport", T.StringType()),
        T.StructField("AverageAirlineDelay", T.DoubleType()),
        T.StructField("Delay", T.DoubleType()),
        T.StructField("AverageTaxiOut", T.DoubleType()),
    ]
)
