"""Choice of usable flights and of the columns later jobs need."""

from pyspark.sql import functions as F

from tarmac.functions.scalars import strict_double
from tarmac.schemas import CLEAN_AIRPORTS, CLEAN_FLIGHTS, RAW_FLIGHTS

def valid_flights(flights):
    """Flights neither cancelled nor diverted, with a three-letter origin code.

    A null in any of the three columns drops the row.
    """
    return flights.filter(
        (F.col("CANCELLED") == "0")
        & (F.col("DIVERTED") == "0")
        & (F.char_length("ORIGIN_AIRPORT") == 3)
    )


def clean_flights(flights):
    return valid_flights(flights).select(*CLEAN_FLIGHTS.names)


def feature_flights(flights):
    """Valid flights without the two flags, which are the same for all of them."""
    return valid_flights(flights).select(*RAW_FLIGHTS.names).drop("CANCELLED", "DIVERTED")


def clean_airlines(airlines):
    """The airline dimension as it is, all columns."""
    return airlines


def clean_airports(airports):
    return airports.select(*CLEAN_AIRPORTS.names)


def typed_measures(clean):
    """Clean flights with the two measures as numbers; a blank one is null."""
    return clean.withColumns(
        {
            "TAXI_OUT": strict_double("TAXI_OUT"),
            "ARRIVAL_DELAY": strict_double("ARRIVAL_DELAY"),
        }
    )
