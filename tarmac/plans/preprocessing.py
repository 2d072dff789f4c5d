"""From raw CSV files to the clean tables the leaderboards read."""

from tarmac.operators.cleaning import clean_airlines, clean_airports, clean_flights
from tarmac.schemas import CLEAN_AIRLINES, CLEAN_AIRPORTS, CLEAN_FLIGHTS, RAW_AIRPORTS, RAW_FLIGHTS
from tarmac.sources.csv_tables import read_header_csv, read_positional_csv
from tarmac.sources.sinks import write_csv, write_parquet

CLEAN_SCHEMAS = {
    "flights": CLEAN_FLIGHTS,
    "airlines": CLEAN_AIRLINES,
    "airports": CLEAN_AIRPORTS,
}


def read_raw(spark, raw):
    """Raw flights, airlines and airports of a folder."""
    return (
        read_header_csv(spark, f"{raw}/flights.csv", RAW_FLIGHTS.names),
        read_header_csv(spark, f"{raw}/airlines.csv"),
        read_header_csv(spark, f"{raw}/airports.csv", RAW_AIRPORTS.names),
    )


def read_clean(spark, clean, name, file_format="parquet"):
    """One clean table, trimmed when it comes from text."""
    path = f"{clean}/{name}"
    if file_format == "csv":
        return read_positional_csv(spark, path, CLEAN_SCHEMAS[name], trim=True)
    return spark.read.schema(CLEAN_SCHEMAS[name]).parquet(path)


def run_preprocessing(spark, raw, clean, file_format="parquet", flight_files=None):
    """Write the clean tables; ``flight_files`` fixes the number of flight files."""
    flights, airlines, airports = read_raw(spark, raw)
    write = write_csv if file_format == "csv" else write_parquet
    write(clean_flights(flights), f"{clean}/flights", files=flight_files)
    write(clean_airlines(airlines), f"{clean}/airlines")
    write(clean_airports(airports), f"{clean}/airports")
