"""From raw tables and statistics to the feature table and its sample."""

from tarmac.operators.cleaning import feature_flights
from tarmac.operators.enrichment import (
    dimension_profiles,
    feature_facts,
    feature_table,
    features_of_facts,
)
from tarmac.operators.leaderboards import delay_and_taxi_state, statistics_of_state
from tarmac.operators.sampling import bernoulli_sample, hash_sample
from tarmac.plans.leaderboards import read_statistics
from tarmac.plans.preprocessing import read_raw
from tarmac.schemas import FEATURES
from tarmac.sources.csv_tables import read_positional_csv
from tarmac.sources.sinks import write_csv, write_parquet
from tarmac.sources.stage import keep, keep_all


def build_features(flights, airlines, airports):
    """The feature table of raw tables, with the statistics worked out on the way.

    The flights are parsed once, into a typed stage, which is read twice: for one state that
    both statistics roll up from, and for the features. What the flights are joined with is
    kept: it is small, and the size checks before the joins then cost next to nothing.
    """
    facts, airports = keep_all(facts=feature_facts(feature_flights(flights)), airports=airports)
    state = keep(delay_and_taxi_state(facts), "state")
    profiles = dimension_profiles(
        airlines, airports, *statistics_of_state(state, airlines, airports)
    )
    names = ("by_airline", "by_origin", "by_destination")
    return features_of_facts(facts, *keep_all(**dict(zip(names, profiles))))


def run_feature_job(spark, raw, statistics, output, file_format="parquet"):
    """Write the feature table from raw files and the written leaderboards."""
    flights, airlines, airports = read_raw(spark, raw)
    airline_statistic, airport_statistic = read_statistics(spark, statistics)
    features = feature_table(
        feature_flights(flights), airlines, airports, airline_statistic, airport_statistic
    )
    write = write_csv if file_format == "csv" else write_parquet
    write(features, output)


def read_features(spark, path, file_format="parquet"):
    if file_format == "csv":
        return read_positional_csv(spark, path, FEATURES)
    return spark.read.schema(FEATURES).parquet(path)


def run_sampling(
    spark, features, output, file_format="parquet", seed=None, by_content=True, files=None
):
    """Write a 20 % sample, drawn row by row or by content."""
    table = read_features(spark, features, file_format)
    sample = hash_sample(table) if by_content else bernoulli_sample(table, seed=seed)
    write = write_csv if file_format == "csv" else write_parquet
    write(sample, output, files=files)
