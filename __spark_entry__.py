"""Registry of the queries, each over the whole given tables, and of their SQL."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_queries  # noqa: E402
from tarmac import schemas  # noqa: E402
from tarmac.constants import FEATURE_ORDER  # noqa: E402
from tarmac.functions import rules, scalars  # noqa: E402
from tarmac.functions.sql_names import register_sql_functions  # noqa: E402
from tarmac.operators import (  # noqa: E402
    certificates,
    cleaning,
    encoding,
    enrichment,
    leaderboards,
    metrics,
    sampling,
    summary,
    trees,
)
from tarmac.plans import features as feature_plans  # noqa: E402
from tarmac.plans import training  # noqa: E402
from tarmac.sources import binding, csv_tables, sinks, stage  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


# Inputs


def _clean(spark, sf_dir):
    return cleaning.clean_flights(binding.flights_raw(spark, sf_dir))


def _features(spark, sf_dir):
    return feature_plans.build_features(
        binding.flights_raw(spark, sf_dir),
        binding.airlines_raw(spark, sf_dir),
        binding.airports_raw(spark, sf_dir),
    )


def _kept_features(spark, sf_dir):
    return stage.keep(_features(spark, sf_dir), "features")


# Sources and sinks


def flights_raw(spark, sf_dir):
    return binding.flights_raw(spark, sf_dir)


def csv_header_scan(spark, sf_dir):
    path = stage.new_stage_path(spark, "flights-csv")
    sinks.write_csv(binding.flights_raw(spark, sf_dir), path, header=True)
    return csv_tables.read_header_csv(spark, path, schemas.RAW_FLIGHTS.names)


def csv_positional_scan(spark, sf_dir):
    path = stage.new_stage_path(spark, "clean-csv")
    sinks.write_csv(_clean(spark, sf_dir), path)
    return csv_tables.read_positional_csv(spark, path, schemas.CLEAN_FLIGHTS)


def feature_table_scan(spark, sf_dir):
    path = stage.new_stage_path(spark, "features-csv")
    sinks.write_csv(_features(spark, sf_dir), path)
    return feature_plans.read_features(spark, path, "csv")


def trimmed_record_scan(spark, sf_dir):
    clean = _clean(spark, sf_dir)
    padded = clean.select(
        [F.concat(F.lit("  "), F.col(c), F.lit(" ")).alias(c) for c in clean.columns]
    )
    path = stage.new_stage_path(spark, "padded-csv")
    sinks.write_csv(padded, path)
    return csv_tables.read_positional_csv(spark, path, schemas.CLEAN_FLIGHTS, trim=True)


MEASURED_FLIGHTS = "AIRLINE string, ORIGIN_AIRPORT string, SCHEDULED_DEPARTURE string, " \
    "TAXI_OUT double, ARRIVAL_DELAY double"


def _ragged_flights(spark, sf_dir):
    """Clean flights as lines: of some airlines short, long or with a text for a number."""
    clean = _clean(spark, sf_dir)
    texts = [F.coalesce(F.col(c), F.lit("")) for c in clean.columns]
    line = (
        F.when(F.col("AIRLINE") == "03", F.concat_ws(",", *texts[:3]))
        .when(F.col("AIRLINE") == "07", F.concat_ws(",", *texts, F.lit("x"), F.lit("y")))
        .when(F.col("AIRLINE") == "11", F.concat_ws(",", *texts[:3], F.lit("n/a"), texts[4]))
        .otherwise(F.concat_ws(",", *texts))
    )
    path = stage.new_stage_path(spark, "ragged-csv")
    clean.select(line).write.text(path)
    schema = T.StructType.fromDDL(MEASURED_FLIGHTS)
    return csv_tables.read_ragged_csv(spark, path, schema)


def ragged_csv_scan(spark, sf_dir):
    return _ragged_flights(spark, sf_dir)[0]


def ragged_lines_aside(spark, sf_dir):
    aside = _ragged_flights(spark, sf_dir)[1]
    return aside.groupBy("fields", "reason", "kept").agg(
        F.count("*").alias("n"), F.min("line").alias("first_line"), F.max("line").alias("last_line")
    )


def stage_roundtrip(spark, sf_dir):
    state = leaderboards.airport_slot_taxi_state(_clean(spark, sf_dir))
    return stage.keep(stage.keep(state, "state", "snappy"), "state-plain", "none")


def csv_sink_roundtrip(spark, sf_dir):
    statistic = leaderboards.airport_slot_taxi_statistic(
        _clean(spark, sf_dir), binding.airports_raw(spark, sf_dir)
    )
    path = stage.new_stage_path(spark, "leaderboard-csv")
    sinks.write_csv(binding.airlines_raw(spark, sf_dir), path)
    sinks.write_csv(statistic, path, order=[F.desc("average_taxi_out"), F.asc("airport")])
    return csv_tables.read_positional_csv(spark, path, schemas.AIRPORT_STATISTIC)


# Cleaning


def clean_flights(spark, sf_dir):
    return _clean(spark, sf_dir)


def clean_flights_typed(spark, sf_dir):
    return cleaning.typed_measures(_clean(spark, sf_dir))


def clean_airlines(spark, sf_dir):
    return cleaning.clean_airlines(binding.airlines_raw(spark, sf_dir))


def clean_airports(spark, sf_dir):
    return cleaning.clean_airports(binding.airports_raw(spark, sf_dir))


# Leaderboards


def airline_delay_leaderboard(spark, sf_dir):
    return leaderboards.airline_delay_leaderboard(
        _clean(spark, sf_dir), binding.airlines_raw(spark, sf_dir)
    )


def airline_delay_sql(spark, sf_dir):
    return leaderboards.airline_delay_sql(
        _clean(spark, sf_dir), binding.airlines_raw(spark, sf_dir)
    )


def airline_delay_state(spark, sf_dir):
    return leaderboards.airline_delay_state(_clean(spark, sf_dir))


def airline_delay_merged_state(spark, sf_dir):
    flights = binding.flights_raw(spark, sf_dir)
    first = F.col("MONTH").cast("int") <= 6
    halves = [flights.where(half) for half in (first, ~first)]
    states = [leaderboards.airline_delay_state(cleaning.clean_flights(half)) for half in halves]
    return leaderboards.merge_states(states, ["AIRLINE"])


def airport_slot_taxi_leaderboard(spark, sf_dir):
    return leaderboards.airport_slot_taxi_leaderboard(
        _clean(spark, sf_dir), binding.airports_raw(spark, sf_dir)
    )


def airport_slot_taxi_state(spark, sf_dir):
    return leaderboards.airport_slot_taxi_state(_clean(spark, sf_dir))


def airport_rank_within_slot(spark, sf_dir):
    return leaderboards.airport_rank_within_slot(
        _clean(spark, sf_dir), binding.airports_raw(spark, sf_dir)
    )


# Enrichment


def enrich_origin_destination(spark, sf_dir):
    return enrichment.enrich_origin_destination(
        cleaning.feature_flights(binding.flights_raw(spark, sf_dir)),
        binding.airports_raw(spark, sf_dir),
    )


def enrich_airline(spark, sf_dir):
    return enrichment.enrich_airline(
        cleaning.feature_flights(binding.flights_raw(spark, sf_dir)),
        binding.airlines_raw(spark, sf_dir),
    )


def enrich_airline_stats(spark, sf_dir):
    flights = stage.keep(cleaning.feature_flights(binding.flights_raw(spark, sf_dir)), "flights")
    airlines = binding.airlines_raw(spark, sf_dir)
    statistic = stage.keep(
        leaderboards.airline_delay_statistic(flights, airlines), "airline-statistic"
    )
    return enrichment.enrich_airline_stats(enrichment.enrich_airline(flights, airlines), statistic)


def enrich_airport_stats(spark, sf_dir):
    flights = stage.keep(cleaning.feature_flights(binding.flights_raw(spark, sf_dir)), "flights")
    airports = binding.airports_raw(spark, sf_dir)
    statistic = stage.keep(
        leaderboards.airport_slot_taxi_statistic(flights, airports), "airport-statistic"
    )
    return enrichment.enrich_airport_stats(
        enrichment.enrich_origin_destination(flights, airports), statistic
    )


def feature_table(spark, sf_dir):
    return _features(spark, sf_dir)


def feature_summary(spark, sf_dir):
    rows = summary.describe_columns(_features(spark, sf_dir))
    return rows.withColumns({"mean": F.round("mean", 6), "stddev": F.round("stddev", 6)})


# Scalar functions


def time_slot_scalar(spark, sf_dir):
    slot = scalars.time_slot("SCHEDULED_DEPARTURE")
    return (
        binding.flights_raw(spark, sf_dir)
        .select("SCHEDULED_DEPARTURE", slot.alias("time_slot"))
        .groupBy("SCHEDULED_DEPARTURE", "time_slot")
        .agg(F.count("*").alias("n"))
    )


def time_slot_ordinal(spark, sf_dir):
    slot = rules.time_slot("SCHEDULED_DEPARTURE")
    return (
        binding.flights_raw(spark, sf_dir)
        .select(scalars.slot_ordinal(slot).alias("ordinal"))
        .withColumn("time_slot", scalars.slot_from_ordinal("ordinal"))
        .groupBy("ordinal", "time_slot")
        .agg(F.count("*").alias("n"))
    )


def time_slot_sql_function(spark, sf_dir):
    register_sql_functions(spark)
    return spark.sql(
        """
        SELECT extractTimeSlot(SCHEDULED_DEPARTURE) AS time_slot,
               extractDelayLabel(stringToInt(ARRIVAL_DELAY)) AS delay_label,
               count(*) AS n
        FROM {flights} GROUP BY 1, 2
        """,
        flights=binding.flights_raw(spark, sf_dir),
    )


def strict_double_sql_function(spark, sf_dir):
    register_sql_functions(spark)
    return spark.sql(
        """
        SELECT AIRLINE, sum(stringToDouble(ARRIVAL_DELAY, true)) AS total_delay,
               max(stringToDouble(TAXI_OUT, true)) AS longest_taxi_out,
               min(stringToDouble(ARRIVAL_DELAY, strict => true)) AS least_delay
        FROM {flights} GROUP BY AIRLINE
        """,
        flights=_clean(spark, sf_dir),
    )


def area_sql_functions(spark, sf_dir):
    register_sql_functions(spark)
    return spark.sql(
        """
        SELECT IATA_CODE,
               cast(extractLatitudeArea(stringToDouble(LATITUDE)) AS INT) AS latitude_area,
               cast(extractLongitudeArea(stringToDouble(LONGITUDE)) AS INT) AS longitude_area,
               intToDouble(stringToInt(IATA_CODE)) AS code
        FROM {airports}
        """,
        airports=binding.airports_raw(spark, sf_dir),
    )


def delay_label(spark, sf_dir):
    delay = rules.strict_int("ARRIVAL_DELAY")
    return (
        binding.flights_raw(spark, sf_dir)
        .select(
            F.expr(delay).alias("arrival_delay"), scalars.delay_label(delay).alias("delay_label")
        )
        .groupBy("arrival_delay", "delay_label")
        .agg(F.count("*").alias("n"))
    )


def latitude_area(spark, sf_dir):
    value = rules.double_or_default("LATITUDE")
    return binding.airports_raw(spark, sf_dir).select(
        "IATA_CODE", scalars.latitude_area(value).alias("latitude_area")
    )


def longitude_area(spark, sf_dir):
    value = rules.double_or_default("LONGITUDE")
    return binding.airports_raw(spark, sf_dir).select(
        "IATA_CODE", scalars.longitude_area(value).alias("longitude_area")
    )


def parse_double_default(spark, sf_dir):
    return binding.airports_raw(spark, sf_dir).select(
        "IATA_CODE",
        scalars.double_or_default("LATITUDE").alias("latitude"),
        scalars.double_or_default("LONGITUDE").alias("longitude"),
        scalars.double_or_default("STATE").alias("not_a_number"),
    )


# Sampling and splitting


def sample_hash_20(spark, sf_dir):
    return sampling.hash_sample(_features(spark, sf_dir))


def sample_bernoulli_20(spark, sf_dir):
    return sampling.bernoulli_sample(_features(spark, sf_dir), seed=1)


def split_hash_70_30(spark, sf_dir):
    return sampling.hash_split(_features(spark, sf_dir))


def split_random_70_30(spark, sf_dir):
    return sampling.random_split(_features(spark, sf_dir))


# Model inputs


def string_index(spark, sf_dir):
    features = _kept_features(spark, sf_dir)
    indexed = encoding.fit_category_indexer(features).transform(features)
    pairs = [
        F.struct(
            F.lit(c).alias("column"), F.col(c).alias("value"), F.col(f"{c}Index").alias("index")
        )
        for c in encoding.CATEGORIES
    ]
    return (
        indexed.select(F.inline(F.array(*pairs)))
        .groupBy("column", "value", "index")
        .agg(F.count("*").alias("n"))
    )


def _bucketized(column):
    def query(spark, sf_dir):
        bucketed = encoding.bucketizer(column).transform(_features(spark, sf_dir))
        return bucketed.groupBy(
            F.col(column).alias("value"), F.col(f"{column}Bucketed").alias("bucket")
        ).agg(F.count("*").alias("n"))

    return query


def _assembled(spark, sf_dir):
    features = _kept_features(spark, sf_dir)
    encoded = encoding.fit_category_indexer(features).transform(features)
    return encoding.assembler().transform(encoding.bucketizer().transform(encoded))


def _vector_columns(table, vector, digits=None):
    values = vector_to_array(vector)
    rounded = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    return table.select([rounded(values[i]).alias(n) for i, n in enumerate(FEATURE_ORDER)])


def assemble_features(spark, sf_dir):
    return _vector_columns(_assembled(spark, sf_dir), "features")


def l2_normalize(spark, sf_dir):
    normalized = encoding.normalizer().transform(_assembled(spark, sf_dir))
    return _vector_columns(normalized, "normalized_features", 6)


# Models


def _late_airline_guess(spark, sf_dir):
    """A rule SQL can state: flights of an airline that is 8 late on average are late."""
    return _features(spark, sf_dir).select(
        (F.col("AverageAirlineDelay") >= 8).cast("double").alias("prediction"),
        F.col("Delay").alias("DelayIndex"),
    )


def confusion_metrics(spark, sf_dir):
    return metrics.confusion_metrics(_late_airline_guess(spark, sf_dir)).drop("auc")


def auc_hard_labels(spark, sf_dir):
    return metrics.confusion_metrics(_late_airline_guess(spark, sf_dir)).select("auc")


def tree_evaluation(spark, sf_dir):
    return training.train_and_evaluate(_kept_features(spark, sf_dir), "tree")[1]


def logistic_evaluation(spark, sf_dir):
    return training.train_and_evaluate(_kept_features(spark, sf_dir), "logistic")[1]


def logistic_certificate(spark, sf_dir):
    rows = training.split_and_compact(_kept_features(spark, sf_dir))
    train = rows.filter(F.col("set") == "Train")
    encoders = training.fit_encoders(train, "logistic")
    encoded = PipelineModel(encoders).transform(train)
    model = training.fit_classifier(encoded, encoders, "logistic")
    return certificates.logistic_certificate(encoded, model)


def model_report(spark, sf_dir):
    return metrics.report_lines(logistic_evaluation(spark, sf_dir)).orderBy("line_no")


def tree_report(spark, sf_dir):
    return metrics.report_lines(tree_evaluation(spark, sf_dir))


def tree_nodes(spark, sf_dir):
    fitted, _ = training.train_and_evaluate(_kept_features(spark, sf_dir), "tree")
    return trees.tree_nodes(spark, fitted.stages[-1])


def tree_description(spark, sf_dir):
    fitted, _ = training.train_and_evaluate(_kept_features(spark, sf_dir), "tree")
    return training.tree_description(spark, fitted)


OWN_QUERIES = {
    "flights_raw": flights_raw,
    "csv_header_scan": csv_header_scan,
    "csv_positional_scan": csv_positional_scan,
    "feature_table_scan": feature_table_scan,
    "trimmed_record_scan": trimmed_record_scan,
    "ragged_csv_scan": ragged_csv_scan,
    "ragged_lines_aside": ragged_lines_aside,
    "stage_roundtrip": stage_roundtrip,
    "csv_sink_roundtrip": csv_sink_roundtrip,
    "clean_flights": clean_flights,
    "clean_flights_typed": clean_flights_typed,
    "clean_airlines": clean_airlines,
    "clean_airports": clean_airports,
    "airline_delay_leaderboard": airline_delay_leaderboard,
    "airline_delay_sql": airline_delay_sql,
    "airline_delay_state": airline_delay_state,
    "airline_delay_merged_state": airline_delay_merged_state,
    "airport_slot_taxi_leaderboard": airport_slot_taxi_leaderboard,
    "airport_slot_taxi_state": airport_slot_taxi_state,
    "airport_rank_within_slot": airport_rank_within_slot,
    "enrich_origin_destination": enrich_origin_destination,
    "enrich_airline": enrich_airline,
    "enrich_airline_stats": enrich_airline_stats,
    "enrich_airport_stats": enrich_airport_stats,
    "feature_table": feature_table,
    "feature_summary": feature_summary,
    "time_slot_scalar": time_slot_scalar,
    "time_slot_ordinal": time_slot_ordinal,
    "time_slot_sql_function": time_slot_sql_function,
    "strict_double_sql_function": strict_double_sql_function,
    "area_sql_functions": area_sql_functions,
    "delay_label": delay_label,
    "latitude_area": latitude_area,
    "longitude_area": longitude_area,
    "parse_double_default": parse_double_default,
    "sample_hash_20": sample_hash_20,
    "sample_bernoulli_20": sample_bernoulli_20,
    "split_hash_70_30": split_hash_70_30,
    "split_random_70_30": split_random_70_30,
    "string_index": string_index,
    "bucketize_distance": _bucketized("Distance"),
    "bucketize_average_delay": _bucketized("AverageAirlineDelay"),
    "bucketize_taxi_out": _bucketized("AverageTaxiOut"),
    "assemble_features": assemble_features,
    "l2_normalize": l2_normalize,
    "confusion_metrics": confusion_metrics,
    "auc_hard_labels": auc_hard_labels,
    "tree_evaluation": tree_evaluation,
    "logistic_evaluation": logistic_evaluation,
    "logistic_certificate": logistic_certificate,
    "model_report": model_report,
    "tree_report": tree_report,
    "tree_nodes": tree_nodes,
    "tree_description": tree_description,
}


try:
    from tarmac.llm.queries import ORACLE_SQL as _LLM_SQL
    from tarmac.llm.queries import QUERIES as _LLM_QUERIES
except ImportError as error:
    if (error.name or "").partition(".llm")[0] not in ("tarmac", "corpus_pipeline"):
        raise
    _LLM_QUERIES, _LLM_SQL = {}, {}


def entry(spark: SparkSession) -> DataFrame:
    """Airlines ranked by average arrival delay."""
    return airline_delay_leaderboard(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**OWN_QUERIES, **_LLM_QUERIES}


def oracle_sql() -> dict[str, str]:
    """SQL for every query but the random draws and the fitted models."""
    return {**oracle_queries.oracle_sql(), **_LLM_SQL}
