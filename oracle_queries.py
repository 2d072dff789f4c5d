"""The registered queries as plain SQL, to check the Spark results against."""

import oracle_tree

_NUMBERS = (
    "Month DayOfWeek Distance OriginLatitudeArea OriginLongitudeArea DestinationLatitudeArea "
    "DestinationLongitudeArea AverageAirlineDelay Delay AverageTaxiOut"
).split()
_TEXTS = "Airline TimeSlot OriginState DestinationState OriginAirport".split()

_VIEWS = {
    "flights_raw": """
        SELECT CASE WHEN l_orderkey % 101 = 0 THEN 'ZZ'
                    ELSE lpad(cast(c_nationkey AS varchar), 2, '0') END AS AIRLINE,
               CASE WHEN l_linenumber = 7
                    THEN lpad(cast(l_suppkey % 1000 AS varchar), 5, '0')
                    ELSE lpad(cast(l_suppkey % 1000 AS varchar), 3, '0') END AS ORIGIN_AIRPORT,
               lpad(cast(l_partkey % 10 AS varchar), 3, '0') AS DESTINATION_AIRPORT,
               CASE WHEN m = 0 THEN '2400'
                    ELSE lpad(cast(cast(floor(m / 60) AS int) * 100 + m % 60 AS varchar), 4, '0')
                    END AS SCHEDULED_DEPARTURE,
               cast(month(l_shipdate) AS varchar) AS "MONTH",
               cast(isodow(l_shipdate) AS varchar) AS DAY_OF_WEEK,
               cast(cast(floor(l_extendedprice / 30) AS int) AS varchar) AS DISTANCE,
               CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE
               cast(5 + cast(round(l_discount * 100) AS int) + cast(round(l_tax * 100) AS int)
                    + CASE WHEN m BETWEEN 360 AND 719 THEN 6 ELSE 0 END AS varchar) END
                    AS TAXI_OUT,
               cast(cast(l_quantity AS int) - 25 + c_nationkey % 12
                    + CASE WHEN m >= 1080 THEN 8 ELSE 0 END AS varchar) AS ARRIVAL_DELAY,
               CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '1' ELSE '0' END
                   AS CANCELLED,
               CASE WHEN l_returnflag = 'A' AND l_linenumber = 1 THEN '1' ELSE '0' END AS DIVERTED
        FROM (SELECT l.*, c_nationkey,
                     cast((l_orderkey * 37 + l_linenumber * 211) % 1440 AS int) AS m
              FROM lineitem l
              JOIN orders ON l_orderkey = o_orderkey
              JOIN customer ON o_custkey = c_custkey)""",
    "airports_raw": """
        SELECT lpad(cast(code AS varchar), 3, '0') AS IATA_CODE,
               CASE WHEN code IN (4, 5) THEN 'Twin Field' WHEN n > 1 THEN name || ' and ' || (n - 1)
                    ELSE name END AS AIRPORT,
               CASE WHEN code % 10 = 9 THEN NULL
                    ELSE cast(-60 + (code * 13) % 110 AS varchar) END AS LATITUDE,
               CASE WHEN code % 10 = 9 THEN NULL
                    ELSE cast(-160 + (code * 17) % 95 AS varchar) END AS LONGITUDE,
               STATE
        FROM (SELECT s_suppkey % 1000 AS code, min(s_name) AS name, min(n_name) AS STATE,
                     count(*) AS n
              FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1)""",
    "airlines_raw": """
        SELECT lpad(cast(n_nationkey AS varchar), 2, '0') AS IATA_CODE, n_name AS AIRLINE
        FROM nation""",
    "clean": """
        SELECT * FROM flights_raw
        WHERE CANCELLED = '0' AND DIVERTED = '0' AND length(ORIGIN_AIRPORT) = 3""",
    "slotted": """
        SELECT *, CASE WHEN cast(substr(SCHEDULED_DEPARTURE, 1, 2) AS int) BETWEEN 0 AND 5
                       THEN 'Night'
                       WHEN cast(substr(SCHEDULED_DEPARTURE, 1, 2) AS int) BETWEEN 6 AND 11
                       THEN 'Morning'
                       WHEN cast(substr(SCHEDULED_DEPARTURE, 1, 2) AS int) BETWEEN 12 AND 17
                       THEN 'Afternoon'
                       ELSE 'Evening' END AS slot
        FROM clean""",
    "airline_statistic": """
        SELECT a.AIRLINE AS airline, average_delay
        FROM (SELECT AIRLINE AS code, avg(cast(ARRIVAL_DELAY AS double)) AS average_delay
              FROM clean GROUP BY 1) s
        JOIN airlines_raw a ON s.code = a.IATA_CODE""",
    "airport_statistic": """
        SELECT a.AIRPORT AS airport, slot AS time_slot, average_taxi_out
        FROM (SELECT ORIGIN_AIRPORT AS code, slot,
                     avg(cast(TAXI_OUT AS double)) AS average_taxi_out
              FROM slotted GROUP BY 1, 2) s
        JOIN airports_raw a ON s.code = a.IATA_CODE""",
    "areas": """
        SELECT *, coalesce(try_cast(LATITUDE AS double), -80) AS lat,
                  coalesce(try_cast(LONGITUDE AS double), -80) AS lon,
                  CASE WHEN coalesce(try_cast(LATITUDE AS double), -80) < -30 THEN 0 ELSE 3 END
                      AS lat_area,
                  CASE WHEN coalesce(try_cast(LONGITUDE AS double), -80) < -130 THEN 0
                       WHEN coalesce(try_cast(LONGITUDE AS double), -80) < -110 THEN 1
                       WHEN coalesce(try_cast(LONGITUDE AS double), -80) < -90 THEN 2
                       ELSE 3 END AS lon_area
        FROM airports_raw""",
    "features": """
        SELECT f.AIRLINE AS "Airline", f.slot AS "TimeSlot", cast(f."MONTH" AS int) AS "Month",
               cast(f.DAY_OF_WEEK AS int) AS "DayOfWeek", cast(f.DISTANCE AS double) AS "Distance",
               o.lat_area AS "OriginLatitudeArea", o.lon_area AS "OriginLongitudeArea",
               o.STATE AS "OriginState", d.lat_area AS "DestinationLatitudeArea",
               d.lon_area AS "DestinationLongitudeArea", d.STATE AS "DestinationState",
               f.ORIGIN_AIRPORT AS "OriginAirport", s.average_delay AS "AverageAirlineDelay",
               cast(CASE WHEN cast(f.ARRIVAL_DELAY AS int) > 0 THEN 1 ELSE 0 END AS double)
                   AS "Delay",
               t.average_taxi_out AS "AverageTaxiOut"
        FROM slotted f
        JOIN areas o ON f.ORIGIN_AIRPORT = o.IATA_CODE
        JOIN areas d ON f.DESTINATION_AIRPORT = d.IATA_CODE
        JOIN airlines_raw a ON f.AIRLINE = a.IATA_CODE
        JOIN airline_statistic s ON a.AIRLINE = s.airline
        JOIN airport_statistic t ON o.AIRPORT = t.airport AND f.slot = t.time_slot""",
    "hashed": """
        SELECT *, count(*) OVER same AS n, row_number() OVER same_in_turn AS turn, cast('0x' || substr(md5(concat_ws('|', "Airline", "TimeSlot", "Month",
                      "DayOfWeek", cast("Distance" AS bigint), "OriginState",
                      "DestinationState", "OriginAirport", cast("Delay" AS bigint))), 1, 8)
                  AS bigint) % 100 AS pct
        FROM features
        WINDOW same AS (PARTITION BY {all}), same_in_turn AS (PARTITION BY {all})""".replace(
        "{all}", ", ".join(f'"{c}"' for c in _NUMBERS + _TEXTS)
    ),
    "category_counts": """
        SELECT 'Airline' AS "column", "Airline" AS "value", count(*) AS n FROM features GROUP BY 2
        UNION ALL SELECT 'TimeSlot', "TimeSlot", count(*) FROM features GROUP BY 2
        UNION ALL SELECT 'OriginState', "OriginState", count(*) FROM features GROUP BY 2
        UNION ALL SELECT 'DestinationState', "DestinationState", count(*) FROM features GROUP BY 2
        UNION ALL SELECT 'OriginAirport', "OriginAirport", count(*) FROM features GROUP BY 2""",
    "category_index": """
        SELECT "column", "value", n,
               cast(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, "value") - 1
                    AS double) AS "index"
        FROM category_counts""",
    "assembled": """
        SELECT a."index" AS "AirlineIndex",
               least(floor(("AverageAirlineDelay" + 1) / 3), 5) AS "AverageAirlineDelayBucketed",
               os."index" AS "OriginStateIndex", ds."index" AS "DestinationStateIndex",
               ts."index" AS "TimeSlotIndex", cast("Month" AS double) AS "Month",
               cast("DayOfWeek" AS double) AS "DayOfWeek",
               least(floor("Distance" / 200), 14) AS "DistanceBucketed",
               cast("OriginLatitudeArea" AS double) AS "OriginLatitudeArea",
               cast("OriginLongitudeArea" AS double) AS "OriginLongitudeArea",
               oa."index" AS "OriginAirportIndex",
               least(floor("AverageTaxiOut" / 5), 5) AS "AverageTaxiOutBucketed",
               cast("DestinationLatitudeArea" AS double) AS "DestinationLatitudeArea",
               cast("DestinationLongitudeArea" AS double) AS "DestinationLongitudeArea"
        FROM features f
        JOIN category_index a ON a."column" = 'Airline' AND a."value" = f."Airline"
        JOIN category_index ts ON ts."column" = 'TimeSlot' AND ts."value" = f."TimeSlot"
        JOIN category_index os ON os."column" = 'OriginState' AND os."value" = f."OriginState"
        JOIN category_index ds
          ON ds."column" = 'DestinationState' AND ds."value" = f."DestinationState"
        JOIN category_index oa
          ON oa."column" = 'OriginAirport' AND oa."value" = f."OriginAirport\"""",
    "counted": """
        SELECT count(*) FILTER (p AND y) AS tp, count(*) FILTER (p AND NOT y) AS fp,
               count(*) FILTER (NOT p AND y) AS fn, count(*) FILTER (NOT p AND NOT y) AS tn
        FROM (SELECT "AverageAirlineDelay" >= 8 AS p, "Delay" = 1 AS y FROM features)""",
}

_USES = {
    "flights_raw": (),
    "airports_raw": (),
    "airlines_raw": (),
    "clean": ("flights_raw",),
    "slotted": ("clean",),
    "airline_statistic": ("clean", "airlines_raw"),
    "airport_statistic": ("slotted", "airports_raw"),
    "areas": ("airports_raw",),
    "features": ("slotted", "areas", "airlines_raw", "airline_statistic", "airport_statistic"),
    "hashed": ("features",),
    "category_counts": ("features",),
    "category_index": ("category_counts",),
    "assembled": ("features", "category_index"),
    "counted": ("features",),
}


_TREE = oracle_tree.views()


def _tree_sql(select):
    """A query over the views of the tree, which follow those of the features."""
    parts = [f"{n} AS MATERIALIZED ({_VIEWS[n]})" for n in _needed(["hashed"])]
    parts += [f"{n} AS MATERIALIZED ({v})" for n, v in _TREE.items()]
    return "WITH " + ",\n".join(parts) + "\n" + select


def _needed(names):
    wanted = set()
    open_names = list(names)
    while open_names:
        name = open_names.pop()
        if name not in wanted:
            wanted.add(name)
            open_names.extend(_USES[name])
    return [n for n in _VIEWS if n in wanted]


def _sql(select, *views):
    parts = [f"{n} AS MATERIALIZED ({_VIEWS[n]})" for n in _needed(views)]
    return "WITH " + ",\n".join(parts) + "\n" + select


_FLIGHT = "f.AIRLINE, ORIGIN_AIRPORT, DESTINATION_AIRPORT, SCHEDULED_DEPARTURE, f.\"MONTH\", " \
    "DAY_OF_WEEK, DISTANCE, TAXI_OUT, ARRIVAL_DELAY"
_PLACES = ", ".join(
    f"{short}.IATA_CODE AS {long}_IATA_CODE, {short}.AIRPORT AS {long}_AIRPORT_NAME, "
    f"{short}.LATITUDE AS {long}_LATITUDE, {short}.LONGITUDE AS {long}_LONGITUDE, "
    f"{short}.STATE AS {long}_STATE"
    for short, long in (("o", "ORIGIN"), ("d", "DESTINATION"))
)
_CLEAN = "SELECT AIRLINE, ORIGIN_AIRPORT, SCHEDULED_DEPARTURE, TAXI_OUT, ARRIVAL_DELAY FROM clean"
_TAXI_STATE = """
    SELECT ORIGIN_AIRPORT, slot AS time_slot, sum(cast(TAXI_OUT AS double)) AS total,
           count(TAXI_OUT) AS n, avg(cast(TAXI_OUT AS double)) AS average
    FROM slotted GROUP BY 1, 2"""
_SLOT = """CASE WHEN cast(substr(SCHEDULED_DEPARTURE, 1, 2) AS int) < 6 THEN 'Night'
             WHEN cast(substr(SCHEDULED_DEPARTURE, 1, 2) AS int) < 12 THEN 'Morning'
             WHEN cast(substr(SCHEDULED_DEPARTURE, 1, 2) AS int) < 18 THEN 'Afternoon'
             ELSE 'Evening' END"""
_FEATURES = """
    SELECT "Airline", "TimeSlot", "Month", "DayOfWeek", "Distance", "OriginLatitudeArea",
           "OriginLongitudeArea", "OriginState", "DestinationLatitudeArea",
           "DestinationLongitudeArea", "DestinationState", "OriginAirport",
           "AverageAirlineDelay", "Delay", "AverageTaxiOut" """

_DRAW = """cast('0x' || substr(md5(concat_ws('|', 1, "Airline", "TimeSlot", "Month",
    "DayOfWeek", cast("Distance" AS bigint), "OriginState", "DestinationState", "OriginAirport",
    cast("Delay" AS bigint), turn)), 1, 8) AS bigint)"""
_VECTOR = (
    "AirlineIndex AverageAirlineDelayBucketed OriginStateIndex DestinationStateIndex "
    "TimeSlotIndex Month DayOfWeek DistanceBucketed OriginLatitudeArea OriginLongitudeArea "
    "OriginAirportIndex AverageTaxiOutBucketed DestinationLatitudeArea DestinationLongitudeArea"
).split()


def _summary():
    rows = [
        f"""SELECT '{c}' AS "column", count("{c}") AS n, round(avg("{c}"), 6) AS mean,
            round(stddev_samp("{c}"), 6) AS stddev, cast(min("{c}") AS double) AS min_number,
            cast(max("{c}") AS double) AS max_number, cast(NULL AS varchar) AS min_text,
            cast(NULL AS varchar) AS max_text FROM features"""
        for c in _NUMBERS
    ] + [
        f"""SELECT '{c}', count("{c}"), NULL, NULL, NULL, NULL, min("{c}"), max("{c}")
            FROM features"""
        for c in _TEXTS
    ]
    return "\nUNION ALL ".join(rows)


def _bucket(column, low, step, last):
    return _sql(
        f"""SELECT "{column}" AS "value", least(floor(("{column}" - ({low})) / {step}), {last})
                AS bucket, count(*) AS n FROM features GROUP BY 1, 2""",
        "features",
    )


def _normalized():
    norm = "sqrt(" + " + ".join(f'"{c}" * "{c}"' for c in _VECTOR) + ")"
    columns = ", ".join(f'round("{c}" / norm, 6) AS "{c}"' for c in _VECTOR)
    return f"SELECT {columns} FROM (SELECT *, {norm} AS norm FROM assembled)"


def oracle_sql():
    return {
        "flights_raw": _sql("SELECT * FROM flights_raw", "flights_raw"),
        "csv_header_scan": _sql("SELECT * FROM flights_raw", "flights_raw"),
        "csv_positional_scan": _sql(_CLEAN, "clean"),
        "feature_table_scan": _sql(_FEATURES + "FROM features", "features"),
        "trimmed_record_scan": _sql(_CLEAN, "clean"),
        "ragged_csv_scan": _sql(
            """SELECT AIRLINE, ORIGIN_AIRPORT, SCHEDULED_DEPARTURE,
                      CASE WHEN AIRLINE <> '03' THEN cast(TAXI_OUT AS double) END AS TAXI_OUT,
                      CASE WHEN AIRLINE <> '03' THEN cast(ARRIVAL_DELAY AS double) END
                          AS ARRIVAL_DELAY
               FROM clean WHERE AIRLINE <> '11'""",
            "clean",
        ),
        "ragged_lines_aside": _sql(
            """SELECT fields, reason, reason <> 'malformed' AS kept, count(*) AS n,
                      min(line) AS first_line, max(line) AS last_line
               FROM (SELECT CASE AIRLINE WHEN '03' THEN 3 WHEN '07' THEN 7 ELSE 5 END AS fields,
                            CASE AIRLINE WHEN '03' THEN 'short' WHEN '07' THEN 'long'
                                         ELSE 'malformed' END AS reason,
                            AIRLINE || ',' || ORIGIN_AIRPORT || ',' || SCHEDULED_DEPARTURE
                            || CASE AIRLINE WHEN '03' THEN ''
                                            WHEN '11' THEN ',n/a,' || coalesce(ARRIVAL_DELAY, '')
                                            ELSE ',' || coalesce(TAXI_OUT, '') || ','
                                                 || coalesce(ARRIVAL_DELAY, '') || ',x,y' END
                                AS line
                     FROM clean WHERE AIRLINE IN ('03', '07', '11'))
               GROUP BY ALL""",
            "clean",
        ),
        "stage_roundtrip": _sql(_TAXI_STATE, "slotted"),
        "csv_sink_roundtrip": _sql("SELECT * FROM airport_statistic", "airport_statistic"),
        "clean_flights": _sql(_CLEAN, "clean"),
        "clean_flights_typed": _sql(
            """SELECT AIRLINE, ORIGIN_AIRPORT, SCHEDULED_DEPARTURE,
                      cast(TAXI_OUT AS double) AS TAXI_OUT,
                      cast(ARRIVAL_DELAY AS double) AS ARRIVAL_DELAY FROM clean""",
            "clean",
        ),
        "clean_airlines": _sql("SELECT * FROM airlines_raw", "airlines_raw"),
        "clean_airports": _sql("SELECT IATA_CODE, AIRPORT FROM airports_raw", "airports_raw"),
        "airline_delay_leaderboard": _sql(
            """SELECT row_number() OVER (ORDER BY average_delay DESC, airline) AS "rank",
                      airline, average_delay FROM airline_statistic""",
            "airline_statistic",
        ),
        "airline_delay_sql": _sql("SELECT * FROM airline_statistic", "airline_statistic"),
        "airline_delay_state": _sql(
            """SELECT AIRLINE, sum(cast(ARRIVAL_DELAY AS double)) AS total,
                      count(ARRIVAL_DELAY) AS n, avg(cast(ARRIVAL_DELAY AS double)) AS average
               FROM clean GROUP BY 1""",
            "clean",
        ),
        "airline_delay_merged_state": _sql(
            """SELECT AIRLINE, sum(cast(ARRIVAL_DELAY AS double)) AS total,
                      count(ARRIVAL_DELAY) AS n, avg(cast(ARRIVAL_DELAY AS double)) AS average
               FROM clean GROUP BY 1""",
            "clean",
        ),
        "strict_double_sql_function": _sql(
            """SELECT AIRLINE, sum(cast(ARRIVAL_DELAY AS double)) AS total_delay,
                      max(cast(TAXI_OUT AS double)) AS longest_taxi_out,
                      min(cast(ARRIVAL_DELAY AS double)) AS least_delay
               FROM clean GROUP BY 1""",
            "clean",
        ),
        "area_sql_functions": _sql(
            """SELECT IATA_CODE, lat_area AS latitude_area, lon_area AS longitude_area,
                      cast(IATA_CODE AS double) AS code FROM areas""",
            "areas",
        ),
        "airport_slot_taxi_leaderboard": _sql(
            """SELECT row_number() OVER (ORDER BY average_taxi_out DESC, airport, time_slot)
                          AS "rank", airport, time_slot, average_taxi_out
               FROM airport_statistic""",
            "airport_statistic",
        ),
        "airport_slot_taxi_state": _sql(_TAXI_STATE, "slotted"),
        "airport_rank_within_slot": _sql(
            """SELECT row_number() OVER (PARTITION BY time_slot
                          ORDER BY average_taxi_out DESC, airport) AS "rank",
                      airport, time_slot, average_taxi_out FROM airport_statistic""",
            "airport_statistic",
        ),
        "enrich_origin_destination": _sql(
            f"""SELECT {_FLIGHT}, {_PLACES} FROM clean f
                JOIN airports_raw o ON ORIGIN_AIRPORT = o.IATA_CODE
                JOIN airports_raw d ON DESTINATION_AIRPORT = d.IATA_CODE""",
            "clean",
            "airports_raw",
        ),
        "enrich_airline": _sql(
            f"""SELECT {_FLIGHT}, a.IATA_CODE AS AIRLINES_IATA_CODE, a.AIRLINE AS AIRLINES_NAME
                FROM clean f JOIN airlines_raw a ON f.AIRLINE = a.IATA_CODE""",
            "clean",
            "airlines_raw",
        ),
        "enrich_airline_stats": _sql(
            f"""SELECT {_FLIGHT}, a.IATA_CODE AS AIRLINES_IATA_CODE, a.AIRLINE AS AIRLINES_NAME,
                       s.airline AS STATISTIC_AIRLINES_NAME,
                       s.average_delay AS STATISTICS_AVG_DELAY
                FROM clean f JOIN airlines_raw a ON f.AIRLINE = a.IATA_CODE
                JOIN airline_statistic s ON a.AIRLINE = s.airline""",
            "clean",
            "airline_statistic",
        ),
        "enrich_airport_stats": _sql(
            f"""SELECT {_FLIGHT}, {_PLACES}, slot AS TIME_SLOT,
                       s.airport AS STATISTIC_AIRPORT_NAME, s.time_slot AS STATISTIC_TIME_SLOT,
                       s.average_taxi_out AS AVG_TAXI_OUT
                FROM slotted f JOIN airports_raw o ON ORIGIN_AIRPORT = o.IATA_CODE
                JOIN airports_raw d ON DESTINATION_AIRPORT = d.IATA_CODE
                JOIN airport_statistic s ON o.AIRPORT = s.airport AND slot = s.time_slot""",
            "airport_statistic",
        ),
        "feature_table": _sql(_FEATURES + "FROM features", "features"),
        "feature_summary": _sql(_summary(), "features"),
        "time_slot_scalar": _sql(
            f"""SELECT SCHEDULED_DEPARTURE, {_SLOT} AS time_slot, count(*) AS n
                FROM flights_raw GROUP BY 1, 2""",
            "flights_raw",
        ),
        "time_slot_ordinal": _sql(
            f"""SELECT CASE time_slot WHEN 'Morning' THEN 0 WHEN 'Afternoon' THEN 1
                                      WHEN 'Evening' THEN 2 ELSE 3 END AS ordinal,
                       time_slot, count(*) AS n
                FROM (SELECT {_SLOT} AS time_slot FROM flights_raw) GROUP BY 1, 2""",
            "flights_raw",
        ),
        "time_slot_sql_function": _sql(
            f"""SELECT {_SLOT} AS time_slot,
                       CASE WHEN cast(ARRIVAL_DELAY AS int) > 0 THEN '1' ELSE '0' END
                           AS delay_label,
                       count(*) AS n
                FROM flights_raw GROUP BY 1, 2""",
            "flights_raw",
        ),
        "delay_label": _sql(
            """SELECT cast(ARRIVAL_DELAY AS int) AS arrival_delay,
                      cast(CASE WHEN cast(ARRIVAL_DELAY AS int) > 0 THEN 1 ELSE 0 END AS double)
                          AS delay_label,
                      count(*) AS n
               FROM flights_raw GROUP BY 1, 2""",
            "flights_raw",
        ),
        "latitude_area": _sql("SELECT IATA_CODE, lat_area AS latitude_area FROM areas", "areas"),
        "longitude_area": _sql("SELECT IATA_CODE, lon_area AS longitude_area FROM areas", "areas"),
        "parse_double_default": _sql(
            """SELECT IATA_CODE, cast(lat AS double) AS latitude, cast(lon AS double) AS longitude,
                      coalesce(try_cast(STATE AS double), cast(-80 AS double)) AS not_a_number
               FROM areas""",
            "areas",
        ),
        "sample_hash_20": _sql(_FEATURES + "FROM hashed WHERE turn <= n * 20 // 100 + (pct < n * 20 % 100)::int", "hashed"),
        "split_hash_70_30": _sql(
            _FEATURES + """, CASE WHEN turn <= n * 70 // 100 + (pct < n * 70 % 100)::int
                                  THEN 'Train' ELSE 'Test' END AS "set"
            FROM hashed""",
            "hashed",
        ),
        "sample_bernoulli_20": _sql(
            _FEATURES + f"FROM hashed WHERE {_DRAW} * 100 < 20 * 4294967296", "hashed"
        ),
        "split_random_70_30": _sql(
            _FEATURES + f""", CASE WHEN {_DRAW} * 100 < 70 * 4294967296
                                  THEN 'Train' ELSE 'Test' END AS "set"
            FROM hashed""",
            "hashed",
        ),
        "string_index": _sql("SELECT * FROM category_index", "category_index"),
        "bucketize_distance": _bucket("Distance", 0, 200, 14),
        "bucketize_average_delay": _bucket("AverageAirlineDelay", -1, 3, 5),
        "bucketize_taxi_out": _bucket("AverageTaxiOut", 0, 5, 5),
        "assemble_features": _sql("SELECT * FROM assembled", "assembled"),
        "l2_normalize": _sql(_normalized(), "assembled"),
        "tree_evaluation": _tree_sql(oracle_tree.METRICS),
        "tree_report": _tree_sql(oracle_tree.REPORT),
        "tree_nodes": _tree_sql(oracle_tree.nodes()),
        "confusion_metrics": _sql(
            """SELECT tp, fp, fn, tn, (tp + tn) / nullif(tp + fp + fn + tn, 0) AS accuracy,
                      tp / nullif(tp + fp, 0) AS "precision", tp / nullif(tp + fn, 0) AS recall
               FROM counted""",
            "counted",
        ),
        "auc_hard_labels": _sql(
            "SELECT (tp / (tp + fn) + tn / (fp + tn)) / 2 AS auc FROM counted", "counted"
        ),
    }
