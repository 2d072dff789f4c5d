"""Flight-shaped tables derived from a star schema of orders and suppliers.

One line item is one flight: its customer's nation is the airline, its supplier the
origin airport. Airport codes have three digits, so all suppliers that share a code
form one airport, described by all of them, and the airport table stays bounded.
"""

from pyspark.sql import functions as F

from tarmac.operators.joins import broadcast_if_small

CODES = 1000


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def flights_raw(spark, folder):
    """The flight facts, all columns text.

    Orders meet their customers first, so the line items, the large side, are
    shuffled once and only by order; AQE splits an order that holds many lines. Some
    flights have an airline that no table knows, no taxi-out time, or depart at hour 24.
    """
    orders = _table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    customers = _table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_nationkey"
    )
    lines = _table(spark, folder, "lineitem")
    joined = lines.join(nations, F.col("l_orderkey") == F.col("o_orderkey"))

    minute = "cast((l_orderkey * 37 + l_linenumber * 211) % 1440 AS int) AS minute"
    return joined.selectExpr("*", minute).selectExpr(
        "if(l_orderkey % 101 = 0, 'ZZ', lpad(cast(c_nationkey AS string), 2, '0')) AS AIRLINE",
        f"lpad(cast(l_suppkey % {CODES} AS string), if(l_linenumber = 7, 5, 3), '0')"
        " AS ORIGIN_AIRPORT",
        "lpad(cast(l_partkey % 10 AS string), 3, '0') AS DESTINATION_AIRPORT",
        "if(minute = 0, '2400', lpad(cast(minute div 60 * 100 + minute % 60 AS string), 4, '0'))"
        " AS SCHEDULED_DEPARTURE",
        "cast(month(l_shipdate) AS string) AS MONTH",
        "cast(weekday(l_shipdate) + 1 AS string) AS DAY_OF_WEEK",
        "cast(floor(l_extendedprice / 30) AS string) AS DISTANCE",
        "cast(if(l_partkey % 97 = 0, null, 5 + cast(round(l_discount * 100) AS int) + cast(round(l_tax * 100) AS int)"
        " + if(minute BETWEEN 360 AND 719, 6, 0)) AS string) AS TAXI_OUT",
        "cast(cast(l_quantity AS int) - 25 + c_nationkey % 12 + if(minute >= 1080, 8, 0)"
        " AS string) AS ARRIVAL_DELAY",
        "if(l_returnflag = 'R' AND l_linestatus = 'F', '1', '0') AS CANCELLED",
        "if(l_returnflag = 'A' AND l_linenumber = 1, '1', '0') AS DIVERTED",
    )


def airports_raw(spark, folder):
    """One airport per code, named and placed by all its suppliers; some lack coordinates.

    The name is the first of theirs with the number of the others, the state the first of
    their nations. Codes 4 and 5 have one name, as equal names are common.
    """
    nations = _table(spark, folder, "nation").select("n_nationkey", "n_name")
    suppliers = _table(spark, folder, "supplier").selectExpr(
        "s_name", "s_nationkey", f"s_suppkey % {CODES} AS code"
    )
    airports = suppliers.join(
        broadcast_if_small(nations)[0], F.col("s_nationkey") == F.col("n_nationkey")
    ).groupBy("code").agg(
        F.min("s_name").alias("name"), F.min("n_name").alias("STATE"), F.count("*").alias("n")
    )
    return airports.selectExpr(
        "lpad(cast(code AS string), 3, '0') AS IATA_CODE",
        "if(code IN (4, 5), 'Twin Field', name || if(n > 1, ' and ' || (n - 1), '')) AS AIRPORT",
        "if(code % 10 != 9, cast(code * 13 % 110 - 60 AS string), null) AS LATITUDE",
        "if(code % 10 != 9, cast(code * 17 % 95 - 160 AS string), null) AS LONGITUDE",
        "STATE",
    )


def airlines_raw(spark, folder):
    """One airline per nation."""
    return _table(spark, folder, "nation").selectExpr(
        "lpad(cast(n_nationkey AS string), 2, '0') AS IATA_CODE", "n_name AS AIRLINE"
    )
