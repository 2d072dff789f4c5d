"""Session settings the jobs rely on."""

from pyspark.sql import SparkSession


def build_session(app_name="tarmac", **extra):
    """A session with the settings the plans are designed for.

    Master, memory and ``spark.checkpoint.dir`` come from spark-submit. AQE sizes the
    shuffle partitions and splits hot keys in shuffled joins; ANSI mode makes a
    malformed number fail instead of turning into null.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **extra,
    }
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
