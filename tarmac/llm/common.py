"""Small helpers the operators share."""

from contextlib import contextmanager

from pyspark.sql import functions as F

TABLES = ("documents", "embeddings", "benchmark", "labels")


def table(spark, sf_dir, name):
    """One of the given tables; the folder may be in any store Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(frame, base):
    """A column name that no column of the frame has, whatever the case of its letters."""
    taken = {c.lower() for c in frame.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def crc_of_id(key):
    """crc32 of a key written as text; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))


def ascii_lower(text):
    """UTF-8 bytes with A-Z lower-cased; null is empty."""
    return text.encode().lower() if text else b""


def shuffle_partitions(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def settings(spark, **values):
    """Session settings for the jobs started inside."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
