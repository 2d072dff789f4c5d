"""Samples and splits, the same on every layout of a table."""

import random

from pyspark.sql import functions as F

from tarmac.constants import SAMPLE_PERCENT, SPLIT_SEED, TRAIN_PERCENT

# Columns whose text a feature row is hashed by; whole numbers are hashed as such.
CONTENT_KEY = (
    "Airline",
    "TimeSlot",
    "Month",
    "DayOfWeek",
    "Distance",
    "OriginState",
    "DestinationState",
    "OriginAirport",
    "Delay",
)


def _text(table, name):
    whole = table.schema[name].dataType.typeName() == "double"
    return (F.col(name).cast("long") if whole else F.col(name)).cast("string")


def _hash(*texts):
    """A whole number below 2^32 from the texts."""
    digest = F.md5(F.concat_ws("|", *texts))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def hash_percent(table, key=CONTENT_KEY):
    """A number 0..99 from the row's content, the same on every layout of the table."""
    return _hash(*[_text(table, c) for c in key]) % 100


def _drawn(table, percent, seed, key):
    """Each row on its own, with ``_hit``, true with the given chance.

    The draw comes from the seed, the row's content and its number among equal rows, so it does
    not matter how the table is laid out, or when it is read again.
    """
    counted = table.groupBy(*table.columns).agg(F.count("*").alias("_n"))
    single = _repeated(counted, F.col("_n"), number="_turn")
    draw = _hash(F.lit(str(seed)), *[_text(table, c) for c in key], F.col("_turn").cast("string"))
    return single.select(*table.columns, (draw * 100 < F.lit(percent << 32)).alias("_hit"))


def shared_out(weight, percent, chance):
    """``percent`` of ``weight`` equal rows; a fraction of a row is decided by ``chance``, 0..99."""
    whole = F.floor(weight * percent / 100).cast("long")
    return whole + (chance < weight * percent - whole * 100).cast("long")


def _counted(table, key):
    """Equal rows as one, with their number ``_n`` and the chance of their content."""
    counted = table.groupBy(*table.columns).agg(F.count("*").alias("_n"))
    return counted.withColumn("_chance", hash_percent(counted, key))


def _repeated(table, times, number=None):
    """Each row so many times, in runs of bounded length; ``number`` names a column for 1, 2, ...

    The runs are dealt out before they are filled, so a row that makes up a third of the table
    is not unfolded by one task.
    """
    run = 4096
    runs = table.withColumn("_left", times).withColumn(
        "_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_left") - 1, F.lit(run).cast("long")))
    )
    last = F.least(F.col("_left") - F.col("_at"), F.lit(run)).cast("int")
    rows = runs.hint("rebalance").withColumn("_one", F.explode(F.sequence(F.lit(1), last)))
    if number:
        rows = rows.withColumn(number, F.col("_at") + F.col("_one"))
    return rows.drop("_left", "_at", "_one")


def hash_sample(table, percent=SAMPLE_PERCENT, key=CONTENT_KEY):
    """``percent`` of the rows, of equal rows as many of each, the same on every layout."""
    counted = _counted(table, key)
    taken = counted.withColumn("_n", shared_out(F.col("_n"), percent, F.col("_chance")))
    return _repeated(taken.where("_n > 0"), F.col("_n")).select(*table.columns)


def bernoulli_sample(table, percent=SAMPLE_PERCENT, seed=None, key=CONTENT_KEY):
    """Each row on its own with the given chance, without replacement; no seed draws one."""
    seed = random.randrange(1 << 31) if seed is None else seed
    return _drawn(table, percent, seed, key).where("_hit").drop("_hit")


def hash_split(table, train_percent=TRAIN_PERCENT, key=CONTENT_KEY):
    """The table with a ``set`` column, Train or Test, the same on every layout.

    Equal rows are shared out between the sets by ``train_percent``, so none is one-sided.
    """
    sets = hash_split_weights(table, train_percent, key)
    return _repeated(sets, F.col("weight")).select(*table.columns, "set")


def hash_split_weights(table, train_percent=TRAIN_PERCENT, key=CONTENT_KEY):
    """The same split with equal rows of a set as one row and their number as ``weight``."""
    train = shared_out(F.col("_n"), train_percent, F.col("_chance"))
    shares = [
        F.struct(F.lit("Train").alias("set"), train.alias("weight")),
        F.struct(F.lit("Test").alias("set"), (F.col("_n") - train).alias("weight")),
    ]
    return (
        _counted(table, key)
        .select(*table.columns, F.inline(F.array(*shares)))
        .where("weight > 0")
    )


def random_split(table, train_percent=TRAIN_PERCENT, seed=SPLIT_SEED, key=CONTENT_KEY):
    """The table with a ``set`` column drawn row by row."""
    drawn = _drawn(table, train_percent, seed, key)
    return drawn.select(*table.columns, F.when(F.col("_hit"), "Train").otherwise("Test").alias("set"))
