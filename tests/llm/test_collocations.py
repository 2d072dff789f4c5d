"""Collocation mining against its contract."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tarmac.llm import collocations
from tests.conftest import DATA
from tests.llm.brute import phrases
from tools.compare import compare, connect

SCHEMA = "doc_id long, lang string, text string"
COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def result(table, **options):
    found = collocations.collocations(table, **options)
    return sorted(tuple(r[c] for c in COLUMNS) for r in found.collect())


def test_equals_its_sql(spark):
    name = "op13_setm"
    assert compare(connect(DATA), registry.queries()[name](spark, DATA), name) is None


def corpus(seed, n=150):
    rng = random.Random(seed)
    fixed = ["new york city hall", "New York", "a a a a", "more or less", "é É"]
    rows = []
    for key in range(n):
        parts = []
        for _ in range(rng.randrange(30)):
            parts.append(rng.choice(fixed) if rng.random() < 0.4 else f"w{rng.randrange(12)}")
            parts.append(rng.choice([" ", "  ", "\t", ", ", ".", "\n", " ; ", "\r"]))
        rows.append((key, rng.choice(["en", "de", None, "und"]), "".join(parts)))
    return rows


@pytest.mark.parametrize(("least", "top"), [(2, 2000), (8, 2000), (20, 5)])
def test_equals_brute_force(spark, least, top):
    rows = corpus(least)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    expected = sorted(phrases([r[1:] for r in rows], least, top=top))
    assert expected
    assert result(table, least=least, top=top) == expected


def test_groups_joined_by_shuffle_and_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BROADCAST_LIMIT", 0)
    rows = corpus(7)
    table = spark.createDataFrame(rows, SCHEMA)
    expected = sorted(phrases([r[1:] for r in rows], 8))
    assert result(table, least=8, bucket_words=100) == expected


def test_odd_rows(spark):
    rows = [
        (1, None, None),
        (None, "en", "to be"),
        (2, "en", ""),
        (3, None, " \n\t "),
        (4, "en", "word " * 30_000),
        (5, "de", "so oft so oft"),
        (6, "de", "so oft so oft"),
        (6, "de", "so oft so oft"),
        (7, "", "no name no name"),
    ]
    table = spark.createDataFrame(rows, SCHEMA)
    names = ("rid", "pos", "word", "gid", "a", "n", "phrase", "rank", "left")
    table = table.withColumns({name: F.lit("own") for name in names})
    expected = sorted(phrases([r[1:] for r in rows], 2))
    assert {r[0] for r in expected} == {"en", "de", ""}
    assert result(table, least=2) == expected
    assert result(table.limit(0)) == []


def test_products_beyond_64_bits(spark):
    """n and a of 10^12 and more, as a corpus of 100 TB has them."""
    a, n, left, right = 3 * 10**12 + 1, 7 * 10**14 + 3, 5 * 10**12 + 7, 4 * 10**12 + 9
    row = spark.createDataFrame(
        [(a, n, [left, a], [right, a])], "a long, n long, firsts array<long>, lasts array<long>"
    )
    cut = row.select(collocations._best_cut(2).alias("cut")).first()["cut"]
    assert cut == (1000 * a * n // (left * right), 1, left, right)


def test_relations_meet_without_a_shuffle(spark, tmp_path):
    rows = spark.range(1000).select(
        (F.col("id") % 50).alias("rid"), F.col("id").cast("int").alias("pos"), F.lit(1).alias("gid")
    )
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    with collocations.settings(spark, **{key: "false"}):
        with collocations._relations(spark, 4) as relations:
            joined = collocations._adjacent(relations.write(rows))
            text = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in text and "Exchange" not in text
        assert not [t for t in spark.catalog.listTables() if t.name.startswith("occurrences_")]
