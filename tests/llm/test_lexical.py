"""Ranked lexical search against its contract."""

import random
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tarmac.llm import lexical
from tests.conftest import DATA
from tests.llm.brute import ranked
from tools.compare import compare, connect

DOCS, ITEMS = "doc_id long, text string", "item_id string, text string"


def result(found):
    columns = ("item_id", "rank", "doc_id", "score")
    return sorted(
        (tuple(r[c] for c in columns) for r in found.collect()), key=lambda r: (r[0] or "", *r[1:2])
    )


def test_equals_its_sql(spark):
    name = "op12_dense_tiles"
    assert compare(connect(DATA), registry.queries()[name](spark, DATA), name) is None


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n: rng.choice([" ", ", ", "\x00"]).join(
        rng.choice(["Ab", "ab", "é", "É", "z9", "x", "y_y", "q-r"]) + str(int(rng.expovariate(0.1)))
        for _ in range(rng.randrange(n))
    )
    docs = [(key, text(60)) for key in range(150)]
    docs += [(key + 200, body) for key, body in docs[:60]]
    return docs, [(f"i{i}", text(12)) for i in range(30)]


def test_equals_brute_force(spark):
    docs, items = corpus(1)
    rng = random.Random(2)
    table = spark.createDataFrame(rng.sample(docs, len(docs)), DOCS).repartition(3)
    found = lexical.rank_documents(table, spark.createDataFrame(items, ITEMS))
    assert result(found) == sorted(ranked(docs, items), key=lambda r: r[:2])


@pytest.mark.parametrize("tiles", [(256, 1024, 1024, 1 << 20), (4, 3, 7, 40), (1, 1, 1, 1)])
def test_tiles_of_any_size(monkeypatch, tiles):
    """The tiles of one task, worked off here: workers would not see other sizes."""
    for name, size in zip(("QUERY_TILE", "TERM_TILE", "DOCUMENT_TILE", "TILE_CELLS"), tiles):
        monkeypatch.setattr(lexical, name, size)
    docs, items = corpus(6)
    counts = lambda text: Counter(
        t for terms in lexical.terms_of(text.encode()) for t in terms
    )
    numbers = {}
    queries = [
        {numbers.setdefault(t, len(numbers) + 1): n for t, n in counts(text).items()}
        for _, text in items
    ]
    batch = pa.RecordBatch.from_pydict(
        {"key": [k for k, _ in docs], "text": [t.encode() for _, t in docs]}
    )
    vectors = list(lexical._vectors(SimpleNamespace(value=numbers))([batch]))
    held = Counter(t for v in vectors for terms in v["terms"].to_pylist() for t in terms)
    lengths = [n for v in vectors for n in v["n"].to_pylist()]
    holding = sum(n > 0 for n in lengths)
    weights = {t: lexical.weight(holding, n) for t, n in held.items()}
    tiles = list(lexical.query_tiles(queries, weights))
    best = lexical.Best(len(queries), 10)
    for part in vectors:
        for at in range(0, len(part), lexical.DOCUMENT_TILE):
            own = part.slice(at, lexical.DOCUMENT_TILE)
            place = np.repeat(np.arange(len(own)), own["terms"].value_lengths().to_numpy())
            factors = np.array(
                [lexical.length_factor(n, holding, sum(lengths)) for n in own["n"].to_pylist()]
            )
            values = lexical.impacts(own["counts"].flatten().to_numpy(), factors[place])
            keys = own["key"].to_numpy()
            for first, tile in tiles:
                scores = tile.scores(place, own["terms"].flatten().to_numpy(), values, len(own))
                if scores is not None:
                    best.add(first, scores, np.ones(len(own), bool), keys)
    found = [
        (item, i + 1, key, score)
        for (item, _), (scores, _, keys) in zip(items, best.rows)
        for i, (key, score) in enumerate(zip(keys.tolist(), scores.tolist()))
    ]
    assert sorted(found) == sorted(ranked(docs, items))


def test_several_passes(spark, monkeypatch):
    monkeypatch.setattr(lexical, "PASS_BYTES", 700)
    docs, items = corpus(3)
    found = lexical.rank_documents(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    )
    assert result(found) == sorted(ranked(docs, items), key=lambda r: r[:2])


def test_odd_rows(spark):
    docs = [
        (None, "one two"),
        (None, "one two"),
        (1, None),
        (2, ""),
        (3, " ... "),
        (4, "one " * 50_000),
        (5, "two three"),
        (5, "two three"),
        (6, "one two"),
    ]
    items = [("a", "One"), ("b", None), ("c", ""), (None, "two two"), ("d", "absent"), ("e", "three")]
    table = spark.createDataFrame(docs, DOCS)
    table = table.withColumns({c: F.lit("own") for c in ("key", "n", "terms", "score", "rank")})
    queries = spark.createDataFrame(items, ITEMS)
    queries = queries.withColumns({c: F.lit("own") for c in ("query", "item", "key")})
    found = lexical.rank_documents(table, queries)
    assert result(found) == sorted(ranked(docs, items), key=lambda r: (r[0] or "", r[1]))
    assert result(lexical.rank_documents(table.limit(0), queries)) == []
    assert result(lexical.rank_documents(table, queries.limit(0))) == []


def test_repeated_items_are_answered_each(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b c"), (3, "d")], DOCS)
    items = spark.createDataFrame([("i", "a"), ("i", "a"), ("i", "c")], ITEMS)
    found = lexical.rank_documents(docs, items)
    assert [(r[1], r[2]) for r in result(found)].count((1, 1)) == 2
    assert found.count() == 3


def test_ties_take_the_least_keys(spark):
    """Many copies: the ten least keys, whatever task holds them."""
    table = spark.range(5000).select(
        (5000 - F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "alpha beta").otherwise("alpha").alias("text"),
    )
    items = spark.createDataFrame([("i", "beta")], ITEMS)
    found = result(lexical.rank_documents(table.repartition(9), items))
    keys = sorted(5000 - i for i in range(0, 5000, 3))[:10]
    assert [r[2] for r in found] == keys and len({r[3] for r in found}) == 1


def test_heavy_weights_stay_exact():
    """Weights far beyond a tile's bound, over several terms, against whole numbers."""
    rng = random.Random(5)
    weights = {t: rng.randrange(1, 30_000) for t in range(1, 9)}
    queries = [{t: rng.randrange(1, 10**8) for t in weights} for _ in range(4)]
    queries.append({3: 7})
    tile = lexical.QueryTile(queries, weights)
    assert len(tile.parts) > 1 and any(len(planes) == 2 for *_, planes in tile.parts)
    documents = np.repeat(np.arange(3), 8)
    terms = np.tile(np.arange(1, 9), 3)
    values = np.array([rng.randrange(10**6) for _ in terms])
    scores = tile.scores(documents, terms, values, 3)
    for i, query in enumerate(queries):
        for d in range(3):
            own = values[documents == d].tolist()
            exact = sum(n * weights[t] * own[t - 1] for t, n in query.items())
            assert int(scores[i, d]) == exact


def test_long_texts_in_segments(monkeypatch):
    monkeypatch.setattr(lexical, "SEGMENT_BYTES", 5)
    text = "One two,three  FOURé five--six".encode()
    found = [t for part in lexical.terms_of(text) for t in part]
    assert found == [t.encode() for t in ("one", "two", "three", "fouré", "five", "six")]
