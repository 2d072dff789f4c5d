"""Removal of repeated passages against its contract."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tarmac.llm import passages
from tests.conftest import DATA, plan
from tests.llm.brute import kept_words
from tools.compare import compare, connect

SCHEMA = "doc_id long, text string"


def result(table, **options):
    found = passages.remove_repeated_passages(table, **options)
    return Counter(
        (r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in found.collect()
    )


def expected(rows, size=20):
    return Counter((row[0], *found) for row, found in zip(rows, kept_words(rows, size)))


def test_equals_its_sql(spark):
    name = "op11_passages"
    assert compare(connect(DATA), registry.queries()[name](spark, DATA), name) is None


def corpus(seed, n=120):
    """Texts of few words, so that windows repeat within and across texts, in every order."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for key in range(n):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(90))]
        if rng.random() < 0.5:
            a, b = sorted(rng.sample(range(61), 2))
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage[a:b]
        if rng.random() < 0.2:
            words += ["again"] * rng.randrange(60)
        rows.append((key * 3 - 50, rng.choice([" ", "\n", " \t ", "\x0b"]).join(words)))
    return rows


@pytest.mark.parametrize("chunk_bits", [0, 3, 12])
def test_equals_brute_force(spark, chunk_bits):
    rows = corpus(chunk_bits)
    mixed = random.Random(1).sample(rows, len(rows))
    table = spark.createDataFrame(mixed, SCHEMA).repartition(5)
    assert result(table, chunk_bits=chunk_bits) == expected(rows)


def test_small_windows(spark):
    rows = corpus(9, 60)
    assert result(spark.createDataFrame(rows, SCHEMA), size=3) == expected(rows, 3)


def test_odd_rows(spark):
    copy = " ".join(f"c{i}" for i in range(25))
    short = " ".join(f"s{i}" for i in range(19))
    rows = [
        (None, copy),
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "word " * 30_000),
        (5, short),
        (5, short),
        (6, copy),
        (6, copy),
        (7, "é ß " * 40),
        (8, "x" * 100_000 + " " + copy),
    ]
    table = spark.createDataFrame(rows, SCHEMA)
    names = ("rid", "place", "chunk", "kind", "key", "slice", "body", "h1", "kept", "n_words")
    assert result(table.withColumns({name: F.lit("own") for name in names})) == expected(rows)
    assert result(table.limit(0)) == Counter()


def test_equal_keys_follow_one_another(spark):
    """Rows of one key: each passage is kept once, whichever row is first."""
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, f"{passage} one"), (1, f"{passage} two"), (1, f"{passage} two"), (0, "alone")]
    found = passages.remove_repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()
    removed = sorted(r["n_removed"] for r in found)
    assert removed == [0, 0, 30, 31]


def test_kept_text(spark):
    first = " ".join(f"p{i}" for i in range(22))
    rows = [(1, first), (2, f"before  {first}\nafter")]
    found = passages.remove_repeated_passages(spark.createDataFrame(rows, SCHEMA))
    assert {r["doc_id"]: r["kept"] for r in found.collect()} == {1: first, 2: "before after"}


def test_long_texts_in_segments(spark, monkeypatch):
    rows = corpus(4, 80)
    whole = [passages.normalised(t.encode()) for _, t in rows]
    monkeypatch.setattr(passages, "SEGMENT_BYTES", 40)
    for text in whole:
        if not text:
            continue
        parts = list(passages.segments(text, 5))
        assert len(parts) > 1 or len(text) < 80
        words = text.split()
        windows = [
            (word + i, tuple(part.split()[i : i + 5]))
            for word, part in parts
            for i in range(len(part.split()) - 4)
        ]
        assert windows == [(i, tuple(words[i : i + 5])) for i in range(len(words) - 4)]


def test_packed_numbers_come_back():
    for numbers in ([], [0], [5, 5, 9], [0, 1, 2**25 - 1], list(range(0, 2**24, 999))):
        numbers = np.array(numbers, np.uint32)
        assert (passages.unpack(passages.pack(numbers)) == numbers).all()


@pytest.mark.parametrize("width_bits", [24, 3])
def test_sketch_never_underestimates(monkeypatch, width_bits):
    monkeypatch.setattr(passages, "WIDTH_BITS", width_bits)
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 2**63, 4000).astype(np.uint64)
    chunks = [hashes[:3000], hashes[2500:], np.repeat(hashes[:1], 3)]
    repeated = set(hashes[2500:3000].tolist()) | {int(hashes[0])}
    for row in range(passages.ROWS):
        found = {}
        by_slice = {}
        for chunk in chunks:
            for own, number, packed in passages.partition_sketch(chunk, 7):
                if own == row:
                    by_slice.setdefault(number, []).append(packed)
        for number, sketches in by_slice.items():
            for places in passages.merge_sketches(sketches):
                found.update(dict.fromkeys((number << passages.WIDTH_BITS) + places.astype(int)))
        cells = passages.cells(hashes, row, 7).tolist()
        marked = {h for h, cell in zip(hashes.tolist(), cells) if cell in found}
        assert repeated <= marked
        assert len(marked) < len(repeated) + 40 or width_bits == 3


def test_one_passage_in_every_document(spark):
    """A passage of all documents sends one row each, and no group is collected."""
    passage = " ".join(f"p{i}" for i in range(40))
    table = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit(f"{passage} "), F.col("id").cast("string")).alias("text"),
    )
    found = passages.remove_repeated_passages(table)
    assert found.agg(F.sum("n_removed"), F.max("n_removed")).first() == (2999 * 40, 40)
    assert "Window" not in plan(found)
