"""Odd rows, compared by all their values, and inputs that once failed or never ended."""

import base64
import glob
import gzip
import hashlib
import json
import math
import random
import re
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as registry
import corpus_pipeline
from tarmac.llm import (
    bpe,
    contamination,
    language,
    neighbours,
    quality,
    secrets,
    token_files,
)
from tests.conftest import DATA
from tools.compare import compare, connect

ROWS = [
    (1, None, None, None, None),
    (None, "some words here", "en", "s", 15),
    (2, "", "en", "s", 0),
    (3, " \n\t ", None, "s", 4),
    (4, "word " * 30_000, "en", None, 150_000),
    (5, "same text twice", "en", "s", 15),
    (6, "same text twice", "en", "s", 15),
    (6, "same text twice", "en", "s", 15),
    (7, "password = hunter2hunter2 " + "q" * 40, "de", "s", 66),
    (8, "Ⅷ ² ½ 12 !", "en", "s", 10),
]
NAMES = ("found", "ids", "n_tokens", "decoded_sha256", "done", "clean", "score", "key", "FOUND_")


@pytest.fixture(scope="module")
def odd(spark):
    table = spark.createDataFrame(
        ROWS, "doc_id long, text string, lang string, source string, n_chars int"
    )
    return table.withColumns({name: F.lit("own") for name in NAMES})


def by_key(table, *columns):
    """Sorted rows of the key and some columns; nulls come first."""
    found = [tuple(r[c] for c in ("doc_id", *columns)) for r in table.collect()]
    return sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, repr(r[1:])))


def expected(make):
    found = [(row[0], *make(row[1] or "")) for row in ROWS]
    return sorted(found, key=lambda r: (r[0] is not None, r[0] or 0, repr(r[1:])))


def test_contamination(spark, odd):
    bench = spark.createDataFrame(
        [("b", "same TEXT twice"), (None, "word"), ("a", "text"), ("a", "text"), ("c", None)],
        "item_id string, text string",
    )

    def make(text):
        words = contamination.words_of(text)
        if text == "same text twice":
            return 3, 3, ["a", "b"], True
        return len(words), 0, [], False

    found = contamination.contamination_report(odd, bench)
    assert by_key(found, "n_words", "n_hit", "items", "contaminated") == expected(make)
    none = contamination.contamination_report(odd, bench.limit(0))
    assert by_key(none, "n_hit") == expected(lambda _: (0,))
    assert contamination.contamination_report(odd.limit(0), bench).collect() == []


def test_contamination_equals_its_sql(spark):
    name = "op3_wu_manber"
    assert compare(connect(DATA), registry.queries()[name](spark, DATA), name) is None


def test_languages(spark, odd):
    pieces = language.sentence_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    rows = by_key(language.identify_languages(odd, pieces), "lang_pred", "score")
    assert len(rows) == len(ROWS)
    letters = sorted(
        [(r[0], bool(re.search("[a-z]", r[1] or ""))) for r in ROWS],
        key=lambda r: (r[0] is not None, r[0] or 0),
    )
    for (key, found, score), (other, has_letters) in zip(rows, letters):
        assert key == other and 0 <= score <= 1
        assert (found != "und") == has_letters
    assert language.identify_languages(odd.limit(0), pieces).collect() == []


def test_bpe(odd):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding(
        "x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )

    def make(text):
        ids = np.array(library.encode_ordinary(text), "<u4").tobytes()
        return bytearray(ids), bytearray(text.encode())

    found = bpe.round_trip(odd, ranks, public_tokenizers.PATTERN)
    plain = [tuple(bytes(x) if isinstance(x, (bytes, bytearray)) else
                   x.encode() if isinstance(x, str) else x for x in r)
             for r in by_key(found, "ids", "decoded")]
    assert sorted(plain, key=repr) == sorted(
        [(r[0], bytes(r[1]), bytes(r[2])) for r in expected(make)], key=repr
    )


def test_secrets(odd):
    def make(text):
        base = secrets.scan(text)
        counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
        return *counts, ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base), False

    found = secrets.secret_report(odd)
    columns = ("n_assign", "n_access", "n_hex", "base", "incomplete")
    assert by_key(found, *columns) == expected(make)
    assert any(r[1] for r in by_key(found, *columns))
    assert secrets.secret_report(odd.limit(0)).collect() == []


def test_base_spans_against_brute_force():
    """Base spans by the contract's patterns alone, on texts full of near misses."""
    rng = random.Random(7)
    parts = ["password", "Secret", "api_key", "APIKEY", "token", "AKIA", "0a", "f" * 31, "ABCD1234"]
    parts += ['"', "'", ":", "=", " ", "é", "\n", "x", "+/", "deadbeef" * 4, "_"]
    assign = re.compile(
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(14)))
        slow = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[1]) >= 8 and m[0].isascii()]
        slow += [
            (m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16
        ]
        slow += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        assert secrets.scan(text) == sorted(slow)


@pytest.mark.parametrize(
    "text",
    ["%" + "25" * 50_000, "\\" + "u005c" * 20_000, "%5Cx25" * 20_000, "%" + "25" * 40_000 + "41"],
    ids=["percent", "unicode", "mixed", "ending"],
)
def test_nested_escapes_take_linear_time(text):
    began = time.time()
    secrets.find_secrets(text)
    assert time.time() - began < 10


def test_escape_chains_and_escaped_compressed_data():
    secret = b"password = hunter2hunter2"
    packed = gzip.compress(secret)
    encoded = [
        "".join(f"%25{b:02x}" for b in secret),
        "".join(f"%252525{b:02x}" for b in secret),
        "".join(f"\\x5cx{b:02x}" for b in secret),
        "".join(f"%5Cu{b:04x}" for b in secret),
        "".join(f"%{b:02X}" for b in packed),
        "".join(f"%25{b:02X}" for b in packed),
        "".join(f"\\x{b:02x}" for b in packed),
        base64.b64encode(packed).decode(),
    ]
    for run in encoded:
        text = f"see {run} end"
        assert (4, 0, 4 + len(run)) in secrets.find_secrets(text)[1], run[:20]
    lone = "100%25 of it, %zz, 5%25, \\u005c and \\"
    assert secrets.find_secrets(lone)[1] == []


def test_quality(spark, odd):
    labels = spark.createDataFrame(
        [(2, None), (5, 1), (None, 0), (5, 1)], "doc_id long, quality int"
    )
    rows = quality.quality_report(odd, labels).collect()
    assert len(rows) == len(ROWS)
    for row in rows:
        if row["doc_id"] in (1, 2, 3):
            assert row["accepted"] is False
    kept = quality.drop_low_quality(odd, labels)
    assert kept.columns == odd.columns
    accepted = sorted(str(r["doc_id"]) for r in rows if r["accepted"])
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == accepted
    for some in (odd.limit(0), odd):
        assert quality.quality_report(some, labels.limit(0)).count() == some.count()


def test_pipeline_stages(spark, odd):
    """Each stage on odd rows with clashing names: its columns, and which rows go."""
    for name, step in corpus_pipeline.STAGES:
        found = step(spark, odd, DATA)
        keys = [r["doc_id"] for r in found.collect()]
        assert step(spark, odd.limit(0), DATA).collect() == []
        if name.startswith("byte-level"):
            assert len(found.columns) == len(odd.columns) and len(keys) == len(ROWS)
            for row in found.collect():
                digest = hashlib.sha256((row["text"] or "").encode()).hexdigest()
                assert row["decoded_sha256"] == digest and len(row["ids"]) == 4 * row["n_tokens"]
        else:
            assert found.columns == odd.columns
        if name.startswith("secret"):
            texts = {r["doc_id"]: r["text"] for r in found.collect()}
            assert texts[7].startswith("[assign] ") and texts[1] is None and len(keys) == len(ROWS)
        if name.startswith("SimHash"):
            assert 5 in keys and 6 not in keys and None in keys


def test_pipeline_of_empty_tables(spark, tmp_path):
    for name in ("documents", "benchmark", "labels"):
        table = spark.read.parquet(f"{DATA}/{name}.parquet")
        table.limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_neighbours_of_extreme_magnitudes(spark):
    rng = np.random.default_rng(3)
    for scale in (1e-200, 1e150):
        data = rng.normal(size=(60, 4)) * scale
        rows = [(i, v.tolist()) for i, v in enumerate(data)]
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        found = neighbours.nearest_neighbours(table, lambda key: key % 20 == 0).collect()
        assert len(found) == 3 * 20
        for row in found:
            assert row["score"] == pytest.approx(
                math.fsum(data[row["query_id"]] * data[row["vec_id"]]), rel=1e-9
            )


def test_damaged_file_fails(spark, tmp_path):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        source = file.read()
    docs = spark.createDataFrame(
        [(i, f"some words of document {i}") for i in range(200)], "doc_id long, text string"
    )
    path = str(tmp_path / "files")
    token_files.write_token_files(docs, path, source)
    assert token_files.read_token_files(spark, path).count() == 200
    part = glob.glob(f"{path}/part-*.parquet")[0]
    table = pq.read_table(part)
    coded = [bytearray(x) for x in table["coded"].to_pylist()]
    # The last bytes of a lane need not matter; so many in the middle do.
    for at in range(len(coded[0]) // 2, len(coded[0]) // 2 + 40):
        coded[0][at] ^= 255
    at = table.schema.get_field_index("coded")
    broken = table.set_column(at, table.schema.field(at), [[bytes(x) for x in coded]])
    pq.write_table(broken, str(tmp_path / "broken.parquet"))
    with pytest.raises(Exception, match="damaged"):
        token_files.read_token_files(spark, str(tmp_path / "broken.parquet")).collect()


def test_too_many_different_ids_in_a_block():
    ids = np.arange(1 << 16)
    assert token_files.decode_block(token_files.encode_block(ids)).tolist() == ids.tolist()
    with pytest.raises(ValueError, match="65537 different ids"):
        token_files.encode_block(np.arange((1 << 16) + 1))


def _same_as_the_library(tokens, exact, texts, kind=pa.string()):
    ids, sizes = tokens(pa.array(texts, kind))
    at = 0
    for text, size in zip(texts, sizes.tolist()):
        assert ids[at : at + size].tolist() == exact.encode(text or "", add_special_tokens=False).ids
        at += size
    assert at == len(ids)


def test_words_are_cut_as_the_tokenizer_does():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        source = file.read()
    tokens, exact = token_files.WordTokens(source), Tokenizer.from_str(source)
    _same_as_the_library(tokens, exact, [None, "", "  \n", " a  b\x0b", "a\xa0b \xa0 c"])
    # Every plain character and those around them, in letters, behind quotes, digits and signs.
    signs = [chr(n) for n in range(0x400)]
    texts = [f"a{c}b Q{c} {c}s'S {c}{c} 9{c}9!{c}! don{c}T x'{c} 'LL{c}" for c in signs]
    _same_as_the_library(tokens, exact, texts)
    _same_as_the_library(tokens, exact, texts[::7], pa.large_string())
    draw = random.Random(8)
    marks = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|StartOfText|>", "<|", "|>", "'ve", "'S"]
    parts = [*marks, *"aZ9 .,\n\t\x1f\xa0ßŸİžΩς中́😀\xad²"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(40))) for _ in range(2000)]
    _same_as_the_library(tokens, exact, texts)
    changed = json.loads(source)
    changed["normalizer"]["normalizers"].pop()
    changed = json.dumps(changed)
    _same_as_the_library(
        token_files.WordTokens(changed), Tokenizer.from_str(changed), texts[:200]
    )


def test_a_piece_is_encoded_once(monkeypatch):
    """Words that differ by case and signs only were each encoded by the whole tokenizer."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        source = file.read()
    tokens, exact = token_files.WordTokens(source), Tokenizer.from_str(source)
    forms = ["{}", "{}.", "({})", "{}***", "'{}'", "{}-{}"]
    words = [w for n in ("alpha", "öl", "zyzzyva") for w in (n, n.title(), n.upper())]
    texts = [" ".join(form.format(word, word) for word in words) for form in forms]
    _same_as_the_library(tokens, exact, texts)
    assert sorted(tokens.known) == sorted(
        ["", "alpha", "öl", "zyzzyva", ".", "(", ")", "***", "'", "-"]
    )
    monkeypatch.setattr(token_files, "_KNOWN", 4)
    _same_as_the_library(tokens, exact, texts)


def test_coder_with_ranges_of_all_sizes():
    rng = np.random.default_rng(8)
    every = np.arange(1 << 16)
    rare = np.where(rng.random(100_000) < 0.9999, 7, rng.integers(0, 49_000, 100_000))
    for ids in (np.concatenate([every, rng.integers(0, 1 << 16, 50_000)]), rare, every[:1]):
        assert token_files.decode_block(token_files.encode_block(ids)).tolist() == ids.tolist()
    # A range that lies across two words is cut to the lower one, and a wide one stays.
    low = np.array([(5 << 32) - 3, 5 << 32, 9], dtype=np.uint64)
    width = np.array([1 << 20, 1 << 20, 1 << 40], dtype=np.uint64)
    go, words = token_files._shift(low, width)
    assert go.tolist() == [0, 1] and words.tolist() == [4, 5]
    assert width.tolist() == [3 << 32, 1 << 52, 1 << 40]


def test_blocks_end_with_the_document_that_fills_them(monkeypatch):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        source = file.read()
    monkeypatch.setattr(token_files, "BLOCK_IDS", 10)
    monkeypatch.setattr(token_files, "_TEXT_BYTES", 8)
    counts = [0, 9, 1, 0, 30, 0, 3, 3, 3, 25, 2]
    batch = pa.RecordBatch.from_pydict(
        {
            "key": pa.array([None, *range(1, len(counts))], pa.int64()),
            "text": pa.array([" ".join(["a"] * n) if n else None for n in counts]),
        }
    )

    class Shared:
        value = source

    class Context:
        def get():
            return Context

        def partitionId():
            return 3

    monkeypatch.setattr(token_files, "TaskContext", Context)
    blocks = pa.Table.from_batches(token_files._write_blocks(Shared, 1)([batch, batch]))
    lengths = blocks["lengths"].to_pylist()
    assert sum(blocks["keys"].to_pylist(), []) == 2 * [None, *range(1, len(counts))]
    assert sum(lengths, []) == 2 * [n + 1 for n in counts]
    assert blocks["block"].to_pylist() == list(range(len(lengths)))
    for one, n in zip(lengths, blocks["n_ids"].to_pylist()):
        assert sum(one) == n and sum(one[:-1]) < 10
    assert all(n >= 10 for n in blocks["n_ids"].to_pylist()[:-1])
