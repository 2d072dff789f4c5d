"""Removal of passages that an earlier document, or the same one, already holds.

A count-min sketch of all windows of words leaves few windows to compare exactly. Its counters
are cut into slices, so no task holds, and nothing broadcasts, a sketch that grows with the
corpus: every chunk of documents sends each slice the counters it touches, a slice adds up what
it gets and tells each chunk which of its counters reached two.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.llm.common import settings, shuffle_partitions
from tarmac.sources import stage

WINDOW = 20
# Rows of counters of the sketch, and counters of a row in one slice.
ROWS, WIDTH_BITS = 2, 24
# Bytes of text for each slice: windows are fewer, so counters are mostly free.
SLICE_BYTES = 1 << 22
# Documents that share one partition sketch, and bytes of text hashed at once.
CHUNK_BITS, BATCH_BYTES = 10, 1 << 18
# Rows sent to a Python worker at once: a bound of its memory, as texts may be long.
BATCH_ROWS = 500

# Longer texts are hashed in segments.
SEGMENT_BYTES = 1 << 20

_U = np.uint64
_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b" " * 5)
_SEEDS = [_U(0x9E3779B97F4A7C15), _U(0x3C6EF372FE94F82A)]
_STEP = _U(0xD6E8FEB86659FD93)
_POWERS = np.cumprod(np.full(1 << 16, _SEEDS[0], _U), dtype=_U)


def normalised(text):
    """Words of a text (UTF-8 bytes) joined by one space."""
    text = text.translate(_SPACES)
    while b"  " in text:
        text = text.replace(b"  ", b" ")
    return text.strip(b" ")


def segments(text, size):
    """A normalised text as (number of the first word, part), each window in exactly one part."""
    at = word = 0
    while True:
        cut = text.find(b" ", at + SEGMENT_BYTES)
        if cut < 0:
            yield word, text[at:]
            return
        end = cut
        for _ in range(size - 1):
            end = text.find(b" ", end + 1)
            if end < 0:
                end = len(text)
                break
        yield word, text[at:end]
        word += text.count(b" ", at, cut) + 1
        at = cut + 1


def _mixed(x):
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Windows:
    """All windows of some normalised texts, none of them empty.

    ``starts``: where each word begins in ``data``; ``first``: number of the first word of each
    text and, last, of all; ``hashes``: one for each window that lies within a text, in order;
    ``at``: number of its first word. Hashes of different windows may be equal.
    """

    def __init__(self, texts, size=WINDOW):
        self.data = b" ".join(texts) + b" "
        letters = np.frombuffer(self.data, np.uint8)
        ends = np.flatnonzero(letters == 32) + 1
        self.starts = np.concatenate(([0], ends))
        counts = [text.count(b" ") + 1 for text in texts]
        self.first = np.concatenate(([0], np.cumsum(counts)))
        n = len(ends) - size + 1
        if n <= 0:
            self.at, self.hashes = np.empty(0, np.int64), np.empty(0, _U)
            return
        place = np.arange(len(letters)) - np.repeat(self.starts[:-1], np.diff(self.starts))
        words = np.add.reduceat(letters * _POWERS[place & 0xFFFF], self.starts[:-1])
        words = _mixed(words)
        hashes = np.zeros(n, _U)
        for i in range(size):
            hashes *= _STEP
            hashes += words[i : i + n]
        inside = np.ones(len(ends), bool)
        for end in self.first[1:]:
            inside[max(0, end - size + 1) : end] = False
        self.at = np.flatnonzero(inside[:n])
        self.hashes = hashes[self.at]


def cells(hashes, row, slices):
    """The counter of each window in a row of the sketch: number of the slice, then the place."""
    mixed = _mixed(hashes + _SEEDS[row])
    slice_no = ((mixed >> _U(32)) * _U(slices)) >> _U(32)
    return (slice_no << _U(WIDTH_BITS)) | (mixed & _U((1 << WIDTH_BITS) - 1))


def pack(sorted_numbers):
    """Rising 32-bit numbers as differences, bytes of equal rank together, which compress well."""
    steps = np.diff(sorted_numbers.astype("<u4"), prepend=np.uint32(0))
    return steps.view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(data):
    steps = np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint32)


def partition_sketch(hashes, slices):
    """Counters touched by a chunk: (row, slice, packed), each place with a bit for "often"."""
    for row in range(ROWS):
        found, counts = np.unique(cells(hashes, row, slices), return_counts=True)
        places = ((found & _U((1 << WIDTH_BITS) - 1)) << _U(1)) | (counts > 1).astype(_U)
        slice_no = found >> _U(WIDTH_BITS)
        cuts = np.flatnonzero(np.diff(slice_no)) + 1
        for own, part in zip(slice_no[np.concatenate(([0], cuts))], np.split(places, cuts)):
            yield row, int(own), pack(part)


def merge_sketches(sketches):
    """Per sketch the places whose counters, added over all sketches, reached two."""
    total = np.zeros(1 << WIDTH_BITS, np.uint8)
    for sketch in sketches:
        found = unpack(sketch)
        places = found >> 1
        total[places] = np.minimum(total[places] + 1 + (found & 1), 2)
    for sketch in sketches:
        places = unpack(sketch) >> 1
        yield places[total[places] > 1]


def _copy(batches):
    """Texts normalised and compressed, which every later step reads, with size and hash."""
    pack_text = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = [normalised(text.as_py() or b"") for text in batch["text"]]
        columns = [
            pa.array([len(text) + 1 for text in texts], pa.int64()),
            pa.array([xxhash.xxh3_64_intdigest(text) >> 1 for text in texts], pa.int64()),
            pa.array([pack_text(text) for text in texts], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(
            [batch["rid"], batch["key"], *columns], names=["rid", "key", "width", "tie", "text"]
        )


def _sketches(size, slices, chunk_bits):
    schema = pa.schema(
        [("chunk", pa.int64()), ("row", pa.int32()), ("slice", pa.int32()), ("cells", pa.binary())]
    )

    def rows_of(chunk, hashes):
        rows = partition_sketch(np.concatenate(hashes), slices)
        made = [(chunk, *row) for row in rows]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(zip(*made), schema)],
            schema=schema,
        )

    def sketch(batches):
        chunk, hashes, texts, held = None, [], [], 0
        text_of = zstandard.ZstdDecompressor().decompress

        def hashed():
            nonlocal texts, held
            if texts:
                found = Windows(texts, size).hashes
                if len(found):
                    hashes.append(found)
            texts, held = [], 0

        for batch in batches:
            for rid, text in zip(batch["rid"].to_pylist(), batch["text"]):
                if rid >> chunk_bits != chunk:
                    hashed()
                    if hashes:
                        yield rows_of(chunk, hashes)
                    chunk, hashes = rid >> chunk_bits, []
                for _, part in segments(text_of(text.as_py()), size):
                    if part.count(b" ") >= size - 1:
                        texts.append(part)
                        held += len(part)
                    if held >= BATCH_BYTES:
                        hashed()
        hashed()
        if hashes:
            yield rows_of(chunk, hashes)

    return sketch


def _merge(group):
    merged = list(merge_sketches(list(group["cells"])))
    group["cells"] = [pack(places) for places in merged]
    return group[[len(places) > 0 for places in merged]]


def _holds(found, codes):
    at = np.searchsorted(found, codes)
    at[at == len(found)] = 0
    return found[at] == codes


MARKED = (
    "rid long, place long, n_words long, kept_sha256 string, body binary, starts array<int>, "
    "h1 array<long>, h2 array<long>"
)


def _mark(size, slices):
    """Windows estimated repeated, with exact digests; texts without any are done."""
    schema = pa.schema(
        [
            ("rid", pa.int64()),
            ("place", pa.int64()),
            ("n_words", pa.int64()),
            ("kept_sha256", pa.string()),
            ("body", pa.binary()),
            ("starts", pa.list_(pa.int32())),
            ("h1", pa.list_(pa.int64())),
            ("h2", pa.list_(pa.int64())),
        ]
    )

    def repeated(windows, often):
        """Numbers of the windows whose counters all reached two."""
        left = np.arange(len(windows.hashes))
        for row in range(ROWS):
            if not len(left) or not len(often[row]):
                return left[:0]
            left = left[_holds(often[row], cells(windows.hashes[left], row, slices))]
        return left

    def marks_of(docs, often):
        """Per document, by its position, the starts and digests of its marked windows."""
        parts = [
            (i, word, part)
            for i, doc in enumerate(docs)
            for word, part in segments(doc[2], size)
            if part.count(b" ") >= size - 1
        ]
        marks = {}
        while parts:
            held = n = 0
            while n < len(parts) and held < BATCH_BYTES:
                held += len(parts[n][2])
                n += 1
            some, parts = parts[:n], parts[n:]
            windows = Windows([part for _, _, part in some], size)
            first = windows.at[repeated(windows, often)]
            data, starts = windows.data, windows.starts
            begins, ends = starts[first].tolist(), (starts[first + size] - 1).tolist()
            digests = b"".join([xxhash.xxh3_128_digest(data[a:b]) for a, b in zip(begins, ends)])
            digests = np.frombuffer(digests, ">i8").astype(np.int64).reshape(-1, 2)
            cuts = np.searchsorted(first, windows.first)
            for (i, word, _), a, b, begin in zip(some, cuts, cuts[1:], windows.first):
                if a < b:
                    marks.setdefault(i, []).append((first[a:b] - begin + word, digests[a:b]))
        return marks

    def finished(docs, often):
        """Result rows of documents given as (rid, place, text, compressed text)."""
        marks = marks_of(docs, often)
        none = np.empty(0, np.int64)
        rows = []
        for i, (rid, place, text, packed) in enumerate(docs):
            n_words = text.count(b" ") + 1 if text else 0
            if i in marks:
                starts, digests = map(np.concatenate, zip(*marks[i]))
                rows.append((rid, place, n_words, None, packed, starts, *digests.T))
            else:
                sha = hashlib.sha256(text).hexdigest()
                rows.append((rid, place, n_words, sha, None, none, none, none))
        columns = [pa.array(list(column), field.type) for column, field in zip(zip(*rows), schema)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def mark(batches):
        chunk, answers, often, places, docs, held = None, {}, None, {}, [], 0
        text_of = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            columns = [batch[name].to_pylist() for name in ("chunk", "kind", "id", "number")]
            for own, kind, number, other, data in zip(*columns, batch["data"]):
                if own != chunk:
                    if docs:
                        yield finished(docs, often)
                    chunk, answers, often, places, docs, held = own, {}, None, {}, [], 0
                if kind == 0:
                    found = unpack(data.as_py()).astype(_U) | _U(other << WIDTH_BITS)
                    answers.setdefault(number, []).append(found)
                elif kind == 1:
                    places[number] = other
                else:
                    if often is None:
                        often = [
                            np.unique(np.concatenate(answers.pop(row, [np.empty(0, _U)])))
                            for row in range(ROWS)
                        ]
                    packed = data.as_py()
                    text = text_of(packed)
                    docs.append((number, places.pop(number), text, packed))
                    held += len(text) + 64
                    if held >= BATCH_BYTES:
                        yield finished(docs, often)
                        docs, held = [], 0
        if docs:
            yield finished(docs, often)

    return mark


def _remove(size):
    """What is left of texts, given the windows that occur earlier."""
    schema = pa.schema(
        [
            ("n_words", pa.int64()),
            ("n_removed", pa.int64()),
            ("kept", pa.string()),
            ("kept_sha256", pa.string()),
        ]
    )

    def remove(batches):
        text_of = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            rows = []
            for n_words, place, body, starts, firsts in zip(
                *(batch[c] for c in ("n_words", "place", "body", "starts", "firsts"))
            ):
                n_words, body = n_words.as_py(), text_of(body.as_py())
                gone = starts.values.to_numpy()
                if firsts.is_valid:
                    first = firsts.values.to_numpy() - place.as_py()
                    gone = gone[~np.isin(gone, first)]
                edges = np.zeros(n_words + 1, np.int64)
                edges[gone] += 1
                edges[gone + size] -= 1
                covered = np.cumsum(edges)[:-1] > 0
                letters = np.frombuffer(body + b" ", np.uint8)
                ends = np.flatnonzero(letters == 32) + 1
                left = np.repeat(~covered, np.diff(ends, prepend=0))
                body = letters[left].tobytes()[:-1]
                sha = hashlib.sha256(body).hexdigest()
                rows.append((n_words, int(covered.sum()), body.decode(), sha))
            if rows:
                columns = [pa.array(column, f.type) for column, f in zip(zip(*rows), schema)]
                yield pa.RecordBatch.from_arrays(
                    [batch["key"], *columns], names=["key", *schema.names]
                )

    return remove


def _places(copy):
    """(rid, key, place): documents in order, with a number below which all earlier words lie.

    Ranges of the order are summed each on its own; the sums of ranges are one row a range.
    """
    order = ["key", "tie", "rid"]
    rows = copy.select("rid", "key", "tie", "width")
    rows = stage.keep(
        rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "order"
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("width").alias("sum"))
    parts = parts.select("part", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("base"))
    inside = (
        Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("width").over(inside), F.lit(0))
    placed = rows.select("rid", "key", "part", before.alias("before"))
    return placed.join(F.broadcast(parts), "part").select(
        "rid", "key", (F.col("base") + F.col("before")).alias("place")
    )


def remove_repeated_passages(docs, key="doc_id", text="text", size=WINDOW, chunk_bits=CHUNK_BITS):
    """Key, ``n_words``, ``n_removed``, ``kept`` and ``kept_sha256`` of every row.

    Removed is each word covered by a window of ``size`` words that also starts earlier: in a
    row of smaller key or, in the same row, further ahead. Null keys come first; rows of equal
    keys follow one another by a hash of their texts, equal rows in any order, so all but one of
    them lose every word that a window covers. A null, empty or blank text has no words; a text
    shorter than a window keeps all. ``kept`` is null where nothing was removed: the words are
    then those of the text. An empty table gives an empty one; other columns play no part.

    The sketch overestimates, so no repeated window is lost; the windows it leaves are grouped
    by the 128-bit XXH3 of their words. Of a group only its first window is sent back, so a
    passage that fills a third of the table costs its documents one row each and no task more.
    """
    spark = docs.sparkSession
    path = stage.new_stage_path(spark, "passages")
    clean_up = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    with stage.job(spark), settings(spark, **{clean_up: "true", batch: str(BATCH_ROWS)}):
        kind = docs.schema[key].dataType.simpleString()
        copied = stage.new_stage_path(spark, "copy")
        rows = docs.select(
            F.monotonically_increasing_id().alias("rid"),
            F.col(key).alias("key"),
            F.col(text).cast("binary").alias("text"),
        )
        copy = stage.keep(
            rows.mapInArrow(_copy, f"rid long, key {kind}, width long, tie long, text binary"),
            "copy",
            "none",
            copied,
        )
        total = copy.agg(F.sum("width")).first()[0] or 0
        slices = max(shuffle_partitions(spark), -(-total // SLICE_BYTES))
        places = stage.keep(_places(copy), "places")
        chunk = F.shiftright("rid", chunk_bits)

        sketches = copy.select("rid", "text").mapInArrow(
            _sketches(size, slices, chunk_bits),
            "chunk long, row int, slice int, cells binary",
        )
        often = stage.keep(
            sketches.groupBy("row", "slice").applyInPandas(_merge, sketches.schema), "often"
        )

        no = F.lit(None)
        sides = [
            often.select(
                "chunk",
                F.lit(0).alias("kind"),
                F.col("row").cast("long").alias("id"),
                F.col("slice").cast("long").alias("number"),
                F.col("cells").alias("data"),
            ),
            places.select(
                chunk.alias("chunk"), F.lit(1), "rid", "place", no.cast("binary").alias("data")
            ),
            copy.select(chunk.alias("chunk"), F.lit(2), "rid", no.cast("long"), "text"),
        ]
        dealt = sides[0].union(sides[1]).union(sides[2]).repartition("chunk")
        marked = stage.keep(
            dealt.sortWithinPartitions("chunk", "kind", "id", "number").mapInArrow(
                _mark(size, slices), MARKED
            ),
            "marked",
            "zstd",
        )
        stage.delete(spark, copied)

        windows = marked.where("body IS NOT NULL").select(
            "rid", "place", F.inline(F.arrays_zip("h1", "h2", "starts"))
        )
        at = F.col("place") + F.col("starts")
        firsts = (
            windows.select("h1", "h2", "rid", at.alias("at"))
            .groupBy("h1", "h2")
            .agg(F.min("at").alias("at"), F.min_by("rid", "at").alias("rid"))
            .groupBy("rid")
            .agg(F.collect_list("at").alias("firsts"))
        )
        firsts = stage.keep(firsts, "firsts", "zstd")
        keys = places.select("rid", "key")
        cut = (
            marked.where("body IS NOT NULL")
            .select("rid", "n_words", "place", "body", "starts")
            .join(firsts, "rid", "left")
            .join(keys, "rid")
            .mapInArrow(
                _remove(size),
                f"key {kind}, n_words long, n_removed long, kept string, kept_sha256 string",
            )
        )
        whole = (
            marked.where("body IS NULL")
            .join(keys, "rid")
            .select("key", "n_words", F.lit(0).cast("long"), no.cast("string"), "kept_sha256")
        )
        cut.union(whole).withColumnRenamed("key", key).write.parquet(path)
    return spark.read.parquet(path)
