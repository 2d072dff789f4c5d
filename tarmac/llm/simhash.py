"""Near-duplicates by SimHash: fingerprints, tiled exact comparison, components.

Equal fingerprints become one row first. Distinct ones are sorted by the population counts of
their four 16-bit quarters and cut into tiles. Two fingerprints whose counts differ by more
than the radius in sum over the quarters cannot be near, so a tile pair whose count boxes
are farther apart is skipped, between tiles and again between the small tiles inside them. What is
left is compared exactly by exclusive-or and bit counts. A task returns a
spanning forest of the links it finds, never the pairs, so a group of copies of any size costs
one edge for each member.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import ascii_lower, shuffle_partitions
from tarmac.llm.components import component_roots
from tarmac.sources import stage

RADIUS = 4
SHINGLE = 4
SEED = 42
# Fingerprints in a tile at most, and tiles made in any case while there are enough.
TILE_ROWS = 1 << 20
TILES = 24
SMALL = 512
_CHUNK = 1 << 16
_LANES = np.uint64(0x0101010101010101)


# Fingerprints


def bit_counts(hashes):
    """How many of the hashes have each of the 64 bits set."""
    counts = np.zeros(64, dtype=np.int64)
    rows = -(-len(hashes) // 255)
    padded = np.zeros(rows * 255, dtype=np.uint64)
    padded[: len(hashes)] = hashes
    padded = padded.reshape(rows, 255)
    for shift in range(8):
        lanes = ((padded >> np.uint64(shift)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts[shift::8] = lanes.astype("<u8").view(np.uint8).reshape(rows, 8).sum(axis=0)
    return counts


def fingerprint(text, size=SHINGLE):
    """Signed 64-bit SimHash of the word shingles of a text, repeats included.

    A bit is set if over half the shingle hashes have it. A text of fewer words is one
    shingle; without words, or null, the fingerprint is zero.
    """
    words = ascii_lower(text).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= size:
        return int(np.uint64(xxhash.xxh64_intdigest(joined, SEED)).astype(np.int64))
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - size + 1].tolist()
    ends = ends[size - 1 :].tolist()
    digest, total = xxhash.xxh64_intdigest, len(starts)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, total, _CHUNK):
        pairs = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])
        counts += bit_counts(np.array([digest(joined[s:e], SEED) for s, e in pairs], np.uint64))
    bits = np.packbits((2 * counts > total).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_column(text, size=SHINGLE):
    @F.pandas_udf(T.LongType())
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(text, size) for text in texts], dtype="int64")

    return prints(text)


# Tiles


def quarter_counts(prints):
    """Population counts of the four 16-bit quarters, one column for each."""
    prints = prints.view(np.uint64)
    return np.stack(
        [np.bitwise_count((prints >> np.uint64(s)) & np.uint64(0xFFFF)) for s in (48, 32, 16, 0)],
        axis=1,
    ).astype(np.int16)


def _quarter_columns(name):
    return [
        F.bit_count(F.shiftrightunsigned(F.col(name), s).bitwiseAND(F.lit(0xFFFF)))
        for s in (48, 32, 16, 0)
    ]


def _pack(batches):
    """One row for each partition: its fingerprints in order and their count box."""
    parts = [batch["fp"].to_numpy(dtype=np.int64) for batch in batches]
    prints = np.concatenate(parts) if parts else np.empty(0, np.int64)
    if len(prints):
        counts = quarter_counts(prints)
        prints = prints[np.lexsort(counts.T[::-1])]
        yield pd.DataFrame(
            {
                "tile": [TaskContext.get().partitionId()],
                "low": [counts.min(axis=0).tolist()],
                "high": [counts.max(axis=0).tolist()],
                "prints": [prints.tobytes()],
            }
        )


def box_gap(low, high, other_low, other_high):
    """Least sum of count differences between any members of two boxes."""
    apart = np.maximum(low[:, None] - other_high[None], other_low[None] - high[:, None])
    return np.maximum(apart, 0).sum(axis=2)


def _boxes(prints):
    starts = np.arange(0, len(prints), SMALL)
    counts = quarter_counts(prints)
    return np.minimum.reduceat(counts, starts), np.maximum.reduceat(counts, starts)


class Forest:
    """Union-find over the distinct fingerprints of two tiles."""

    def __init__(self):
        self.parent = {}

    def root(self, a):
        parent = self.parent
        top = a
        while (up := parent.get(top, top)) != top:
            top = up
        while a != top:
            parent[a], a = top, parent.get(a, a)
        return top

    def link(self, a, b):
        """Join two trees; whether they were two."""
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        self.parent.setdefault(min(a, b), min(a, b))
        return True

    def edges(self):
        return [(a, self.root(a)) for a in self.parent if self.root(a) != a]


def _dense_links(near, left, right):
    """Star links of the components of a dense block, by spreading the smallest label."""
    rows, columns = np.where(near.any(axis=1), left, _TOP), np.where(near.any(axis=0), right, _TOP)
    while True:
        new_rows = np.minimum(rows, np.where(near, columns[None], _TOP).min(axis=1))
        new_columns = np.minimum(columns, np.where(near, new_rows[:, None], _TOP).min(axis=0))
        if (new_rows == rows).all() and (new_columns == columns).all():
            break
        rows, columns = new_rows, new_columns
    on, under = near.any(axis=1), near.any(axis=0)
    yield from zip(left[on].tolist(), rows[on].tolist())
    yield from zip(right[under].tolist(), columns[under].tolist())


_TOP = np.iinfo(np.int64).max


def near_links(left, right, radius=RADIUS):
    """A spanning forest of the links between two arrays of fingerprints."""
    forest = Forest()
    left_boxes, right_boxes = _boxes(left), _boxes(right)
    for i, j in np.argwhere(box_gap(*left_boxes, *right_boxes) <= radius).tolist():
        a, b = left[i * SMALL : (i + 1) * SMALL], right[j * SMALL : (j + 1) * SMALL]
        near = np.bitwise_count((a[:, None] ^ b[None]).view(np.uint64)) <= radius
        links = np.argwhere(near)
        if len(links) <= 4 * SMALL:
            pairs = zip(a[links[:, 0]].tolist(), b[links[:, 1]].tolist())
        else:
            pairs = _dense_links(near, a, b)
        for x, y in pairs:
            if x != y:
                forest.link(x, y)
    return forest.edges()


def _compare(radius):
    def compare(batches):
        for batch in batches:
            for left, right in zip(batch["left"], batch["right"]):
                edges = near_links(np.frombuffer(left, np.int64), np.frombuffer(right, np.int64), radius)
                if edges:
                    yield pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return compare


def near_edges(prints, radius=RADIUS):
    """Edges (a, b) whose components are those of all links within the radius.

    ``prints`` has one column ``fp`` of distinct fingerprints. The number of tiles stays at
    ``TILES`` until they would exceed ``TILE_ROWS``: then every tile goes to as many tile
    pairs as before and the shuffle grows as the input. The comparison itself grows with the
    square of the distinct fingerprints, divided by what the boxes skip.
    """
    spark = prints.sparkSession
    total = prints.count()
    tiles = max(1, min(TILES, total // SMALL), -(-total // TILE_ROWS))
    packed = stage.keep(
        prints.repartitionByRange(tiles, *_quarter_columns("fp"), "fp").mapInPandas(
            _pack, "tile int, low array<int>, high array<int>, prints binary"
        ),
        "tiles",
    )
    boxes = packed.select("tile", "low", "high")
    last = boxes.agg(F.max("tile")).first()[0]
    if last is None:
        return spark.createDataFrame([], "a long, b long")
    gap = F.lit(0)
    for q in range(4):
        apart = F.greatest(F.col("low")[q] - F.col("high2")[q], F.col("low2")[q] - F.col("high")[q])
        gap = gap + F.greatest(apart, F.lit(0))
    pairs = (
        boxes.withColumn("tile2", F.explode(F.sequence("tile", F.lit(last))))
        .join(boxes.toDF("tile2", "low2", "high2"), "tile2")
        .where(gap <= radius)
        .select("tile", "tile2")
    )
    left = packed.select("tile", F.col("prints").alias("left"))
    right = packed.select(F.col("tile").alias("tile2"), F.col("prints").alias("right"))
    work = pairs.join(left, "tile").join(right, "tile2")
    work = work.repartition(max(shuffle_partitions(spark), tiles), "tile", "tile2")
    return work.mapInPandas(_compare(radius), "a long, b long")


# Operators


def near_duplicates(docs, key="doc_id", text="text", radius=RADIUS, size=SHINGLE):
    """Key, ``fp`` (signed fingerprint) and ``component_id`` of every row.

    Rows whose fingerprints differ in at most ``radius`` bits are linked; ``component_id``
    is the smallest key reachable, the row's own included. Rows without words have
    fingerprint zero and are linked like any other. Null keys are passed over in the
    minimum; a component of null keys only has a null id. Repeated rows stay. Other columns
    are left out. An empty table gives an empty result.
    """
    rows = stage.keep(
        docs.select(F.col(key).alias("key"), fingerprint_column(F.col(text), size).alias("fp")),
        "fingerprints",
    )
    prints = stage.keep(rows.groupBy("fp").agg(F.min("key").alias("least")), "distinct-prints")
    roots = component_roots(near_edges(prints.select("fp"), radius))
    rooted = prints.join(roots.toDF("fp", "root"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    components = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(components, "root").select("fp", "component_id")
    return rows.join(named, "fp").select(F.col("key").alias(key), "fp", "component_id")


def fingerprint_text(fp):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
