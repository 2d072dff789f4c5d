"""Near-duplicates by shingle similarity: SimHash tiles find them, sketches and shingles decide.

A 64-bit SimHash alone cannot tell a similarity of 0.8 from one of 0.7: texts at 0.8 are
about ten bits apart, give or take three. So the tiled comparison takes a wide radius, and
what it finds is checked twice. Fingerprints here are of the different shingles, as the similarity
is. Rows are merged first only if their sets of shingles are equal, by a 64-bit hash of the set. Each
distinct set carries its fingerprint and a sketch of 256 min-hashes of four bits, again compared by exclusive-or and bit counts. Far above the
similarity asked for (four standard errors of the sketch) it decides alone, as far below; between,
the sets of shingles themselves decide, of every pair and not only of a tree of them.

Tiles are cut by the number of different shingles: texts whose numbers differ by more than the
similarity allows are in tile pairs that are skipped, as are those whose population counts differ
beyond the radius. A task returns spanning trees, most similar links first, never the pairs of
a group.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import functions as F

from tarmac.llm.common import ascii_lower, free_name, shuffle_partitions
from tarmac.llm.components import component_roots
from tarmac.llm.simhash import SEED, SMALL, Forest, bit_counts, box_gap, quarter_counts
from tarmac.sources import stage

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 18
HASHES = 256
# Four standard errors of the sketch at a similarity of 0.8.
MARGIN = 0.1
TILES = 24
TILE_ROWS = 1 << 17
# Members of a component of possible links that are compared by their sets at a time.
PART = 256
_MULTIPLIERS = np.random.default_rng(42).integers(0, 1 << 31, HASHES).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_NIBBLES = np.uint64(0x1111111111111111)


def shingle_hashes(text, size=SHINGLE):
    """Hashes of the different shingles; a text of fewer words is one, without words none."""
    words = ascii_lower(text).split()
    if not words:
        return np.empty(0, np.uint64)
    found = {b" ".join(words[at : at + size]) for at in range(max(1, len(words) - size + 1))}
    hashes = (xxhash.xxh64_intdigest(shingle, SEED) for shingle in found)
    return np.unique(np.fromiter(hashes, np.uint64, len(found)))


def set_hash(hashes):
    """Signed 64-bit hash of a set of shingle hashes, given in order."""
    return int(np.uint64(xxhash.xxh64_intdigest(hashes.tobytes(), SEED)).astype(np.int64))


def set_fingerprint(hashes):
    """Signed 64-bit SimHash of a set of shingle hashes; without any, zero."""
    bits = np.packbits((2 * bit_counts(hashes) > len(hashes)).astype(np.uint8), bitorder="little")
    return int(bits.view("<i8")[0])


def sketch(hashes):
    """Four bits of each of 256 min-hashes, two in a byte."""
    least = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 256):
        least = np.minimum(least, (short[at : at + 256, None] * _MULTIPLIERS).min(axis=0))
    low = (least & 15).astype(np.uint8).reshape(-1, 2)
    return (low[:, 0] | low[:, 1] << 4).tobytes()


def estimates(left, right):
    """Similarities of paired sketches, given as rows of 16 unsigned 64-bit integers."""
    apart = left ^ right
    apart = (apart | apart >> np.uint64(2)) & np.uint64(0x3333333333333333)
    apart = (apart | apart >> np.uint64(1)) & _NIBBLES
    equal = 1 - np.bitwise_count(apart).sum(axis=1, dtype=np.int64) / HASHES
    return (16 * equal - 1) / 15


def _prints(size):
    def prints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                hashes = shingle_hashes(text, size)
                rows.append((set_hash(hashes), set_fingerprint(hashes), len(hashes), sketch(hashes)))
            made = pd.DataFrame(rows, columns=["id", "fp", "shingles", "sketch"])
            made.insert(0, "key", batch["key"].to_numpy())
            yield made

    return prints


# Tiles


def _measures(prints, shingles):
    return np.column_stack([quarter_counts(prints), shingles])


def _pack(batches):
    """One row for each partition: its sets' hashes, fingerprints and sketches, and the box of their measures."""
    batches = list(batches)
    if not batches or not sum(map(len, batches)):
        return
    rows = pd.concat(batches)
    prints, shingles = rows["fp"].to_numpy(np.int64), rows["shingles"].to_numpy(np.int32)
    measures = _measures(prints, shingles)
    order = np.lexsort(measures.T)
    yield pd.DataFrame(
        {
            "tile": [TaskContext.get().partitionId()],
            "low": [measures.min(axis=0).tolist()],
            "high": [measures.max(axis=0).tolist()],
            "ids": [rows["id"].to_numpy(np.int64)[order].tobytes()],
            "prints": [prints[order].tobytes()],
            "shingles": [shingles[order].tobytes()],
            "sketches": [b"".join(rows["sketch"].iloc[order])],
        }
    )


def _possible(low, high, other_low, other_high, radius, similarity):
    """Which pairs of boxes can hold similar texts."""
    near = box_gap(low[:, :4], high[:, :4], other_low[:, :4], other_high[:, :4]) <= radius
    fewer = high[:, None, 4] < similarity * other_low[None, :, 4]
    more = similarity * low[:, None, 4] > other_high[None, :, 4]
    return near & ~fewer & ~more


def _unpack(ids, prints, shingles, sketches):
    ids, prints = np.frombuffer(ids, np.int64), np.frombuffer(prints, np.int64)
    measures = _measures(prints, np.frombuffer(shingles, np.int32))
    starts = np.arange(0, len(prints), SMALL)
    boxes = np.minimum.reduceat(measures, starts), np.maximum.reduceat(measures, starts)
    return ids, prints, np.frombuffer(sketches, np.uint64).reshape(len(prints), -1), boxes


def _tree_links(forest, a, b, x, y, weight):
    """Links between a[x] and b[y] that join trees of the forest, those of most weight first."""
    order = np.argsort(-weight, kind="stable")
    x, y = x[order], y[order]
    made = []
    while len(x):
        left, right = _roots(forest, a)[x], _roots(forest, b)[y]
        x, y, left, right = (v[left != right] for v in (x, y, left, right))
        if not len(x):
            break
        _, first = np.unique(np.concatenate([left, right]), return_index=True)
        for at in np.unique(first % len(x)).tolist():
            pair = int(a[x[at]]), int(b[y[at]])
            if forest.link(*pair):
                made.append(pair)
    return made


def _roots(forest, ids):
    return np.array([forest.root(i) for i in ids.tolist()], np.int64)


def similar_links(left, right, radius=RADIUS, similarity=SIMILARITY, margin=MARGIN):
    """(a, b, sure) for two unpacked tiles: trees of links that are sure, and of those to check."""
    left_ids, left, left_sketches, left_boxes = left
    right_ids, right, right_sketches, right_boxes = right
    sure, likely, made = Forest(), Forest(), []
    possible = _possible(*left_boxes, *right_boxes, radius, similarity)
    for i, j in np.argwhere(possible).tolist():
        one, two = slice(i * SMALL, (i + 1) * SMALL), slice(j * SMALL, (j + 1) * SMALL)
        a, b = left_ids[one], right_ids[two]
        near = np.bitwise_count((left[one][:, None] ^ right[two][None]).view(np.uint64)) <= radius
        x, y = np.divmod(np.flatnonzero(near), len(b))
        if len(x) > 4 * SMALL:
            apart = _roots(sure, a)[x] != _roots(sure, b)[y]
            x, y = x[apart], y[apart]
        parts = [
            estimates(left_sketches[one][x[at : at + 8192]], right_sketches[two][y[at : at + 8192]])
            for at in range(0, len(x), 8192)
        ]
        found = np.concatenate(parts) if parts else np.empty(0)
        keep = (found >= similarity - margin) & (a[x] != b[y])
        if not keep.any():
            continue
        x, y, found = x[keep], y[keep], found[keep]
        plain = found >= similarity + margin
        new = _tree_links(sure, a, b, x[plain], y[plain], found[plain])
        made += [(*pair, True) for pair in new]
        for pair in new:
            likely.link(*pair)
        rest = ~plain
        made += [(*pair, False) for pair in _tree_links(likely, a, b, x[rest], y[rest], found[rest])]
    return made


def _compare(radius, similarity):
    def compare(batches):
        names = ("ids", "prints", "shingles", "sketches")
        for batch in batches:
            for row in batch.to_dict("records"):
                left, right = (_unpack(*(row[n + side] for n in names)) for side in ("", "2"))
                edges = similar_links(left, right, radius, similarity)
                if edges:
                    yield pd.DataFrame(edges, columns=["a", "b", "sure"])

    return compare


def similar_edges(prints, radius=RADIUS, similarity=SIMILARITY):
    """(a, b, sure) over distinct sets with ``id``, ``fp``, ``shingles`` and ``sketch``.

    The number of tiles is ``TILES`` until they would exceed ``TILE_ROWS``. The comparison grows
    with the square of the distinct sets, divided by what sizes and counts skip.
    """
    spark = prints.sparkSession
    total = prints.count()
    tiles = max(1, min(TILES, total // SMALL), -(-total // TILE_ROWS))
    packed = stage.keep(
        prints.repartitionByRange(tiles, "shingles", "fp", "id").mapInPandas(
            _pack,
            "tile int, low array<int>, high array<int>, ids binary, prints binary, shingles binary, "
            "sketches binary",
        ),
        "similar-tiles",
    )
    boxes = packed.select("tile", "low", "high")
    last = boxes.agg(F.max("tile")).first()[0]
    if last is None:
        return spark.createDataFrame([], "a long, b long, sure boolean")
    low, high, low2, high2 = (F.col(n) for n in ("low", "high", "low2", "high2"))
    gap = sum(F.greatest(low[q] - high2[q], low2[q] - high[q], F.lit(0)) for q in range(4))
    pairs = (
        boxes.withColumn("tile2", F.explode(F.sequence("tile", F.lit(last))))
        .join(boxes.toDF("tile2", "low2", "high2"), "tile2")
        .where((gap <= radius) & (high[4] >= similarity * low2[4]) & (high2[4] >= similarity * low[4]))
        .select("tile", "tile2")
    )
    left = packed.drop("low", "high")
    right = left.toDF(*(f"{c}2" for c in left.columns))
    work = pairs.join(left, "tile").join(right, "tile2")
    work = work.repartition(max(shuffle_partitions(spark), tiles), "tile", "tile2")
    return work.mapInPandas(_compare(radius, similarity), "a long, b long, sure boolean")


# Check of the shingles


def _sets(size):
    def sets(batches):
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch[at : at + 64]
                made = [shingle_hashes(text, size) for text in part["text"]]
                rows = [(i, h.tobytes()) for i, h in zip(part["id"], made) if set_hash(h) == i]
                yield pd.DataFrame(rows, columns=["id", "hashes"]).astype({"id": "int64"})

    return sets


def _share_enough(one, two, percent):
    if 100 * min(len(one), len(two)) < percent * max(len(one), len(two)):
        return False
    both = np.sort(np.concatenate([one, two]))
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(both) - common)


def proven_links(left, right, percent, least):
    """A spanning forest of the pairs of ``left`` and ``right`` whose sets have the similarity.

    Both are (ids, sketches, sets). Every pair that the sketches do not rule out is decided by
    its sets, unless proven links join it already.
    """
    (a, a_sketches, a_sets), (b, b_sketches, b_sets) = left, right
    forest, made = Forest(), []
    for at in range(0, len(a), 32):
        x, y = np.divmod(np.arange(len(a[at : at + 32]) * len(b)), len(b))
        x += at
        found = estimates(a_sketches[x], b_sketches[y])
        keep = (found >= least) & (a[x] != b[y])
        x, y, found = x[keep], y[keep], found[keep]
        order = np.argsort(-found, kind="stable")
        for i, j in zip(x[order].tolist(), y[order].tolist()):
            pair = int(a[i]), int(b[j])
            if forest.root(pair[0]) != forest.root(pair[1]):
                if _share_enough(a_sets[i], b_sets[j], percent):
                    forest.link(*pair)
                    made.append(pair)
    return made


def _side(rows):
    sketches = np.frombuffer(b"".join(rows["sketch"]), np.uint64).reshape(len(rows), -1)
    return rows["id"].to_numpy(np.int64), sketches, [np.frombuffer(h, np.uint64) for h in rows["hashes"]]


def _prove(percent, least):
    """Over rows sorted by cluster and pair of parts."""

    def links(rows):
        low, high = rows["low"].iloc[0], rows["high"].iloc[0]
        left, right = (_side(rows[rows["part"] == part]) for part in (low, high))
        return proven_links(left, right, percent, least) if len(left[0]) and len(right[0]) else []

    def prove(batches):
        kept = None
        for batch in batches:
            batch = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
            if batch.empty:
                continue
            group = batch[["cluster", "low", "high"]].to_numpy(np.int64)
            starts = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(axis=1)])
            made = [link for s, e in zip(starts, starts[1:]) for link in links(batch[s:e])]
            kept = batch[starts[-1] :]
            yield pd.DataFrame(made, columns=["a", "b"], dtype="int64")
        if kept is not None and len(kept):
            yield pd.DataFrame(links(kept), columns=["a", "b"], dtype="int64")

    return prove


def checked_edges(edges, prints, docs, size=SHINGLE, percent=80, margin=MARGIN):
    """Edges (a, b) that join all pairs whose sets of shingles have the similarity.

    ``edges`` (a, b, sure) are trees of links that may hold. The pairs to decide are inside
    its components; those with an unsure link are compared whole, in pairs of parts of
    ``PART`` rows, and each pair that the sketches leave open is decided by its sets. A
    refused link hides no other. ``prints`` names the least key of each set, ``docs`` has
    ``key`` and ``text``.
    """
    roots = component_roots(edges.select("a", "b")).toDF("id", "cluster")
    members = roots.union(roots.select(F.col("cluster").alias("id"), "cluster").distinct())
    unsure = edges.where("NOT sure").select(F.col("a").alias("id"))
    undecided = members.join(unsure, "id").select("cluster").distinct()
    members = stage.keep(members.join(undecided, "cluster"), "similar-members")
    parts = members.groupBy("cluster").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
    named = members.join(prints, "id").select("id", F.col("least").alias("key"))
    texts = docs.join(named, "key").select("id", "text")
    sets = texts.mapInPandas(_sets(size), "id long, hashes binary").dropDuplicates(["id"])
    part, other = F.col("part"), F.col("other")
    rows = (
        members.join(parts, "cluster")
        .join(prints.select("id", "sketch"), "id")
        .join(sets, "id")
        .withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(
            "cluster", F.least(part, other).alias("low"), F.greatest(part, other).alias("high"),
            "part", "id", "sketch", "hashes",
        )
    )
    group = ["cluster", "low", "high"]
    rows = rows.repartition(shuffle_partitions(edges.sparkSession), *group).sortWithinPartitions(*group)
    return rows.mapInPandas(_prove(percent, percent / 100 - margin), "a long, b long")


# Operators


def similar_documents(docs, key="doc_id", text="text", similarity=SIMILARITY, size=SHINGLE):
    """Key and ``component_id``, the smallest key reachable over similar texts, of every row.

    Texts are similar if they share ``similarity`` of the different word shingles that either
    has, in whole hundredths. Texts of fewer words than a shingle are similar if their words
    are equal, as are all texts without words, null included. Of 64 bits, ``RADIUS`` may differ: texts
    at a similarity of 0.8 exceed that about once in 500 pairs. Null keys are passed
    over in the minimum. Repeated rows stay. Other columns are left out. An empty table gives
    an empty result.
    """
    kind = docs.schema[key].dataType.simpleString()
    docs = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    made = docs.mapInPandas(_prints(size), f"key {kind}, id long, fp long, shingles int, sketch binary")
    rows = stage.keep(made, "similar-prints")
    prints = stage.keep(
        rows.groupBy("id").agg(
            F.min("key").alias("least"), F.first("fp").alias("fp"),
            F.first("shingles").alias("shingles"), F.first("sketch").alias("sketch"),
        ),
        "similar-distinct",
    )
    compared = prints.where("shingles > 0").select("id", "fp", "shingles", "sketch")
    edges = stage.keep(similar_edges(compared, similarity=similarity), "similar-edges")
    proven = checked_edges(edges, prints, docs, size, round(100 * similarity))
    roots = component_roots(edges.where("sure").select("a", "b").union(proven))
    rooted = prints.join(roots.toDF("id", "root"), "id", "left").select(
        "id", F.coalesce("root", "id").alias("root"), "least"
    )
    components = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = rooted.join(components, "root").select("id", "component_id")
    return rows.join(named, "id").select(F.col("key").alias(key), "component_id")


def keep_one_of_each(docs, key="doc_id", text="text", similarity=SIMILARITY, size=SHINGLE):
    """The rows that are the smallest key of their component, with their columns.

    Rows with a null key are kept, as no other row can stand for them. Of rows with equal keys,
    all that have the kept key stay.
    """
    found = similar_documents(docs.where(F.col(key).isNotNull()), key, text, similarity, size)
    gone = free_name(docs, "gone")
    repeated = found.where(F.col(key) != F.col("component_id")).select(F.col(key).alias(gone))
    return docs.join(repeated, docs[key] == repeated[gone], "left_anti")
