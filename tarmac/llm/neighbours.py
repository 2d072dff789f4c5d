"""Approximate nearest neighbours by largest inner product over balanced posting lists.

Vectors get one more component that gives them all the greatest norm, which turns the largest inner
product into the smallest distance. Centroids of a bounded sample name the posting lists. Every vector
goes to its nearest list and, near a boundary, to others as well. The centroids, a bounded
table, are searched by a proximity graph in memory. A query opens the lists whose centroid is at most
``ratio`` times as far as the nearest, and the next nearest until they hold as many other rows as are
asked for. Cells of the centroids are balanced: large ones are split, tiny ones dissolved. A list that is too large is split into parts
and the queries of a list into blocks, so no task meets more than one part and block;
within, all inner products are computed and the best returned as one row for each query.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tarmac.sources import stage

NEAREST = 20
SAMPLE = 16_384
LIST_ROWS = 512
MOST_LISTS = 4_096
COPIES, COPY_RATIO = 2, 1.05
RATIO = 1.15
DEGREE = 16
EXPLORE = 32
BLOCK_QUERIES = 1_024


def _distances(points, centres):
    squares = (points**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)
    return np.sqrt(np.maximum(squares - 2 * points @ centres.T, 0))


def fit_centroids(sample, lists, rounds=8):
    """k-means over the sample, begun from its first different vectors."""
    centres = np.unique(sample[: 4 * lists], axis=0)
    centres = centres[np.random.default_rng(0).permutation(len(centres))[:lists]]
    for _ in range(rounds):
        nearest = _distances(sample, centres).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        centres = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], centres)
    return centres


def balanced_centroids(sample, lists, rounds=4):
    """k-means whose cells of more than twice the mean size are split and of under a quarter dissolved."""
    centres, mean = fit_centroids(sample, lists), len(sample) / lists
    for _ in range(rounds):
        nearest = _distances(sample, centres).argmin(axis=1)
        sizes = np.bincount(nearest, minlength=len(centres))
        large = np.flatnonzero(sizes > max(2 * mean, 2))
        stays = (sizes >= mean / 4) & (sizes <= max(2 * mean, 2))
        if stays.all():
            break
        split = [fit_centroids(sample[nearest == i], int(-(-sizes[i] // mean))) for i in large]
        new = np.concatenate([centres[stays], *split])
        if not len(new) or np.array_equal(new, centres):
            break
        centres = new
    return centres


class CentroidGraph:
    """Links between near centroids, and a ring through all so that every one can be reached."""

    def __init__(self, centres):
        self.centres, count = centres, len(centres)
        links = [{(i + 1) % count, (i - 1) % count} for i in range(count)]
        for at in range(0, count, 256):
            near = _distances(centres[at : at + 256], centres).argsort(axis=1)[:, : DEGREE + 1]
            for i, row in enumerate(near.tolist(), at):
                links[i].update(row)
                for j in row:
                    links[j].add(i)
        self.links = [np.array(sorted(found - {i}), np.int64) for i, found in enumerate(links)]
        self.start = int(_distances(centres.mean(axis=0)[None], centres).argmin())

    def search(self, point, ratio, most=None, sizes=None, least=0):
        """Centroids at most ``ratio`` times as far as the nearest, nearest first.

        With ``sizes`` the next nearest follow until their sizes add up to ``least``.
        """
        seen = np.zeros(len(self.centres), dtype=bool)
        seen[self.start] = True
        first = float(_distances(point[None], self.centres[self.start][None])[0, 0])
        open_, met, best, expanded = [(first, self.start)], [(first, self.start)], first, 0
        while open_:
            distance, at = heapq.heappop(open_)
            if distance > ratio * best and expanded >= EXPLORE:
                break
            expanded += 1
            new = self.links[at][~seen[self.links[at]]]
            if not len(new):
                continue
            seen[new] = True
            for pair in zip(_distances(point[None], self.centres[new])[0].tolist(), new.tolist()):
                heapq.heappush(open_, pair)
                met.append(pair)
                best = min(best, pair[0])
        chosen = sorted(pair for pair in met if pair[0] <= ratio * best)
        chosen = [at for _, at in chosen[:most]]
        if sizes is not None and sizes[chosen].sum() < least:
            for at in _distances(point[None], self.centres)[0].argsort(kind="stable").tolist():
                if sizes[chosen].sum() >= least:
                    break
                if at not in chosen:
                    chosen.append(at)
        return chosen


def _lifted(shares):
    """Vectors as shares of the greatest norm, with the component that gives them norm one."""
    own = (shares**2).sum(axis=1)
    return np.column_stack([shares, np.sqrt(np.maximum(1.0 - own, 0.0))])


def _assign(shared, ratio, most, is_query, sizes=None, least=0):
    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, norm = shared.value
        graph = CentroidGraph(centres)
        for batch in batches:
            keys, lists, vectors = [], [], []
            for key, vector in zip(batch["key"], batch["vector"]):
                # Scaled by the greatest component, so no square leaves the range of a double.
                greatest = np.abs(vector).max()
                vector_of_ones = vector / greatest
                own = float(np.sqrt((vector_of_ones**2).sum()))
                if is_query:
                    point = np.append(vector_of_ones / own, 0.0)
                else:
                    point = _lifted((vector / norm)[None])[0]
                for found in graph.search(point, ratio, most, sizes, least):
                    keys.append(key)
                    lists.append(found)
                    vectors.append(vector)
            yield pd.DataFrame({"key": keys, "list": lists, "vector": vectors})

    return assign


def inner_products(left, right):
    """Inner products of paired rows, added up component by component in order.

    Unlike a matrix product, equal pairs give equal results wherever they stand.
    """
    total = left[:, 0] * right[:, 0]
    for at in range(1, left.shape[1]):
        total = total + left[:, at] * right[:, at]
    return total


def _best(nearest):
    def best(vectors, queries):
        if vectors.empty or queries.empty:
            return pd.DataFrame({"query": [], "ids": [], "scores": []})
        ids, mine = vectors["key"].to_numpy(), queries["key"].to_numpy()
        rows, asked = np.stack(vectors["vector"]), np.stack(queries["vector"])
        rough = asked @ rows.T
        rough[mine[:, None] == ids[None]] = -np.inf
        if len(ids) > nearest:
            edge = np.partition(rough, -nearest, axis=1)[:, -nearest]
        else:
            edge = np.full(len(mine), -np.inf)
        slack = 1e-9 * np.sqrt((asked**2).sum(axis=1)) * np.sqrt((rows**2).sum(axis=1).max())
        q, v = np.nonzero((rough >= (edge - slack)[:, None]) & (rough > -np.inf))
        scores = inner_products(asked[q], rows[v])
        order = np.lexsort((ids[v], -scores, q))
        q, v, scores = q[order], v[order], scores[order]
        first = np.searchsorted(q, np.arange(len(mine)))
        keep = np.arange(len(q)) - first[q] < nearest
        q, v, scores = q[keep], v[keep], scores[keep]
        cuts = np.searchsorted(q, np.arange(1, len(mine)))
        found = pd.DataFrame(
            {"query": mine, "ids": np.split(ids[v], cuts), "scores": np.split(scores, cuts)}
        )
        return found[[len(x) > 0 for x in found["ids"]]]

    return best


def _merge(nearest):
    def merge(parts):
        ids, scores = np.concatenate(parts["ids"].tolist()), np.concatenate(parts["scores"].tolist())
        order = np.lexsort((ids, -scores))
        ids, scores = ids[order], scores[order]
        _, first = np.unique(ids, return_index=True)
        first = np.sort(first)[:nearest]
        return pd.DataFrame(
            {
                "query_id": parts["query"].iloc[0],
                "rank": np.arange(1, len(first) + 1, dtype=np.int32),
                "vec_id": ids[first],
                "score": scores[first],
            }
        )

    return merge


def usable_vectors(table, key, vector):
    """(key, vector of doubles) of the rows that can be searched.

    Left out are null keys and vectors that are null, all zero, hold a null or non-finite
    component, or have another length than most. Of rows with equal keys the least vector stays.
    """
    value = F.col(vector).cast("array<double>")
    rows = table.select(F.col(key).alias("key"), value.alias("vector")).where(
        F.col("key").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
        & F.exists("vector", lambda x: x != 0)
    )
    length = rows.agg(F.mode(F.size("vector"), True)).first()[0]
    rows = rows.where(F.size("vector") == F.lit(length))
    return rows.groupBy("key").agg(F.min("vector").alias("vector"))


def nearest_neighbours(table, is_query, key="vec_id", vector="embedding", nearest=NEAREST, ratio=RATIO):
    """The ``nearest`` rows of largest inner product found for every query row.

    Returns ``query_id``, ``rank`` from 1, ``vec_id`` and ``score``, a double computed on the
    original vectors; equal scores are ordered by key. A query never finds its own key. Rows that
    ``usable_vectors`` leaves out neither ask nor are found. ``is_query`` makes a
    condition of the key column. An empty table gives an empty result.

    The centroids come from ``SAMPLE`` rows at most, those of least key hash, and are
    ``MOST_LISTS`` at most; every row is indexed.
    """
    spark = table.sparkSession
    rows = stage.keep(usable_vectors(table, key, vector), "vectors")
    # Scaled as in the tasks; an overflowing norm would spoil all others.
    greatest = F.array_max(F.transform("vector", F.abs))
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / greatest) * (x / greatest))
    norm = F.least(greatest * F.sqrt(squares), F.lit(1e300))
    total, most = rows.agg(F.count("*"), F.max(norm)).first()
    schema = f"query_id {_kind(rows)}, rank int, vec_id {_kind(rows)}, score double"
    if not total:
        return spark.createDataFrame([], schema)
    lists = max(1, min(MOST_LISTS, total // LIST_ROWS))
    chosen = rows.select(F.xxhash64("key").alias("h"), "vector").orderBy("h").limit(SAMPLE)
    sample = np.array([row["vector"] for row in chosen.collect()])
    sample = _lifted(sample / most)
    centres = balanced_centroids(sample, lists)
    shared = spark.sparkContext.broadcast((centres, most))

    columns = f"key {_kind(rows)}, list int, vector array<double>"
    indexed = stage.keep(
        rows.mapInPandas(_assign(shared, COPY_RATIO, COPIES, False), columns), "posting-lists"
    )
    sizes = np.zeros(len(centres), np.int64)
    for at, size in indexed.groupBy("list").count().collect():
        sizes[at] = size
    # A row is in so many lists at most, and the query's own row does not count.
    assign = _assign(shared, ratio, None, True, sizes, COPIES * (nearest + 1))
    asked = stage.keep(rows.where(is_query(F.col("key"))).mapInPandas(assign, columns), "queries")
    # One row for each list: parts of its vectors and blocks of its queries.
    parts = indexed.groupBy("list").agg(F.ceil(F.count("*") / (2 * LIST_ROWS)).alias("parts"))
    blocks = asked.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_QUERIES).alias("blocks"))
    shape = F.broadcast(parts.join(blocks, "list"))
    part, block = F.pmod(F.xxhash64("key"), "parts"), F.pmod(F.xxhash64("key"), "blocks")
    vectors = indexed.join(shape, "list").select(
        "list", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
        "key", "vector",
    )
    queries = asked.join(shape, "list").select(
        "list", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), block.alias("block"),
        "key", "vector",
    )
    group = ["list", "part", "block"]
    found = (
        vectors.groupBy(group)
        .cogroup(queries.groupBy(group))
        .applyInPandas(
            _best(nearest),
            f"query {_kind(rows)}, ids array<{_kind(rows)}>, scores array<double>",
        )
    )
    return found.groupBy("query").applyInPandas(_merge(nearest), schema)


def _kind(rows):
    return rows.schema["key"].dataType.simpleString()
