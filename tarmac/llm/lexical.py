"""Ranked lexical search by dense products of query tiles and document tiles.

Only the terms of the queries are kept of the documents. Query weights and document impacts are
whole numbers in float64 matrices; tiles are cut so that no partial sum reaches 2^53, so every
product is exact whatever order the matrix library adds in.
"""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.llm.common import settings
from tarmac.operators.joins import broadcast_if_small, measured_bytes
from tarmac.sources import stage

TOP = 10
# Uncompressed bytes of queries searched in one pass over the documents.
PASS_BYTES = 1 << 19
# Queries, terms and documents of a tile, and weights that a tile of queries may hold.
QUERY_TILE, TERM_TILE, DOCUMENT_TILE = 256, 1024, 1024
TILE_CELLS = 1 << 20
# Longer texts are taken apart in segments.
SEGMENT_BYTES = 1 << 20
# Rows sent to a Python worker at once: a bound of its memory, as texts may be long.
BATCH_ROWS = 500
# Groups in which a query's candidates are ranked before they meet.
GROUPS = 64

# Fixed values of the score: an impact is below SCALE, so weights of a tile add up to less than
# MOST.
SCALE, TF, LENGTH, SLOPE, BASE = 10**9, 1000, 8, 75, 25
MOST = ((1 << 53) - 1) // (SCALE // TF)

_OTHERS = bytes(b for b in range(128) if not chr(b).isalnum())
_TERMS = bytes.maketrans(_OTHERS, b" " * len(_OTHERS))


def terms_of(text):
    """Runs of ASCII letters, digits and bytes above them, A-Z lower-cased, some at a time."""
    text = text.translate(_TERMS).lower()
    at = 0
    while at < len(text):
        cut = text.find(b" ", at + SEGMENT_BYTES)
        cut = len(text) if cut < 0 else cut
        yield text[at:cut].split()
        at = cut


def weight(documents, holding):
    """Weight of a term that so many of the documents hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_factor(n, documents, occurrences):
    return BASE + SLOPE * n * documents // occurrences


def impacts(counts, factors):
    """What one occurrence in a query adds for each unit of weight."""
    return SCALE * counts // (TF * counts + LENGTH * factors)


class QueryTile:
    """Weights of some queries over their own terms, in matrices whose products are exact."""

    def __init__(self, queries, weights):
        self.terms = np.array(sorted({t for q in queries for t in q if weights.get(t)}), np.int64)
        column = {t: i for i, t in enumerate(self.terms.tolist())}
        whole = np.zeros((len(queries), len(self.terms)), np.int64)
        for i, query in enumerate(queries):
            for t, times in query.items():
                if t in column:
                    whole[i, column[t]] = times * weights[t]
        self.parts = []
        at = 0
        while at < len(self.terms):
            end = min(at + TERM_TILE, len(self.terms))
            while end > at + 1 and whole[:, at:end].sum(axis=1).max() > MOST:
                end = at + (end - at) // 2
            part = whole[:, at:end]
            if part.sum(axis=1).max() <= MOST:
                planes = [(1, part.astype(np.float64))]
            else:
                planes = [
                    (1 << 32, (part >> 32).astype(np.float64)),
                    (1, (part & ((1 << 32) - 1)).astype(np.float64)),
                ]
            self.parts.append((at, end, planes))
            at = end

    def scores(self, documents, terms, values, size):
        """Scores, query by document, of ``size`` documents given as three flat arrays."""
        total = None
        if len(self.terms):
            column = np.searchsorted(self.terms, terms)
            column[column == len(self.terms)] = 0
            own = self.terms[column] == terms
            documents, column, values = documents[own], column[own], values[own]
        for at, end, planes in self.parts:
            inside = (column >= at) & (column < end)
            dense = np.zeros((size, end - at))
            dense[documents[inside], column[inside] - at] = values[inside]
            for factor, plane in planes:
                part = (plane @ dense.T).astype(np.int64) * factor
                total = part if total is None else total + part
        return total


def query_tiles(queries, weights):
    """(number of the first query, tile), tiles being cut so that none grows large."""
    at = 0
    while at < len(queries):
        terms, end = set(queries[at]), at + 1
        while end < len(queries) and end - at < QUERY_TILE:
            more = terms | queries[end].keys()
            if (end + 1 - at) * len(more) > TILE_CELLS:
                break
            terms, end = more, end + 1
        yield at, QueryTile(queries[at:end], weights)
        at = end


class Best:
    """The highest scores of each query so far; equal ones by missing key, then least key."""

    def __init__(self, queries, top):
        self.top = top
        none = np.empty(0, np.int64)
        self.rows = [(none, none.astype(bool), none)] * queries
        self.least = np.ones(queries, np.int64)

    def add(self, first, scores, known, keys):
        near = scores >= self.least[first : first + len(scores), None]
        for i in np.flatnonzero(near.any(axis=1)):
            found = np.flatnonzero(near[i])
            parts = (scores[i, found], known[found], keys[found])
            parts = [np.concatenate(pair) for pair in zip(self.rows[first + i], parts)]
            order = np.lexsort((parts[2], parts[1], -parts[0]))[: self.top]
            self.rows[first + i] = tuple(part[order] for part in parts)
            if len(order) == self.top:
                self.least[first + i] = self.rows[first + i][0][-1]


def _vectors(shared):
    schema = pa.schema(
        [
            ("key", pa.int64()),
            ("n", pa.int64()),
            ("terms", pa.list_(pa.int32())),
            ("counts", pa.list_(pa.int64())),
        ]
    )

    def vectors(batches):
        vocabulary = shared.value
        for batch in batches:
            rows = []
            for key, text in zip(batch["key"].to_pylist(), batch["text"]):
                n, found = 0, Counter()
                for words in terms_of(text.as_py()):
                    n += len(words)
                    found.update(filter(None, map(vocabulary.get, words)))
                terms = sorted(found)
                rows.append((key, n, terms, [found[t] for t in terms]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, f.type) for column, f in zip(zip(*rows), schema)],
                    schema=schema,
                )

    return vectors


def _search(shared, documents, occurrences, top):
    schema = pa.schema([("query", pa.int64()), ("key", pa.int64()), ("score", pa.int64())])

    def flat(column):
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)

    def search(batches):
        queries, numbers, weights = shared.value
        tiles = list(query_tiles(queries, weights))
        best = Best(len(queries), top)
        for batch in batches:
            for at in range(0, len(batch), DOCUMENT_TILE):
                part = batch.slice(at, DOCUMENT_TILE)
                size = len(part)
                known = part["key"].is_valid().to_numpy(zero_copy_only=False)
                keys = part["key"].fill_null(0).to_numpy(zero_copy_only=False)
                factors = np.array(
                    [length_factor(n, documents, occurrences) for n in part["n"].to_pylist()]
                )
                lengths = part["terms"].value_lengths().to_numpy(zero_copy_only=False)
                place = np.repeat(np.arange(size), lengths)
                terms = flat(part["terms"])
                values = impacts(flat(part["counts"]), factors[place])
                for first, tile in tiles:
                    scores = tile.scores(place, terms, values, size)
                    if scores is not None:
                        best.add(first, scores, known, keys)
        for number, (scores, known, keys) in zip(numbers, best.rows):
            if len(scores):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(scores), number)),
                        pa.array(keys, mask=~known),
                        pa.array(scores),
                    ],
                    schema=schema,
                )

    return search


def _best_of(found, top):
    """Ranks within each query; candidates are thinned in groups before they meet."""

    def ranked(*keys):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_first("key"))
        return F.row_number().over(order)

    group = F.pmod(F.xxhash64("key", "score"), F.lit(GROUPS))
    thinned = found.withColumn("group", group).withColumn("rank", ranked("query", "group"))
    thinned = thinned.where(F.col("rank") <= top).drop("rank", "group")
    return thinned.withColumn("rank", ranked("query")).where(F.col("rank") <= top)


def rank_documents(docs, items, key="doc_id", item="item_id", text="text", top=TOP):
    """Item id, ``rank``, key and ``score`` of the ``top`` documents of each row of ``items``.

    ``docs[key]`` holds whole numbers. Of equal scores the lesser key is first, a null key before
    all others; repeated rows are ranked each on its own, rows of ``items`` as well, whatever
    their ids. Null, empty and blank texts have no terms: such documents are not counted, such
    items find nothing, as is the case with an empty table. Other columns play no part.

    The items are searched for in passes over the documents, ``PASS_BYTES`` of them at a time,
    so the vocabulary that a task holds does not grow with their number.
    """
    spark = docs.sparkSession
    path = stage.new_stage_path(spark, "ranked")
    as_bytes = F.coalesce(F.col(text).cast("binary"), F.lit(b"")).alias("text")
    documents = docs.select(F.col(key).cast("long").alias("key"), as_bytes)
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    with stage.job(spark), settings(spark, **{batch: str(BATCH_ROWS)}):
        queries = stage.keep(
            items.select(
                F.monotonically_increasing_id().alias("query"), F.col(item).alias("item"), as_bytes
            ),
            "queries",
        )
        passes = max(1, -(-measured_bytes(queries.select("text"))[0] // PASS_BYTES))
        part = F.pmod(F.xxhash64("query"), F.lit(passes))
        found = [
            stage.keep(_one_pass(documents, queries.where(part == i), top), "found")
            for i in range(passes)
        ]
        best = _best_of(found[0], top) if passes == 1 else None
        for some in found if passes > 1 else ():
            more = _best_of(some, top)
            best = more if best is None else best.union(more)
        names = broadcast_if_small(queries.select("query", "item"))[0]
        best.join(names, "query").select(
            F.col("item").alias(item), "rank", F.col("key").alias(key), "score"
        ).write.parquet(path)
    return spark.read.parquet(path)


def _one_pass(documents, queries, top):
    """The best documents of some queries, as found by each task."""
    spark = documents.sparkSession
    rows = queries.select("query", "text").collect()
    vocabulary, counted = {}, []
    for row in rows:
        counts = Counter(t for terms in terms_of(bytes(row["text"])) for t in terms)
        # Numbers start at 1: a missing term is None, and no number is false.
        counted.append(
            {vocabulary.setdefault(t, len(vocabulary) + 1): n for t, n in counts.items()}
        )
    shared = spark.sparkContext.broadcast(vocabulary)
    vectors = stage.keep(
        documents.mapInArrow(
            _vectors(shared), "key long, n long, terms array<int>, counts array<long>"
        ),
        "vectors",
    )
    occurrences, holding = vectors.agg(F.sum("n"), F.count_if(F.col("n") > 0)).first()
    held = vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
    weights = {row["term"]: weight(holding, row["count"]) for row in held}
    shared = spark.sparkContext.broadcast((counted, [row["query"] for row in rows], weights))
    return vectors.where(F.size("terms") > 0).mapInArrow(
        _search(shared, holding, occurrences, top), "query long, key long, score long"
    )
