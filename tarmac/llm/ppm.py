"""Document scores by prediction by partial matching over bytes.

The model predicts the bytes of a text whose words are each followed by one space; a second space
ends it. A byte is predicted from the five bytes before it, spaces and earlier words included;
before the first word stand five spaces, which nothing else can give. Contexts form a trie of
counts over all training texts. A byte that the longest context never saw is
reached by escapes to shorter ones, whose bytes already ruled out are excluded. How likely an
escape is, is learnt for classes of contexts by leaving out each training byte once.

Neither the counts nor the vocabulary fit into memory at scale, so nothing is broadcast but the tables
of contexts of one byte or none (65,536 entries at most). Texts are read once, in chunks of bounded
size; each chunk becomes rows of texts and a dictionary of its words and of the grams
(context and byte) they need. The dictionaries are summed up by key, with a list of the chunks that
asked; the grams are scored once each, grouped by the last two bytes of their context, which
hold all the counts an escape can lead to, and the values return to those chunks, where they
are read before the texts.
"""

from collections import Counter, defaultdict
from itertools import chain
from math import log10

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from tarmac.llm.common import ascii_lower, crc_of_id, settings
from tarmac.sources import stage

# A gram has one byte more and travels through numpy as one 64-bit number.
ORDER = 5
HELD_OUT = 10
CHUNK_BYTES = 32 * 1024 * 1024
# Texts of so many bytes are taken apart at once.
BLOCK_BYTES = 1024 * 1024
# Rows that go to a worker at once; texts make large ones.
BATCH_ROWS = 2000
# Grams of blocks that wait to be merged, at least.
MERGED = 500_000
SMOOTHING = 0.1
# Log probabilities of bytes travel as whole billionths.
UNIT = 1e9


def grams_of(text, order=ORDER):
    """The contexts with the byte that follows each, for a text and the space after it."""
    data = b" " * order + text + b" "
    return [data[at - order : at + 1] for at in range(order, len(data))]


def _packed_grams(texts, order):
    """The grams of all texts as numbers, text after text, and where those of each begin."""
    opening = b" " * order
    data = np.frombuffer(b"".join([opening + text + b" " for text in texts]), np.uint8)
    grams = data[: len(data) - order].astype(np.int64)
    for at in range(1, order + 1):
        grams <<= 8
        grams |= data[at : len(data) - order + at]
    sizes = np.fromiter((len(text) + 1 for text in texts), np.int64, len(texts))
    # Those that would run from a text into the next one.
    ends = np.cumsum(sizes + order)[:-1] - order
    grams = np.delete(grams, (ends[:, None] + np.arange(order)).ravel())
    return grams, np.cumsum(sizes) - sizes


def _entries(grams, order):
    """Entries of the dictionary, one for each packed gram."""
    entries = np.full((len(grams), order + 2), ord("g"), np.uint8)
    entries[:, 1:] = grams.astype(">i8").view(np.uint8).reshape(-1, 8)[:, 7 - order :]
    data, width = entries.tobytes(), order + 2
    return [data[at : at + width] for at in range(0, len(data), width)]


def _packed(entries, order):
    """Which entries of the dictionary are grams, and those packed."""
    entries = entries.cast(pa.large_binary())
    _, offsets, data = entries.buffers()
    begins = np.frombuffer(offsets, np.int64)[entries.offset : entries.offset + len(entries)]
    data = np.frombuffer(data, np.uint8)
    is_gram = data[begins] == ord("g")
    begins, grams = begins[is_gram] + 1, np.int64(0)
    for at in range(order + 1):
        grams = grams << 8 | data[begins + at].astype(np.int64)
    return is_gram, grams


def _summed(keys, counts):
    """Sorted distinct keys with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


def _blocks(texts):
    """Positions from and to of runs of texts of bounded size, or of one text."""
    begin = size = 0
    for at, text in enumerate(texts):
        if at > begin and size + len(text) > BLOCK_BYTES:
            yield begin, at
            begin, size = at, 0
        size += len(text) + 64
    if len(texts) > begin:
        yield begin, len(texts)


class _Chunk:
    """Words and grams of the texts so far; of the texts only a block that is not yet taken apart."""

    def __init__(self, number, order):
        self.number, self.order, self.size = number, order, 0
        self.words, self.others = Counter(), set()
        self.docs, self.pending = [], 0
        self.grams = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def add(self, key, held_out, text):
        """Rows of texts, whenever a block of them is full."""
        words = ascii_lower(text).split()
        words.append(b"")
        if held_out:
            self.others.update(words)
        else:
            self.words.update(words)
        # The end is an empty word, so a space follows each word.
        self.docs.append((key, held_out, b" ".join(words)))
        size = len(self.docs[-1][2]) + 64
        self.size, self.pending = self.size + size, self.pending + size
        if self.pending >= BLOCK_BYTES:
            yield self._take_apart()

    def _take_apart(self):
        """Count the grams of the block and return its rows of texts."""
        keys, held_out, texts = zip(*self.docs)
        for held in (False, True):
            block = [text for text, other in zip(texts, held_out) if other == held]
            if block:
                found, n = np.unique(_packed_grams(block, self.order)[0], return_counts=True)
                self.grams[0].append(found)
                self.grams[1].append(n * (not held))
        if sum(map(len, self.grams[0][1:])) > max(MERGED, len(self.grams[0][0])):
            self._merge()
        self.docs, self.pending = [], 0
        return pd.DataFrame({"chunk": self.number, "key": keys, "held_out": held_out, "data": texts})

    def _merge(self):
        summed = _summed(*map(np.concatenate, self.grams))
        self.grams = [summed[0]], [summed[1]]

    def rest(self):
        """The last texts and one row for each word and gram of the chunk."""
        if self.docs:
            yield self._take_apart()
        words = [*self.words, *(self.others - self.words.keys())]
        counts = np.fromiter((self.words[word] for word in words), np.int64, len(words))
        for at in range(0, len(words), 100_000):
            to = at + 100_000
            entries = [b"w" + word for word in words[at:to]]
            yield pd.DataFrame({"chunk": self.number, "entry": entries, "train": counts[at:to]})
        self._merge()
        (grams,), (counts,) = self.grams
        for at in range(0, len(grams), 100_000):
            to = at + 100_000
            entries = _entries(grams[at:to], self.order)
            yield pd.DataFrame({"chunk": self.number, "entry": entries, "train": counts[at:to]})


def _chunks(order):
    def read(batches):
        part, made, chunk = TaskContext.get().partitionId() << 32, 0, None
        for batch in batches:
            for key, held_out, text in zip(batch["key"], batch["held_out"], batch["text"]):
                chunk = chunk or _Chunk(part | made, order)
                yield from map(_complete, chunk.add(key, held_out, text))
                if chunk.size >= CHUNK_BYTES:
                    yield from map(_complete, chunk.rest())
                    made, chunk = made + 1, None
        if chunk:
            yield from map(_complete, chunk.rest())

    return read


_COLUMNS = ["chunk", "key", "held_out", "data", "entry", "train"]


def _complete(frame):
    for name in _COLUMNS:
        if name not in frame:
            frame[name] = None
    return frame[_COLUMNS]


# Model


def _class_of(order, total, distinct):
    """Class of a context for its escape: order, total by powers of two, distinct bytes."""
    return order, min(total.bit_length() + (total == 3), 24), min(distinct, 12)


class _Contexts:
    """Counts of the bytes after each context; those of one byte or none are given."""

    def __init__(self, short, escapes=None):
        self.short, self.escapes = short, escapes or {}
        self.nodes = defaultdict(dict)
        self.known = {}

    def learn(self, context, byte, n):
        for length in range(2, len(context) + 1):
            node = self.nodes[context[-length:]]
            node[byte] = node.get(byte, 0) + n

    def chain(self, context):
        """(order, counts, total and number of the bytes not excluded), longest first."""
        excluded = ()
        for length in range(len(context), -1, -1):
            suffix = context[len(context) - length :]
            node = (self.nodes if length > 1 else self.short).get(suffix)
            if not node or len(node) == len(excluded):
                continue
            total = sum(node.values()) - sum(node[byte] for byte in excluded)
            yield length, node, total, len(node) - len(excluded)
            excluded = node

    def surprises(self, context, byte, n):
        """(class, escapes, hits) that coding the n occurrences would meet, each left out itself.

        Only a byte seen once escapes the longest context, so at most one occurrence goes on.
        """
        for order, node, total, distinct in self.chain(context):
            if total > 1:
                found = node[byte]
                if found > 1:
                    yield _class_of(order, total - 1, distinct), 0, n
                    return
                yield _class_of(order, total - 1, distinct - 1), 1, 0
            n = 1

    def _escape(self, order, total, distinct):
        known = self.escapes.get(_class_of(order, total, distinct))
        return known or distinct / (total + distinct)

    def _prepared(self, context):
        steps, gone, left = [], 0.0, 256
        for order, node, total, distinct in self.chain(context):
            left = 256 - len(node)
            escape = self._escape(order, total, distinct) if left else 0.0
            steps.append((node, gone + log10((1 - escape) / total)))
            gone += log10(escape) if left else 0.0
        return steps, gone - (log10(left) if left else 0.0)

    def log_probability(self, context, byte):
        prepared = self.known.get(context)
        if prepared is None:
            prepared = self.known[context] = self._prepared(context)
        for node, share in prepared[0]:
            n = node.get(byte)
            if n:
                return share + log10(n)
        return prepared[1]


def _contexts_of(grams, shared):
    contexts = _Contexts(*shared.value)
    parted = [(entry[1:-1], entry[-1]) for entry in grams["entry"]]
    for (context, byte), n in zip(parted, grams["n"]):
        if n:
            contexts.learn(context, byte, n)
    return contexts, parted


def _count_escapes(shared):
    def count(grams):
        contexts, parted = _contexts_of(grams, shared)
        met = defaultdict(lambda: [0, 0])
        for (context, byte), n in zip(parted, grams["n"]):
            if n:
                for class_, escapes, hits in contexts.surprises(context, byte, n):
                    met[class_][0] += escapes
                    met[class_][1] += hits
        rows = [(*class_, *seen) for class_, seen in met.items()]
        return pd.DataFrame(rows, columns=["order", "total", "distinct", "escapes", "hits"])

    return count


def _score_grams(shared):
    def score(grams):
        contexts, parted = _contexts_of(grams, shared)
        logs = [contexts.log_probability(context, byte) for context, byte in parted]
        value = np.rint(np.array(logs) * UNIT).astype(np.int64)
        return pd.DataFrame({"entry": grams["entry"], "value": value})

    return score


def escape_estimates(rows):
    """Probability of an escape for each class of contexts, from (class, escapes, hits)."""
    return {
        class_: (escapes + 0.5) / (escapes + hits + 1) for class_, escapes, hits in rows
    }


def _short_contexts(grams):
    """Counts after contexts of one byte and of none; bounded by the number of byte pairs."""
    pair = F.expr("substring(entry, octet_length(entry) - 1, 2)")
    short = defaultdict(dict)
    for row in grams.groupBy(pair.alias("pair")).agg(F.sum("n").alias("n")).where("n > 0").collect():
        last, byte = bytes(row["pair"][:1]), row["pair"][1]
        short[last][byte] = row["n"]
        short[b""][byte] = short[b""].get(byte, 0) + row["n"]
    return dict(short)


# Scores


class _Dictionary:
    """Counts of the words and scores of the grams that a chunk asked for."""

    def __init__(self):
        self.entries, self.counts, self.words = [], [], None
        self.grams, self.logs, self.index = [], [], None

    def add(self, entries, values, order):
        is_gram, grams = _packed(entries, order)
        self.grams.append(grams)
        self.logs.append(values[is_gram])
        self.entries.append(entries.filter(pa.array(~is_gram)))
        self.counts.append(values[~is_gram])

    def _complete(self):
        """Tables of all entries; frequent words lie together, so most of the look-ups stay in a cache."""
        counts = np.concatenate(self.counts)
        order = np.argsort(-counts, kind="stable")
        words = pa.concat_arrays(self.entries).take(pa.array(order)).to_pylist()
        self.words = dict(zip((word[1:] for word in words), counts[order].tolist()))
        self.index, self.logs = pd.Index(np.concatenate(self.grams)), np.concatenate(self.logs)
        self.entries = self.counts = self.grams = None

    def score(self, texts, low, order):
        """Tokens, known tokens, base score and score of each text."""
        if self.index is None:
            self._complete()
        for begin, end in _blocks(texts):
            found = [text.split() + [b""] for text in texts[begin:end]]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            starts = np.cumsum(sizes) - sizes
            seen = map(self.words.__getitem__, chain.from_iterable(found))
            seen = np.fromiter(seen, np.int64, int(sizes.sum()))
            base = np.add.reduceat(np.log10((seen + SMOOTHING) / low), starts)
            met, first = _packed_grams(texts[begin:end], order)
            logs = self.logs[self.index.get_indexer(met)]
            known = np.add.reduceat((seen > 0).astype(np.int64), starts)
            yield sizes, known, base, np.add.reduceat(logs, first) / UNIT


def _score_chunks(tokens, distinct, order):
    """Score the texts of each chunk, odd turns, by its dictionary, the even turn before."""
    low = tokens + SMOOTHING * (distinct + 1)
    names = ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(batches):
        turn = dictionary = None
        for batch in batches:
            turns = batch.column("turn").to_numpy()
            cuts = [0, *(np.flatnonzero(turns[1:] != turns[:-1]) + 1).tolist(), len(turns)]
            for begin, end in zip(cuts, cuts[1:]):
                part = batch.slice(begin, end - begin)
                values = part.column("value").to_numpy()
                if turns[begin] % 2 == 0:
                    if turns[begin] != turn:
                        turn, dictionary = turns[begin], _Dictionary()
                    dictionary.add(part.column("entry"), values, order)
                    continue
                for at in range(0, len(part), BATCH_ROWS):
                    some = part.slice(at, BATCH_ROWS)
                    scores = dictionary.score(some.column("entry").to_pylist(), low, order)
                    sizes, known, base, logs = map(np.concatenate, zip(*scores))
                    train = np.full(len(sizes), tokens, np.int64)
                    held_out = values[at : at + BATCH_ROWS] != 0
                    columns = map(pa.array, (held_out, sizes, known, train, base, logs))
                    yield pa.RecordBatch.from_arrays([some.column("key"), *columns], names)

    return score


def score_documents(docs, key="doc_id", text="text", held_out=None):
    """Score every whole text by a model of the texts that are not held out.

    Returns the key, ``held_out``, ``n_tokens`` (words and one end), ``n_known`` (tokens seen
    in training), ``train_tokens``, ``base_score`` (smoothed unigrams) and ``score``, the
    model's log10 probability of its words in their order; other columns are left out.
    ``held_out`` is a boolean column, by default whether crc32 of the key as text is divisible
    by ten; where it is null the row is held out. A null text is empty and has only its end; a
    null key counts as the empty text. Repeated rows count each time. If nothing is trained
    on, all bytes are equally likely.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    if held_out is None:
        held_out = crc_of_id(F.col(key)) % HELD_OUT == 0
    rows = docs.select(
        F.col(key).alias("key"),
        F.coalesce(held_out, F.lit(True)).alias("held_out"),
        F.col(text).alias("text"),
    )
    path = stage.new_stage_path(spark, "chunks")
    schema = f"chunk long, key {kind}, held_out boolean, data binary, entry binary, train long"
    with settings(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}):
        chunks = rows.mapInPandas(_chunks(ORDER), schema)
        chunks.write.option("compression", "zstd").parquet(path)
    read = spark.read.schema(schema).parquet(path)
    # An entry is in a chunk once, so sums before the shuffle would only cost; after it the
    # entries are sorted once and summed as they come.
    entries = read.where("entry IS NOT NULL").select("entry", "chunk", "train").repartition("entry")
    summed = entries.groupBy("entry").agg(
        F.sum("train").alias("n"), F.collect_list("chunk").alias("chunks")
    )
    with settings(spark, **{"spark.sql.execution.useObjectHashAggregateExec": "false"}):
        totals = stage.keep(summed, "totals", "zstd")
    is_word = F.expr("substring(entry, 1, 1) = X'77'")
    words, grams = totals.where(is_word), totals.where(~is_word)
    tokens, distinct = words.where("n > 0").agg(F.sum("n"), F.count("*")).first()
    # The last two bytes before the predicted one.
    by_tail = grams.select("entry", "n").groupBy(F.expr("substring(entry, octet_length(entry) - 2, 2)").alias("tail"))
    short = _short_contexts(grams)
    met = by_tail.applyInPandas(
        _count_escapes(spark.sparkContext.broadcast((short, None))),
        "order int, total int, distinct int, escapes long, hits long",
    )
    # One row for each class: at most 5 x 25 x 13.
    classes = met.groupBy("order", "total", "distinct").agg(F.sum("escapes"), F.sum("hits"))
    escapes = escape_estimates([(tuple(row[:3]), *row[3:]) for row in classes.collect()])
    shared = spark.sparkContext.broadcast((short, escapes))
    scored = by_tail.applyInPandas(_score_grams(shared), "entry binary, value long")
    scored = scored.join(grams.select("entry", "chunks"), "entry")
    values = words.select("entry", F.col("n").alias("value"), "chunks").union(scored)
    asked = values.select(F.explode("chunks").alias("chunk"), "entry", "value").select(
        F.expr("2 * chunk").alias("turn"), "entry", "value", F.lit(None).cast(kind).alias("key")
    )
    texts = read.where("entry IS NULL").select(
        F.expr("2 * chunk + 1").alias("turn"), "data", F.col("held_out").cast("long"), "key"
    )
    scores = (
        asked.union(texts)
        .repartition(F.shiftright("turn", 1))
        .sortWithinPartitions("turn")
        .mapInArrow(
            _score_chunks(tokens or 0, distinct, ORDER),
            f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
        .withColumnRenamed("key", key)
    )
    # Written here, as the size of a batch is a setting of the running job.
    with settings(spark, **{"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)}):
        return stage.keep(scores, "scores", "zstd")
