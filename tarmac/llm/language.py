"""Language identification by unigrams over all segmentations of each word.

The pieces are those of a fixed public vocabulary; only their probabilities are learnt, for each
language, by expectation maximisation over all training words. The probability of a word is the sum
over all its segmentations, by the forward algorithm, and that of a text the product over its
words. Forward and backward run on arrays of words of equal length at once.

Words are runs of letters, lower-cased, after a word mark. Runs of more than ``LONGEST``
letters, as in scripts without spaces, are cut there.
"""

import re
import sys
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import crc_of_id, free_name
from tarmac.sources import stage

LONGEST = 32
ROUNDS = 3
# Share of a piece's probability that is spread evenly, so that none is zero.
EVEN = 1e-3
UNKNOWN = "und"
FOLDS, HELD_OUT = 3, 1
_MARK = "\N{LOWER ONE EIGHTH BLOCK}"
# Signs that a pattern of words takes in, though they are numbers and no letters: Ⅷ, ², ½, ①.
_NUMBERS = frozenset(
    c for c in map(chr, range(sys.maxunicode + 1)) if c.isnumeric() and not c.isalpha()
)
_WORDS = re.compile(rf"[^\W\d_]{{1,{LONGEST}}}").findall
_CODE_BITS = 21
# Words in memory at once: counted, scored, or kept with their scores.
_COUNTED, _SCORED, _KEPT = 400_000, 200_000, 300_000


def words_of(text):
    if not text:
        return []
    text = text.lower()
    if not text.isascii() and (numbers := _NUMBERS.intersection(text)):
        text = text.translate(dict.fromkeys(map(ord, numbers), " "))
    return _WORDS(text)


def sentence_pieces(path):
    """Pieces of a SentencePiece model, by id; id 0 stands for unknown characters."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(number) for number in range(model.get_piece_size())]


class Lattice:
    """The pieces as a trie in sorted arrays, and the sums over segmentations."""

    def __init__(self, pieces):
        children, ends = {}, {}
        for number, piece in enumerate(pieces):
            if number and all(c.isalpha() or c == _MARK for c in piece):
                node = 0
                for c in piece:
                    node = children.setdefault(node << _CODE_BITS | ord(c), len(children) + 1)
                ends[node] = number
        keys = np.array(sorted(children), dtype=np.int64)
        self.keys, self.nodes = keys, np.array([children[k] for k in keys.tolist()], np.int64)
        self.piece = np.full(len(children) + 1, -1, dtype=np.int64)
        for node, number in ends.items():
            self.piece[node] = number

    def _step(self, nodes, codes):
        wanted = nodes << _CODE_BITS | codes
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return self.keys[at] == wanted, self.nodes[at]

    def arcs(self, codes):
        """(start, end, rows, pieces) of every piece in an array of words of one length."""
        count, length = codes.shape
        for start in range(length):
            rows, nodes = np.arange(count), np.zeros(count, dtype=np.int64)
            alone = np.ones(count, dtype=bool)
            for end in range(start + 1, length + 1):
                found, nodes = self._step(nodes, codes[rows, end - 1])
                rows, nodes = rows[found], nodes[found]
                if not len(rows):
                    break
                pieces = self.piece[nodes]
                is_piece = pieces >= 0
                if is_piece.any():
                    yield start, end, rows[is_piece], pieces[is_piece]
                    if end == start + 1:
                        alone[rows[is_piece]] = False
            rows = np.flatnonzero(alone)
            if len(rows):
                yield start, start + 1, rows, np.zeros(len(rows), dtype=np.int64)

    def log_probabilities(self, words, table):
        """Log probability of each word in each language; ``table`` has a row for each piece."""
        logs = np.empty((len(words), table.shape[1]))
        for places, codes in _by_length(words):
            forward = np.zeros((codes.shape[1] + 1, len(places), table.shape[1]))
            forward[0] = 1
            for start, end, rows, pieces in self.arcs(codes):
                forward[end, rows] += forward[start, rows] * table[pieces]
            logs[places] = np.log(forward[-1])
        return logs

    def expected_counts(self, words, languages, weights, table):
        """Expected uses of each piece in each language over weighted words."""
        uses = np.zeros(table.shape)
        for places, codes in _by_length(words):
            own, weight = languages[places], weights[places]
            arcs = list(self.arcs(codes))
            forward = np.zeros((codes.shape[1] + 1, len(places)))
            backward = np.zeros_like(forward)
            forward[0] = backward[-1] = 1
            for start, end, rows, pieces in arcs:
                forward[end, rows] += forward[start, rows] * table[pieces, own[rows]]
            for start, end, rows, pieces in reversed(arcs):
                backward[start, rows] += backward[end, rows] * table[pieces, own[rows]]
            for start, end, rows, pieces in arcs:
                share = forward[start, rows] * backward[end, rows] / forward[-1, rows]
                share *= table[pieces, own[rows]] * weight[rows]
                np.add.at(uses, (pieces, own[rows]), share)
        return uses


def _by_length(words):
    """Places and character codes, word mark first, of the words of each length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == length)
        joined = "".join([_MARK + words[i] for i in places.tolist()])
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        yield places, codes.astype(np.int64).reshape(len(places), length + 1)


# Training


def _count_words(batches):
    counts = Counter()
    for batch in batches:
        for language, text in zip(batch["language"], batch["text"]):
            for word, n in Counter(words_of(text)).items():
                counts[language, word] += n
            if len(counts) >= _COUNTED:
                yield _as_rows(counts)
                counts.clear()
    if counts:
        yield _as_rows(counts)


def _as_rows(counts):
    languages, words = zip(*counts)
    return pd.DataFrame({"language": languages, "word": words, "n": list(counts.values())})


def _expect(shared):
    def expect(batches):
        pieces, languages, table = shared.value
        lattice, number = Lattice(pieces), {name: i for i, name in enumerate(languages)}
        uses = np.zeros(table.shape)
        for batch in batches:
            own = batch["language"].map(number).to_numpy(np.int64)
            weights = batch["n"].to_numpy(np.float64)
            uses += lattice.expected_counts(batch["word"].tolist(), own, weights, table)
        piece, language = np.nonzero(uses)
        yield pd.DataFrame({"piece": piece, "language": language, "uses": uses[piece, language]})

    return expect


class Model:
    """Pieces, sorted languages and the table of piece probabilities."""

    def __init__(self, pieces, languages, table):
        self.pieces, self.languages, self.table = pieces, languages, table


def train(docs, pieces, language="lang", text="text", rounds=ROUNDS):
    """Learn piece probabilities from all rows that name a language.

    Rows with a null language or without letters teach nothing. The driver gets one number
    for each piece and language only. ``pieces`` is a vocabulary, id 0 the unknown piece.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(language).alias("language"), F.col(text).alias("text"))
    counts = stage.keep(
        rows.where("language IS NOT NULL AND text IS NOT NULL")
        .mapInPandas(_count_words, "language string, word string, n long")
        .groupBy("language", "word")
        .agg(F.sum("n").alias("n")),
        "language-words",
    )
    languages = sorted(r[0] for r in counts.select("language").distinct().collect())
    table = np.full((len(pieces), len(languages)), 1 / len(pieces))
    for _ in range(rounds if languages else 0):
        shared = spark.sparkContext.broadcast((pieces, languages, table))
        uses = np.zeros(table.shape)
        summed = (
            counts.mapInPandas(_expect(shared), "piece int, language int, uses double")
            .groupBy("piece", "language")
            .agg(F.sum("uses").alias("uses"))
            .toPandas()
        )
        uses[summed["piece"], summed["language"]] = summed["uses"]
        table = (1 - EVEN) * uses / uses.sum(axis=0) + EVEN / len(pieces)
    return Model(pieces, languages, table)


# Prediction


class _Scores:
    """Log probabilities of the words met so far, as rows of one array."""

    def __init__(self, model):
        self.model, self.lattice = model, Lattice(model.pieces)
        self.place, self.logs = {}, np.empty((0, len(model.languages)))

    def _learn(self, words):
        new = [word for word in words if word not in self.place]
        if len(self.place) + len(new) > _KEPT:
            self.place, new = {}, list(words)
            self.logs = np.empty((0, len(self.model.languages)))
        logs = self.lattice.log_probabilities(new, self.model.table)
        self.place.update(zip(new, range(len(self.logs), len(self.logs) + len(new))))
        self.logs = np.concatenate([self.logs, logs])

    def of(self, texts):
        """(language, score) for each of a few texts, given as lists of words."""
        self._learn(dict.fromkeys(chain.from_iterable(texts)))
        for words in texts:
            if not words or not self.model.languages:
                yield UNKNOWN, 0.0
                continue
            at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
            logs = self.logs[at].sum(axis=0)
            best = int(logs.argmax())
            yield self.model.languages[best], float(1 / np.exp(logs - logs[best]).sum())


_RESULT = T.StructType().add("lang_pred", T.StringType()).add("score", T.DoubleType())


def predict_column(spark, model, text):
    """Most likely language of each text and its posterior among the learnt ones."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(_RESULT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scores = _Scores(shared.value)
        for texts in batches:
            rows, waiting, size = [], [], 0
            for text in texts:
                waiting.append(words_of(text))
                size += len(waiting[-1])
                if size >= _SCORED:
                    rows += scores.of(waiting)
                    waiting, size = [], 0
            rows += scores.of(waiting)
            yield pd.DataFrame(rows, columns=_RESULT.names)

    return predict(text)


def identify_languages(docs, pieces, key="doc_id", language="lang", text="text"):
    """Key, ``held_out``, ``lang_pred`` and ``score`` of every row; other columns are left out.

    Rows whose key as text has crc32 modulo three equal to one are held out, all others with a
    language are learnt from; a null key counts as the empty text. A null text or one
    without letters is ``und`` with score 0, as is every text if there is nothing to learn
    from. Equal probabilities go to the first language in order.
    """
    held_out = crc_of_id(F.col(key)) % FOLDS == HELD_OUT
    model = train(docs.where(~held_out), pieces, language, text)
    result = free_name(docs, "found")
    rows = docs.select(
        key,
        held_out.alias("held_out"),
        predict_column(docs.sparkSession, model, F.col(text)).alias(result),
    )
    return rows.select(key, "held_out", f"{result}.*")
