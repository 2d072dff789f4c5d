"""Quality classifier by co-training of two views.

The content view sees how the text is written: which kinds of characters follow each other, and how
words and lines repeat. The metadata view sees language, source, length and the layout of the page.
Each view has a classifier; round by round each labels the unlabelled rows that it is
sure of for the other. Both are then calibrated on labelled rows kept aside, combined, and
score every document.
"""

import zlib
from collections.abc import Iterator
from itertools import groupby
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import free_name, settings
from tarmac.sources import stage

# Bounds of the rows that the classifiers are fitted on; all rows are scored.
LABELLED, UNLABELLED = 8_000, 8_000
ROUNDS = 3
SURE = 0.98
EXCHANGED = 500
PENALTY = 1.0
THRESHOLD = 0.5
# Rows whose features come to the driver at once.
PART_ROWS = 1024
_CALIBRATION = 5
_BUCKETS = 64
# Columns whose mean and scale are found at once.
_COLUMNS = 64

_MARKS = b".,!?'\"-:;|#$%&*()/"
_KINDS = 7 + len(_MARKS)


def _kind_of(byte):
    """Kind of a UTF-8 byte: lower case, upper case, digit, blank, line end, other, each mark."""
    if byte > 127 or 97 <= byte <= 122:
        return 0
    if 65 <= byte <= 90:
        return 1
    if 48 <= byte <= 57:
        return 2
    if byte in b" \t":
        return 3
    if byte in b"\r\n":
        return 4
    return 6 + _MARKS.index(byte) if byte in _MARKS else 5


_KIND = np.array([_kind_of(byte) for byte in range(256)], dtype=np.int64)


def _share(part, whole):
    return part / whole if whole else 0.0


def _compressed_size(data):
    """Length of the whole data compressed, a piece at a time."""
    packer = zlib.compressobj(1)
    view = memoryview(data)
    size = sum(len(packer.compress(view[at : at + 65536])) for at in range(0, len(data), 65536))
    return size + len(packer.flush())


def content_features(text):
    """Shares of neighbouring character kinds, and shares of repeats; 0 for a null text."""
    data = text.encode() if text else b""
    kinds = _KIND[np.frombuffer(data, np.uint8)]
    pairs = np.bincount(kinds[:-1] * _KINDS + kinds[1:], minlength=_KINDS**2)[: _KINDS**2]
    words, lines = data.split(), data.splitlines()
    repeats = [
        _share(len(set(words)), len(words)),
        _share(sum(map(eq, words, words[1:])), len(words)),
        _share(sum(map(eq, words, words[2:])), len(words)),
        _share(len(set(lines)), len(lines)),
        _share(len(data), len(words) + 1) / 10,
        _share(_compressed_size(data), len(data)),
    ]
    return np.concatenate([np.log1p(1000 * pairs / max(1, len(data))), repeats])


def metadata_features(text, language, source):
    """Hashed language and source, and length and layout by powers of two."""
    found = np.zeros(2 * _BUCKETS + 3 * 24)
    found[zlib.crc32(f"{language}".encode()) % _BUCKETS] = 1
    found[_BUCKETS + zlib.crc32(f"{source}".encode()) % _BUCKETS] = 1
    text = text or ""
    lines = text.count("\n") + 1
    for at, size in enumerate((len(text), lines, len(text) // lines)):
        found[2 * _BUCKETS + 24 * at + min(23, int(size).bit_length())] = 1
    return found


class Logistic:
    """Logistic regression with an L2 penalty, by Newton steps; scales its inputs.

    ``rows`` names the rows of ``x`` that take part, by default all. They are copied a few
    at a time only.
    """

    def fit(self, x, y, rows=slice(None), penalty=PENALTY, steps=12):
        self.mean, self.scale = np.empty(x.shape[1]), np.empty(x.shape[1])
        for at in range(0, x.shape[1], _COLUMNS):
            some = slice(at, at + _COLUMNS)
            part = x[:, some][rows]
            self.mean[some] = part.mean(axis=0, dtype=np.float64)
            self.scale[some] = np.mean(np.square(part), axis=0, dtype=np.float64)
        self.scale = np.sqrt(self.scale - self.mean**2 + 1e-12)
        self.scale[self.scale < 1e-4] = 1
        size = x.shape[1] + 1
        ridge = np.eye(size) * penalty
        ridge[-1, -1] = 1e-6
        self.weights = np.zeros(size)
        for _ in range(steps):
            gradient, curve = -ridge @ self.weights, ridge.copy()
            for at, part in _parts(x, rows):
                z = self._scaled(part)
                p = _sigmoid(z @ self.weights)
                gradient += z.T @ (y[at : at + 1024] - p)
                curve += (z * (p * (1 - p) + 1e-6)[:, None]).T @ z
            move = np.linalg.solve(curve, gradient)
            self.weights += move
            if np.abs(move).max() < 1e-4:
                break
        return self

    def _scaled(self, x):
        z = np.clip((x - self.mean) / self.scale, -10, 10)
        return np.column_stack([z, np.ones(len(z))])

    def logit(self, x, rows=slice(None)):
        parts = [self._scaled(part) @ self.weights for _, part in _parts(x, rows)]
        return np.concatenate([np.empty(0), *parts])


def _parts(x, rows):
    """The rows of ``x``, 1,024 at a time, each time with the number of those before."""
    numbers = np.arange(len(x))[rows]
    for at in range(0, len(numbers), 1024):
        yield at, x[numbers[at : at + 1024]]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class CoTraining:
    """The two classifiers, their calibration, and the mix of both."""

    def fit(self, views, labels, aside):
        """``views`` hold the features of each view, ``labels`` NaN for rows without; ``aside``
        marks the rows kept for calibration if they have a label."""
        has = ~np.isnan(labels)
        y = labels[has]
        fit, aside = np.flatnonzero(has & ~aside), np.flatnonzero(has & aside)
        own = [[fit], [fit]]
        marks = [[labels[fit]], [labels[fit]]]
        free = ~has
        self.views = [Logistic().fit(view, labels[fit], fit) for view in views]
        for _ in range(ROUNDS):
            for teacher, learner in ((0, 1), (1, 0)):
                at = np.flatnonzero(free)
                sure = _sigmoid(self.views[teacher].logit(views[teacher], at))
                # As many of each class as the labelled rows have.
                for label, p in ((1.0, sure), (0.0, 1 - sure)):
                    most = int(EXCHANGED * np.mean(y == label))
                    best = np.argsort(-p, kind="stable")[:most]
                    best = at[best[p[best] >= SURE]]
                    free[best] = False
                    own[learner].append(best)
                    marks[learner].append(np.full(len(best), label))
            self.views = [
                Logistic().fit(view, np.concatenate(m), np.concatenate(rows))
                for view, rows, m in zip(views, own, marks)
            ]
        self.calibrations = [
            Logistic().fit(model.logit(x, aside)[:, None], labels[aside])
            for model, x in zip(self.views, views)
        ]
        self.mix = Logistic().fit(self._calibrated(views, aside), labels[aside])
        return self

    def _calibrated(self, views, rows=slice(None)):
        return np.column_stack(
            [
                calibration.logit(model.logit(x, rows)[:, None])
                for model, calibration, x in zip(self.views, self.calibrations, views)
            ]
        )

    def scores(self, views):
        """Calibrated probabilities of the views and of their mix."""
        logits = self._calibrated(views)
        return np.column_stack([_sigmoid(logits), _sigmoid(self.mix.logit(logits))])


def _features(size):
    """Features, numbered in parts of ``size`` rows at most."""

    def features(batches):
        part = 0
        for batch in batches:
            for at in range(0, len(batch), size):
                some = batch[at : at + size]
                content = [content_features(t).astype("<f4").tobytes() for t in some["text"]]
                metadata = [
                    metadata_features(*row).astype("<f4").tobytes()
                    for row in zip(some["text"], some["language"], some["source"])
                ]
                yield pd.DataFrame(
                    {
                        "part": part,
                        "label": some["label"],
                        "key": some["key"],
                        "content": content,
                        "metadata": metadata,
                    }
                )
                part += 1

    return features


def _sampled(rows, most):
    """Features, labels and keys of the ``most`` rows of least key hash.

    The features are written first and come to the driver a part at a time, each straight into
    its place, so the driver holds them once and no job sends it more than a part.
    """
    spark = rows.sparkSession
    path = stage.new_stage_path(spark, "quality-sample")
    features = (
        rows.orderBy("key", "text")
        .limit(most)
        .mapInPandas(
            _features(PART_ROWS),
            "part int, label double, key long, content binary, metadata binary",
        )
    )
    # A file for each part, so a part is read without the others.
    with settings(spark, **{"spark.sql.files.maxRecordsPerFile": str(PART_ROWS)}):
        kept = stage.keep(features, "quality-sample", path=path)
    total, last = kept.agg(F.count("*"), F.max("part")).first()
    views, labels, keys, at = [], np.empty(total), np.empty(total, np.int64), 0
    for part in range(last + 1 if total else 0):
        table = kept.where(F.col("part") == part).toPandas()
        place = slice(at, at + len(table))
        labels[place], keys[place] = table["label"].to_numpy(dtype=float), table["key"]
        for n, name in enumerate(("content", "metadata")):
            found = np.frombuffer(b"".join(table.pop(name)), "<f4").reshape(len(table), -1)
            if part == 0:
                views.append(np.empty((total, found.shape[1]), "<f4"))
            views[n][place] = found
        at += len(table)
    stage.delete(spark, path)
    if not total:
        return [np.empty((0, 0), "<f4")] * 2, labels, keys
    order = _order(keys, views[0])
    if (order != np.arange(total)).any():
        for n in range(len(views)):
            views[n] = views[n][order]
    return views, labels[order], keys[order]


def _order(keys, content):
    """Order by key, that of equal keys by the bytes of the content."""
    found = []
    for _, run in groupby(np.argsort(keys, kind="stable").tolist(), keys.__getitem__):
        run = list(run)
        found += sorted(run, key=lambda at: content[at].tobytes()) if len(run) > 1 else run
    return np.array(found, np.int64)


def fit_quality(docs, labels, key="doc_id", text="text", language="lang", source="source"):
    """Fit on at most ``LABELLED`` labelled and ``UNLABELLED`` other rows.

    The rows are those of least key hash. Labels are joined by key; rows with a null key or label
    count as unlabelled, of several labels the least counts. None if there are not both
    classes among the rows to fit and to calibrate on.
    """
    known = labels.groupBy(F.col(key).alias("labelled_key")).agg(
        F.min(F.col("quality").cast("double")).alias("label")
    )
    order = F.xxhash64(F.col(key), F.lit("quality"))
    rows = docs.select(
        F.col(key).alias("row_key"),
        order.alias("key"),
        F.col(text).alias("text"),
        F.col(language).alias("language"),
        F.col(source).alias("source"),
    )
    # Only keys and labels take part in choosing; texts follow for the chosen rows.
    keys = rows.select("row_key", "key").join(known, F.col("row_key") == F.col("labelled_key"), "left")
    bound = LABELLED + UNLABELLED
    labelled = keys.where("label IS NOT NULL").orderBy("key").limit(LABELLED)
    others = keys.where("label IS NULL").orderBy("key").limit(UNLABELLED)
    chosen = labelled.union(others).select(F.col("row_key").alias("k"), "label").distinct()
    with_text = rows.join(F.broadcast(chosen), F.col("row_key").eqNullSafe(F.col("k")))
    views, marks, order = _sampled(with_text.select("label", "key", "text", "language", "source"), bound)
    has = ~np.isnan(marks)
    aside = order % _CALIBRATION == 0
    for part in (has & aside, has & ~aside):
        if len(np.unique(marks[part])) < 2:
            return None
    return CoTraining().fit(views, marks, aside)


_RESULT = (
    T.StructType()
    .add("content_score", T.DoubleType())
    .add("metadata_score", T.DoubleType())
    .add("score", T.DoubleType())
)


def quality_column(spark, model, text, language, source):
    """Struct of the scores of a row; all null if there is no model."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(_RESULT)
    def score(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        for columns in batches:
            rows = list(zip(*columns))
            scores = np.full((len(rows), 3), np.nan)
            for at in range(0, len(rows) if shared.value else 0, 512):
                part = rows[at : at + 512]
                views = [
                    np.array([content_features(row[0]) for row in part]),
                    np.array([metadata_features(*row) for row in part]),
                ]
                scores[at : at + 512] = shared.value.scores(views)
            yield pd.DataFrame(scores, columns=_RESULT.names)

    return score(text, language, source)


def _scored(docs, labels, key, text, language, source, output):
    model = fit_quality(docs, labels, key, text, language, source)
    column = quality_column(
        docs.sparkSession, model, F.col(text), F.col(language), F.col(source)
    )
    return docs.withColumn(output, column)


def _accepted(text, score):
    blank = ~F.coalesce(text, F.lit("")).rlike(r"\S")
    return ~blank & (score.isNull() | F.isnan(score) | (score >= THRESHOLD))


def quality_report(
    docs, labels, key="doc_id", text="text", language="lang", source="source"
):
    """Key, ``content_score``, ``metadata_score``, ``score`` and ``accepted`` of every row.

    Scores are probabilities of good quality; null or blank texts are never accepted. If the
    labels do not allow a model, the scores are null and every other row is accepted. Null
    languages and sources are values like any other. Repeated rows stay; other columns are
    left out.
    """
    found = free_name(docs, "found")
    rows = _scored(docs, labels, key, text, language, source, found)
    accepted = _accepted(F.col(text), F.col(f"{found}.score"))
    scores = [
        F.when(~F.isnan(F.col(f"{found}.{name}")), F.col(f"{found}.{name}")).alias(name)
        for name in _RESULT.names
    ]
    return rows.select(key, *scores, accepted.alias("accepted"))


def drop_low_quality(
    docs, labels, key="doc_id", text="text", language="lang", source="source"
):
    """The accepted rows, with their columns."""
    found = free_name(docs, "found")
    rows = _scored(docs, labels, key, text, language, source, found)
    return rows.where(_accepted(F.col(text), F.col(f"{found}.score"))).drop(found)
