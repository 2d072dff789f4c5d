"""Benchmark contamination by Wu-Manber search over words.

The patterns are the word windows of the benchmark. For the patterns of one length, a table
gives for each block of two words how far the search may skip; where it may not, the
block's bucket holds the windows that end in it, by their first block, and whole windows
are compared directly. Clean text is read at about every twelfth word.
"""

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from tarmac.llm.common import free_name
from tarmac.operators.joins import measured_bytes

WINDOW = 13
BLOCK = 2
# Uncompressed bytes of benchmark items searched for in one pass.
PASS_BYTES = 8 * 1024 * 1024

# Letters, digits and all bytes beyond ASCII make words; A-Z is lower-cased.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
    for c in range(256)
)

SPANS = "array<array<long>>"
RESULT = f"n_words long, n_hit long, items array<string>, spans {SPANS}"


def words_of(text):
    """Words of a text as UTF-8 bytes; a null text has none."""
    return text.encode().translate(_WORD_BYTES).split() if text else []


def windows_of(words, size=WINDOW):
    """Every run of ``size`` words, or the item whole if it is shorter."""
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


class WuManber:
    """Finds patterns that all have the same number of words."""

    def __init__(self, length, patterns):
        self.length, self.block = length, min(BLOCK, length)
        self.far = length - self.block + 1
        self.shift = {}
        self.buckets = defaultdict(lambda: defaultdict(list))
        for pattern, owners in patterns.items():
            for end in range(self.block, length + 1):
                key = pattern[end - self.block : end]
                self.shift[key] = min(self.shift.get(key, self.far), length - end)
            bucket = self.buckets[pattern[length - self.block :]]
            bucket[pattern[: self.block]].append((list(pattern), owners))

    def find(self, words):
        """(first word, owners) of every occurrence."""
        shift, far, block, length = self.shift.get, self.far, self.block, self.length
        end, total = length, len(words)
        while end <= total:
            suffix = tuple(words[end - block : end])
            skip = shift(suffix, far)
            if skip:
                end += skip
                continue
            first = end - length
            for pattern, owners in self.buckets[suffix].get(
                tuple(words[first : first + block]), ()
            ):
                if words[first:end] == pattern:
                    yield first, owners
            end += 1


class WindowSearch:
    """Wu-Manber tables for the windows of benchmark items, one for each window length."""

    def __init__(self, items, size=WINDOW):
        by_length = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            for window in windows_of(words_of(text), size):
                by_length[len(window)][window].add(item)
        self.searches = [WuManber(length, found) for length, found in sorted(by_length.items())]

    def search(self, words):
        """Merged word ranges inside occurrences, and the items that occur."""
        ranges, items = [], set()
        for search in self.searches:
            for first, owners in search.find(words):
                last = first + search.length - 1
                if ranges and ranges[-1][0] <= first <= ranges[-1][1] + 1:
                    ranges[-1][1] = max(ranges[-1][1], last)
                else:
                    ranges.append([first, last])
                items |= owners
        return merge_ranges(ranges), items


def merge_ranges(ranges):
    merged = []
    for first, last in sorted(ranges):
        if merged and first <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], last)
        else:
            merged.append([first, last])
    return merged


def _pass_over(shared, size):
    @F.pandas_udf(RESULT)
    def search(
        batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]],
    ) -> Iterator[pd.DataFrame]:
        tables = WindowSearch(shared.value, size)
        for texts, old_items, old_spans in batches:
            rows = []
            for text, before, spans in zip(texts, old_items, old_spans):
                words = words_of(text)
                ranges, items = tables.search(words)
                if before is not None:
                    ranges = merge_ranges(ranges + [list(span) for span in spans])
                    items |= set(before)
                hit = sum(last - first + 1 for first, last in ranges)
                rows.append((len(words), hit, sorted(items), ranges))
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "spans"])

    return search


def mark_contamination(docs, benchmark, output, text="text", item="item_id", size=WINDOW):
    """Add a struct column ``output`` on the benchmark windows in each whole text.

    Its fields: ``n_words``, ``n_hit`` (words inside any occurrence of a window), ``items``
    (ids as text of the items with occurring windows, sorted) and ``spans`` (word ranges).
    A window has ``size`` words; a shorter item is one window. A null text has no words.
    Items with a null id or without words take no part; repeated items count once. An
    empty benchmark hits nothing. ``output`` must not be a column of ``docs``.

    The benchmark is measured: what exceeds ``PASS_BYTES`` is searched for in several
    passes, each with its own table, so no table grows with the benchmark.
    """
    spark = docs.sparkSession
    items = benchmark.select(
        F.col(item).cast("string").alias("item"), F.col(text).alias("body")
    ).where("item IS NOT NULL AND body IS NOT NULL")
    passes = max(1, -(-measured_bytes(items)[0] // PASS_BYTES))
    items = items.withColumn("part", F.pmod(F.xxhash64("item", "body"), F.lit(passes)))
    marked = docs
    items_before, spans_before = (F.lit(None).cast(t) for t in ("array<string>", SPANS))
    for part in range(passes):
        found = items.where(F.col("part") == part).select("item", "body").distinct().collect()
        shared = spark.sparkContext.broadcast([tuple(row) for row in found])
        if part:
            marked = marked.checkpoint()
            items_before, spans_before = F.col(f"{output}.items"), F.col(f"{output}.spans")
        search = _pass_over(shared, size)
        marked = marked.withColumn(output, search(F.col(text), items_before, spans_before))
    return marked


def is_contaminated(n_words, n_hit):
    """At least a twentieth of the words is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def contamination_report(docs, benchmark, key="doc_id", text="text"):
    """Key, ``n_words``, ``n_hit``, ``items``, ``spans`` and ``contaminated`` of every row."""
    result = free_name(docs, "found")
    marked = mark_contamination(docs, benchmark, result, text)
    return marked.select(key, f"{result}.*").withColumn(
        "contaminated", is_contaminated(F.col("n_words"), F.col("n_hit"))
    )


def drop_contaminated(docs, benchmark, text="text"):
    """The rows that are not contaminated, with their columns."""
    result = free_name(docs, "found")
    marked = mark_contamination(docs, benchmark, result, text)
    bad = is_contaminated(F.col(f"{result}.n_words"), F.col(f"{result}.n_hit"))
    return marked.where(~bad).drop(result)
