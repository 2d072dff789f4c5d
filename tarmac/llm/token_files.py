"""Token ids in files of independently reset, checksummed blocks.

Rows are put in key order by a range shuffle, tokenised, and written as blocks: rows of Parquet files
with the keys and lengths of the block's documents, a crc32 of its ids, and the coded ids. A
block holds whole documents and needs no other block to be read.

The ids of a block are coded by an adaptive range coder. It mixes three predictions: the
frequencies of the block's ids so far (order 0), and for the last one and the last two ids
the id that followed them (orders 1 and 2). The weights of the mix follow how often each was right
at its present confidence. The block's ids are cut into lanes that are coded side by side as
arrays, each lane with its own coder and all with one model, which learns from all lanes after
each step.
"""

import json
import re
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.llm.common import shuffle_partitions
from tarmac.operators.joins import broadcast_if_small
from tarmac.sources import stage

BLOCK_IDS = 1 << 19
LANE_IDS = 128
END_ID = 1
_SHARE_BITS, _MIX_BITS = 16, 8
_TOTAL_BITS = _SHARE_BITS + _MIX_BITS
_TOTAL, _WORD, _ONE, _WIDE = (np.uint64(n) for n in (_TOTAL_BITS, 32, 1, 1 << 32))
_SLOT_BITS = 18
_SLOTS, _HASH_SHIFT = 1 << _SLOT_BITS, np.uint32(32 - _SLOT_BITS)
_SURE_BITS = 4
_SURE = (1 << _SURE_BITS) - 1
_RENEW = 8
# Text that is tokenised at once, and pieces that a worker knows.
_TEXT_BYTES = 8 << 20
_KNOWN = 500_000
# Characters that are not plain. Plain ones are neither combined nor split by normalization, and
# lower-casing gives plain ones again.
_OTHER = "[^!-~\u00a1-\u012f\u0131-\u017f]"
# Patterns that the regex module reads as the library does.
_PATTERNS = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",)


class _Model:
    """Predictions shared by the lanes of a block; coder and decoder run it alike.

    One table holds both orders, an entry being a follower and how sure it is. Arrays of two rows
    are the predictions of the one and the two last ids.
    """

    def __init__(self, symbols, lanes):
        self.counts = np.ones(symbols, dtype=np.int64)
        self.table = np.zeros(symbols + _SLOTS, dtype=np.int32)
        self.last = np.zeros(lanes, dtype=np.uint32)
        self.context = np.zeros((2, lanes), dtype=np.int64)
        self.context[1] = symbols
        self.right = np.zeros((3, (_SURE + 1) ** 2), dtype=np.int64)
        self.waiting, self.steps, self.due = [], 0, 1
        self._renew()

    def _renew(self):
        """Frequencies and weights from all that was seen."""
        symbols = len(self.counts)
        share = 1 + self.counts * ((1 << _SHARE_BITS) - symbols) // self.counts.sum()
        share[share.argmax()] += (1 << _SHARE_BITS) - share.sum()
        self.share = share.astype(np.int32)
        self.below = np.cumsum(self.share, dtype=np.int32) - self.share
        self._owner = None
        most = (1 << _MIX_BITS) - 16
        weights = most * (2 * self.right[1:] + 1) // (2 * self.right.sum(axis=0) + 4)
        self.masses = (weights << _SHARE_BITS).astype(np.int32)
        self.rests = ((1 << _MIX_BITS) - weights.sum(axis=0)).astype(np.int32)

    def predict(self):
        """Followers of the one and two last ids, with their weights in the mix."""
        self.entry = self.table.take(self.context)
        self.guess = self.entry >> _SURE_BITS
        self.sure = self.entry & _SURE
        self.class_ = (self.sure[0] << _SURE_BITS) + self.sure[1]
        self.mass = self.masses.take(self.class_, axis=1)
        self.rest = self.rests.take(self.class_)

    def range_of(self, symbols):
        """Start and width of each symbol in the mixed distribution."""
        self.hit = self.guess == symbols
        start = self.rest * self.below.take(symbols)
        width = self.rest * self.share.take(symbols)
        for guess, mass, hit in zip(self.guess, self.mass, self.hit):
            start += mass * (guess < symbols)
            width += mass * hit
        return start, width

    def symbol_at(self, value):
        """The symbol whose range holds each value."""
        if self._owner is None:
            self._owner = np.repeat(np.arange(len(self.share), dtype=np.int32), self.share)
        guess, other, mass = self.guess, self.guess[::-1], self.mass[::-1]
        start = self.rest * self.below.take(guess) + mass * (other < guess)
        end = start + self.rest * self.share.take(guess) + self.mass + mass * (other == guess)
        past = value >= end
        inside = (value >= start) & ~past
        plain = value - self.mass[0] * past[0] - self.mass[1] * past[1]
        found = self._owner.take(plain // self.rest, mode="clip")
        np.copyto(found, guess[0], where=inside[0])
        np.copyto(found, guess[1], where=inside[1])
        return found

    def learn(self, symbols):
        entry, sure, hit = self.entry, self.sure, self.hit
        missed = np.where(sure == 0, symbols << _SURE_BITS, entry - sure + (sure >> 1))
        self.table[self.context] = np.where(hit, entry + (sure < _SURE), missed)
        own = symbols.astype(np.uint32)
        mixed = own * np.uint32(0x9E3779B1) ^ self.last * np.uint32(0x85EBCA6B)
        self.context[0] = symbols
        self.context[1] = (mixed >> _HASH_SHIFT) + np.uint32(len(self.counts))
        self.last = own
        kind = np.where(hit[1], 2 << 2 * _SURE_BITS, hit[0].astype(np.int32) << 2 * _SURE_BITS)
        self.waiting.append((symbols, self.class_ + kind))
        self.steps += 1
        if self.steps == self.due:
            symbols, classes = map(np.concatenate, zip(*self.waiting))
            self.waiting, self.due = [], self.steps + max(1, self.steps // _RENEW)
            self.counts += 32 * np.bincount(symbols, minlength=len(self.counts))
            self.right += np.bincount(classes, minlength=self.right.size).reshape(3, -1)
            self._renew()


def _lanes(ids):
    return max(1, -(-len(ids) // LANE_IDS))


def _start(lanes):
    return np.zeros(lanes, np.uint64), np.full(lanes, np.iinfo(np.uint64).max, np.uint64)


def _narrow(low, width, part, start, size):
    low += part * start.astype(np.uint64)
    np.multiply(part, size.astype(np.uint64), out=width)


def _shift(low, width):
    """Lanes whose range is below a word, and their next words. A range across two words is cut to
    the lower one, so that the word is certain; the range is widened by a word."""
    go = np.flatnonzero(width < _WIDE)
    at, size = low.take(go), width.take(go)
    across = (at ^ (at + size - _ONE)) >= _WIDE
    size[across] = _WIDE - (at[across] & (_WIDE - _ONE))
    low[go] = at << _WORD
    width[go] = size << _WORD
    return go, at >> _WORD


def encode_block(ids):
    """Bytes from which ``decode_block`` makes the ids again; at most 65,536 different ids."""
    ids = np.asarray(ids, dtype=np.int64)
    lanes = _lanes(ids)
    steps = -(-len(ids) // lanes)
    seen = np.bincount(ids) if len(ids) else ids
    alphabet = np.flatnonzero(seen)
    head = np.array([len(ids), len(alphabet)], "<u4").tobytes()
    head += zlib.compress(np.diff(alphabet, prepend=0).astype("<u4").tobytes())
    if not len(ids):
        return np.array([len(head)], "<u4").tobytes() + head
    padded = np.zeros(lanes * steps, dtype=np.int32)
    if len(alphabet) > 1 << _SHARE_BITS:
        raise ValueError(f"{len(alphabet)} different ids in a block, at most {1 << _SHARE_BITS}")
    place = np.zeros(alphabet[-1] + 1, dtype=np.int32)
    place[alphabet] = np.arange(len(alphabet))
    padded[: len(ids)] = place[ids]
    columns = np.ascontiguousarray(padded.reshape(lanes, steps).T)
    model = _Model(len(alphabet), lanes)
    low, width = _start(lanes)
    out_lanes, out_words = [], []
    for column in columns:
        model.predict()
        _narrow(low, width, width >> _TOTAL, *model.range_of(column))
        go, words = _shift(low, width)
        out_lanes.append(go)
        out_words.append(words.astype("<u4"))
        model.learn(column)
    # The first word that begins inside the range; zeros may follow it.
    out_lanes.append(np.arange(lanes))
    out_words.append((low + (_WIDE - _ONE) >> _WORD).astype("<u4"))
    order = np.concatenate(out_lanes)
    order = order.astype(np.uint16) if lanes <= 1 << 16 else order
    words = np.concatenate(out_words)[np.argsort(order, kind="stable")]
    sizes = np.bincount(order, minlength=lanes).astype("<u4")
    parts = [head, zlib.compress(sizes.tobytes()), words.tobytes()]
    return np.array([len(p) for p in parts[:2]], "<u4").tobytes() + b"".join(parts)


def decode_block(data):
    head = int(np.frombuffer(data, "<u4", 1)[0])
    at = 4 if len(data) == 4 + head else 8
    total, symbols = np.frombuffer(data, "<u4", 2, at).tolist()
    if not total:
        return np.empty(0, dtype=np.int64)
    gaps = np.frombuffer(zlib.decompress(data[at + 8 : at + head]), "<u4")
    alphabet = np.cumsum(gaps.astype(np.int64))
    size = int(np.frombuffer(data, "<u4", 1, 4)[0])
    at += head
    sizes = np.frombuffer(zlib.decompress(data[at : at + size]), "<u4").astype(np.int64)
    words = np.frombuffer(data, "<u4", offset=at + size).astype(np.uint64)
    lanes = len(sizes)
    end = np.cumsum(sizes)
    place = end - sizes

    def read(go):
        """The next words of lanes, zero behind their last."""
        at = place[go]
        place[go] += 1
        return np.where(at < end[go], words.take(at, mode="clip"), np.uint64(0))

    every = np.arange(lanes)
    code = read(every) << _WORD | read(every)
    model = _Model(symbols, lanes)
    low, width = _start(lanes)
    columns = []
    for _ in range(-(-total // lanes)):
        model.predict()
        part = width >> _TOTAL
        value = np.minimum((code - low) // part, np.uint64((1 << _TOTAL_BITS) - 1))
        column = model.symbol_at(value.astype(np.int32))
        _narrow(low, width, part, *model.range_of(column))
        go, _ = _shift(low, width)
        code[go] = code[go] << _WORD | read(go)
        model.learn(column)
        columns.append(column)
    return alphabet[np.stack(columns, axis=1).reshape(-1)[:total]]


# Tokenising


def _byte_letters():
    """Letters by which byte-level vocabularies write the bytes that do not stand for themselves;
    a space stays one."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [n for n in range(256) if n not in shown]
    return {n: chr(256 + i) for i, n in enumerate(rest) if n != ord(" ")}


def _plain_pattern(source):
    """The pattern that cuts lower-cased plain words into the pieces that the model encodes; None
    if the tokenizer takes other steps than these."""
    steps = [
        {"type": "NFC"},
        {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
        {"type": "Lowercase"},
    ]
    before = (source.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
    split, letters = before if len(before) == 2 else ({}, {})
    pattern = split.get("pattern", {}).get("Regex")
    known = (
        source.get("normalizer") == {"type": "Sequence", "normalizers": steps}
        and split.get("type") == "Split"
        and split.get("behavior") == "Removed"
        and split.get("invert") is True
        and pattern in _PATTERNS
        and letters.get("type") == "ByteLevel"
        and not letters.get("add_prefix_space")
        and letters.get("use_regex") is False
        and source["model"].get("type") == "BPE"
        and source["model"].get("end_of_word_suffix")
        and not source["model"].get("dropout")
        and not any(source.get(k) for k in ("truncation", "padding", "post_processor"))
        and not any(
            t["normalized"] or t["content"].isalpha() for t in source.get("added_tokens", [])
        )
    )
    return pattern if known else None


class WordTokens:
    """Ids of texts by a tokenizer for which white space ends every token.

    The different words of a batch are cut into pieces as the tokenizer does, and its model encodes
    each different piece once; the ids are kept, packed. That holds for plain words, of characters
    whose normalization is lower-casing. Other words are pieces that the whole tokenizer encodes.
    """

    def __init__(self, tokenizer):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer)
        source = json.loads(tokenizer)
        self.pattern = _plain_pattern(source)
        if self.pattern:
            self.find = regex.compile(rf"{self.pattern}|\n").findall
            marks = [re.escape(t["content"]) for t in source.get("added_tokens", [])]
            self.other = "|".join([_OTHER, *(f"(?i:{mark})" for mark in marks)])
            self.pieces = Tokenizer(self.tokenizer.model)
            self.pieces.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            suffix = source["model"]["end_of_word_suffix"]
            vocab = source["model"]["vocab"]
            self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
            self.ends[[n for token, n in vocab.items() if token.endswith(suffix)]] = True
            self.letters = _byte_letters()
        self.known = {"": b""}

    def __call__(self, texts):
        """Ids of an Arrow array of texts, one after the other, and how many each text has."""
        words = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        different = words.flatten().dictionary_encode()
        cut = different.dictionary
        if self.pattern:
            plain = pc.invert(pc.match_substring_regex(cut, self.other))
            cut = pc.if_else(plain, pc.utf8_lower(cut), cut)
            some = pc.and_not(plain, pc.utf8_is_alpha(cut))
            cut = pc.replace_with_mask(cut, some, self._cut(cut.filter(some)))
        cut = pc.ascii_split_whitespace(cut)
        ids, sizes = _gather(*self._encode(cut.flatten().dictionary_encode()))
        ids, sizes = _gather(ids, _sums(sizes, cut), different.indices)
        return ids, _sums(sizes, words)

    def _cut(self, words):
        """Plain words with spaces between their pieces, by one search through all of them."""
        found = self.find("\n".join([*words.to_numpy(zero_copy_only=False), ""]))
        return pa.array(" ".join(found).split("\n")[: len(words)], words.type)

    def _encode(self, pieces):
        names = pieces.dictionary.to_numpy(zero_copy_only=False)
        new = np.array([name not in self.known for name in names], dtype=bool)
        if len(self.known) + new.sum() > _KNOWN:
            self.known, new = {"": b""}, names != ""
        plain = new & False
        if self.pattern:
            other = pc.match_substring_regex(pieces.dictionary, self.other)
            plain = new & ~other.to_numpy(zero_copy_only=False)
        self._learn(names[plain])
        for name in names[new & ~plain]:
            self.known[name] = _packed(self.tokenizer.encode(name, add_special_tokens=False).ids)
        packed = [self.known[name] for name in names]
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        return np.frombuffer(b"".join(packed), np.int32), sizes, pieces.indices

    def _learn(self, pieces):
        """Many pieces go to the model at once; the last token of each says that it ends one."""
        for at in range(0, len(pieces), 256):
            some = pieces[at : at + 256]
            found = self._ids_of(some)
            ends = np.flatnonzero(self.ends[found]) + 1
            if len(ends) == len(some):
                parts = [found[a:b] for a, b in zip([0, *ends], ends)]
            else:
                parts = [self._ids_of([piece]) for piece in some]
            self.known.update(zip(some, [part.tobytes() for part in parts]))

    def _ids_of(self, pieces):
        text = " ".join([piece if piece.isascii() else self._shown(piece) for piece in pieces])
        found = self.pieces.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found[0].ids, dtype=np.int32)

    def _shown(self, piece):
        return piece.encode().decode("latin-1").translate(self.letters)


def _packed(ids):
    return array("i", ids).tobytes()


def _gather(ids, sizes, at):
    """The runs of ids at the places of an Arrow array, one after the other, and their sizes."""
    at, begins = at.to_numpy(), np.cumsum(sizes) - sizes
    begins, sizes = begins[at], sizes[at]
    ends = np.cumsum(sizes)
    places = np.repeat(begins - ends + sizes, sizes) + np.arange(sizes.sum())
    return ids[places], sizes


def _sums(sizes, lists):
    """Sums of the sizes in each list of an Arrow array."""
    offsets = lists.offsets.to_numpy()
    return np.diff(np.append(0, np.cumsum(sizes))[offsets - offsets[0]])


_held = {}


def _tokens(shared):
    """This worker's tokenizer, kept with the words it knows for all tasks that use it."""
    if _held.get("source") is not shared.value:
        _held.clear()
        _held.update(source=shared.value, tokens=WordTokens(shared.value))
    return _held["tokens"]


def _parts(batch):
    """Rows of some megabytes of text."""
    size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    number = np.cumsum(size, dtype=np.int64) // _TEXT_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), batch.num_rows]
    return [batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:]) if a < b]


def _write_blocks(shared, end):
    def write(batches):
        tokens = _tokens(shared)
        part, made, keys, lengths, held, size = TaskContext.get().partitionId(), 0, [], [], [], 0
        for batch in batches:
            for rows in _parts(batch):
                ids, sizes = tokens(rows.column("text"))
                # Each document's ids, then ``end``.
                ids = np.insert(ids, np.cumsum(sizes), np.int32(end))
                ends = np.cumsum(sizes + 1)
                done = begin = 0
                # Blocks are full with the document that makes them so.
                while done < len(ends):
                    last = int(np.searchsorted(ends, begin + BLOCK_IDS - size))
                    full, last = last < len(ends), min(last + 1, len(ends))
                    keys.append(rows.column("key").slice(done, last - done))
                    lengths.append(sizes[done:last] + 1)
                    held.append(ids[begin : ends[last - 1]])
                    size += len(held[-1])
                    done, begin = last, int(ends[last - 1])
                    if full:
                        yield _block(part, made, keys, lengths, held)
                        made, keys, lengths, held, size = made + 1, [], [], [], 0
        if keys:
            yield _block(part, made, keys, lengths, held)

    return write


def _block(part, number, keys, lengths, held):
    ids, keys = np.concatenate(held), pa.concat_arrays(keys)
    columns = {
        "part": pa.array([part], pa.int32()),
        "block": pa.array([number], pa.int32()),
        "keys": pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
        "lengths": pa.array([np.concatenate(lengths)], pa.list_(pa.int32())),
        "n_ids": pa.array([len(ids)], pa.int64()),
        "ids_crc32": pa.array([zlib.crc32(ids.astype("<u4").tobytes())], pa.int64()),
        "coded": pa.array([encode_block(ids)], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


def write_token_files(docs, path, tokenizer, key="doc_id", text="text", end=END_ID):
    """Write the ids of every whole text, each followed by ``end``, in ascending key order.

    ``tokenizer`` is the text of a tokenizer file. A null text is empty; null keys come
    first; rows of equal keys are ordered by their texts. An empty table gives files without
    blocks. Files and blocks are numbered in order.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tokenizer)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(
        F.col(key).alias("key"),
        F.crc32(F.col(text).cast("binary")).alias("tie"),
        F.col(text).alias("text"),
    )
    ordered = rows.repartitionByRange(shuffle_partitions(spark), "key", "tie")
    ordered.sortWithinPartitions("key", "tie", "text").select("key", "text").mapInArrow(
        _write_blocks(shared, end),
        f"part int, block int, keys array<{kind}>, lengths array<int>, n_ids long, "
        "ids_crc32 long, coded binary",
    ).write.option("compression", "none").parquet(path)


# Documents that the reader hands on at once.
_READ_ROWS = 512


def _read_blocks(batches):
    for batch in batches:
        for row in batch.itertuples(index=False):
            damage = ValueError(f"block {row.block} of part {row.part} is damaged")
            try:
                ids = decode_block(row.coded).astype("<u4")
            except (IndexError, ValueError, zlib.error) as error:
                raise damage from error
            if zlib.crc32(ids.tobytes()) != row.ids_crc32:
                raise damage
            ends = np.cumsum(row.lengths, dtype=np.int64)
            begins = ends - row.lengths
            for at in range(0, len(ends), _READ_ROWS):
                some = slice(at, at + _READ_ROWS)
                yield pd.DataFrame(
                    {
                        "key": list(row.keys[some]),
                        "start": row.start + begins[some],
                        "ids": [ids[a:b].tobytes() for a, b in zip(begins[some], ends[some])],
                    }
                )


def read_token_files(spark, path, key="doc_id"):
    """Key, ``start`` (ids of all documents before it) and ``ids`` (little-endian unsigned
    32-bit integers) of every document in the files. A damaged block fails the job.

    Blocks learn where they start before they are decoded, so coded blocks are all that a join
    with many of them moves.
    """
    blocks = spark.read.parquet(path)
    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    sizes = blocks.select("part", "block", "n_ids")
    # One row for each file, then one for each block of a file.
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("of_part"))
    earlier = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "part", "block", F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("of_block")
    ).join(parts, "part")
    starts = starts.select("part", "block", (F.col("of_part") + F.col("of_block")).alias("start"))
    placed = blocks.join(broadcast_if_small(starts)[0], ["part", "block"])
    return placed.select(
        "part", "block", "keys", "lengths", "ids_crc32", "coded", "start"
    ).mapInPandas(_read_blocks, f"key {kind}, start long, ids binary").withColumnRenamed("key", key)


def token_files(docs, tokenizer, key="doc_id", text="text", end=END_ID):
    """Write the ids of all documents to files and return what is read back from them."""
    spark = docs.sparkSession
    path = stage.new_stage_path(spark, "token-files")
    write_token_files(docs, path, tokenizer, key, text, end)
    return read_token_files(spark, path, key)
