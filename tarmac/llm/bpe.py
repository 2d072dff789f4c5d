"""Byte-level BPE as a lazily determinised finite-state transducer, and its decoder.

A sequence of tokens is what the merges give exactly if each neighbouring pair is: two tokens may
stand side by side unless some merge would have joined across their border. So the
encoding is the one path through a nondeterministic transducer whose states are (last
token, place in the token trie). Sets of such states, with the output not yet common to all
paths, are the states of the deterministic transducer; they are made when first reached
and kept. A token goes out as soon as all live paths agree on it, at most one longest token
behind the input, so time is linear in any text.

Decoding runs tokens through a UTF-8 state machine whose state is the unfinished character.
"""

import base64
import gc
import struct
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import functions as F

from tarmac.llm.common import free_name

# Entries of the caches of a worker. A full cache starts anew; of pieces, the last used stay.
PIECES = 200_000
MOVES = 300_000
PAIRS = 250_000
# Bytes at the start of a piece whose moves are kept as one.
HEAD = 4
# Rows that are encoded, and handed on, at once.
ROWS = 256
_WHOLE = float("inf")


def read_ranks(path):
    """Ranks by token from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Merges:
    """Which tokens can stand side by side, from the ranks alone."""

    def __init__(self, ranks, halves=None):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.halves = {} if halves is None else halves
        self.pairs, self.width = {}, max(ranks.values(), default=0) + 1

    def merge(self, data, below=_WHOLE):
        """Tokens of a short byte string by the merges of lower rank than ``below``."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranked = [self.ranks.get(a + b, _WHOLE) for a, b in zip(parts, parts[1:])]
            best = min(ranked)
            if best >= below:
                break
            at = ranked.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[part] for part in parts]

    def split(self, token):
        """The two tokens whose merge makes this one; None for a byte or an unreachable token."""
        if token not in self.halves:
            data = self.tokens[token]
            parts = self.merge(data, token) if len(data) > 1 else []
            self.halves[token] = tuple(parts) if len(parts) == 2 else None
        return self.halves[token]

    def reachable(self, token):
        return len(self.tokens[token]) == 1 or self.split(token) is not None

    def adjacent(self, left, right):
        key = left * self.width + right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._adjacent(left, right)
        return known

    def _adjacent(self, left, right):
        """Undo the merges at the border, latest first, looking for one that would cross it.

        ``left_until`` and ``right_until`` are the merges that used the border tokens up.
        Of equal merges the leftmost comes first, so the crossing one loses only to the left.
        """
        left_until = right_until = _WHOLE
        while True:
            crossing = self.ranks.get(self.tokens[left] + self.tokens[right], _WHOLE)
            if crossing < left_until and crossing <= right_until and crossing != _WHOLE:
                return False
            left_parts, right_parts = self.split(left), self.split(right)
            if left_parts and (not right_parts or left > right):
                left_until, left = left, left_parts[1]
            elif right_parts:
                right_until, right = right, right_parts[0]
            else:
                return True


def _pack(ids):
    """Ids as little-endian unsigned 32-bit integers in one binary value."""
    return struct.pack(f"<{len(ids)}I", *ids)


def _unpack(data):
    return list(struct.unpack(f"<{len(data) // 4}I", data))


class Transducer:
    """Encodes byte strings; states and moves appear as texts need them."""

    def __init__(self, ranks, halves=None):
        self.merges = Merges(ranks, halves)
        self.ranks = ranks
        child, token_at = {}, {}
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                node = child.setdefault(byte << 32 | node, len(child) + 1)
            if self.merges.reachable(rank):
                token_at[node] = rank
        # The next node, 0 where the trie ends and no path inside it lives on, and the token there.
        inner = {key & 0xFFFFFFFF for key in child}
        self.steps = {
            key: (node if node in inner else 0, token_at.get(node)) for key, node in child.items()
        }
        # The state and the output after the first bytes of a piece.
        self.moves, self.heads = {}, {}
        self._reset()

    def _reset(self):
        """Only the start state, which has number 0."""
        self.numbers, self.paths = {}, []
        self.moves.clear()
        self.heads.clear()
        self._state(((None, 0, ()),))

    def _state(self, paths):
        number = self.numbers.get(paths)
        if number is None:
            number = self.numbers[paths] = len(self.paths)
            self.paths.append(paths)
        return number

    def _move(self, state, byte):
        """The number of the next state and the output; a full table starts anew from ``state``."""
        before = self.paths[state]
        if len(self.moves) >= MOVES:
            self._reset()
            state = self._state(before)
        paths, whole = [], None
        step, merges = self.steps.get, self.merges
        known, width, byte = merges.pairs.get, merges.width, byte << 32
        for last, node, out in before:
            found = step(byte | node)
            if found is None:
                continue
            node, token = found
            if node:
                paths.append((last, node, out))
            # The bytes so far have one sequence of tokens only.
            if token is not None and whole is None:
                if last is None:
                    beside = True
                else:
                    beside = known(last * width + token)
                    if beside is None:
                        beside = merges.adjacent(last, token)
                if beside:
                    whole = (token, 0, (*out, token))
        if whole:
            paths.append(whole)
        agreed = ()
        if len(paths) == 1:
            last, node, agreed = paths[0]
            if agreed:
                paths = [(last, node, ())]
        else:
            outs = [out for _, _, out in paths]
            # What the first and the last output in order have in common, all have.
            first, final = min(outs), max(outs)
            if first and first[0] == final[0]:
                size = 1
                while size < len(first) and first[size] == final[size]:
                    size += 1
                agreed = first[:size]
                paths = [(last, node, out[size:]) for last, node, out in paths]
        move = self.moves[byte | state] = (self._state(tuple(paths)), agreed)
        return move

    def encode(self, piece):
        """Ranks of one piece, as the merges give them; a piece that is a token is itself."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        known, head = self.moves.get, piece[:HEAD]
        begun = self.heads.get(head)
        if begun is None:
            state, ids = 0, ()
            for byte in head:
                state, out = known(byte << 32 | state) or self._move(state, byte)
                ids += out
            begun = self.heads[head] = state, ids
        state, ids = begun[0], [*begun[1]]
        for byte in piece[HEAD:]:
            state, out = known(byte << 32 | state) or self._move(state, byte)
            if out:
                ids += out
        for _, node, out in self.paths[state]:
            if node == 0:
                ids += out
                break
        return tuple(ids)


class Encoder(dict):
    """Ids of whole texts; maps the pieces used last to their packed ids."""

    def __init__(self, ranks, pattern, halves=None):
        self.transducer = Transducer(ranks, halves)
        self.pieces = regex.compile(pattern).findall
        self.older = {}

    def __missing__(self, piece):
        if len(self) >= PIECES:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(piece)
        if ids is None:
            ids = _pack(self.transducer.encode(piece.encode()))
        self[piece] = ids
        return ids

    def packed(self, text):
        """Ids of a text as little-endian unsigned 32-bit integers; none for a null text."""
        return b"".join(map(self.__getitem__, self.pieces(text))) if text else b""

    def encode(self, text):
        """Ids of a text; none for a null text."""
        return _unpack(self.packed(text))


# Decoding

_REPLACEMENT = "\N{REPLACEMENT CHARACTER}"


def _continues(pending, byte):
    """Whether a byte can follow the bytes of an unfinished character."""
    low, high = 0x80, 0xBF
    if len(pending) == 1:
        first = pending[0]
        low = 0xA0 if first == 0xE0 else 0x90 if first == 0xF0 else low
        high = 0x9F if first == 0xED else 0x8F if first == 0xF4 else high
    return low <= byte <= high


def _length(first):
    """Bytes of the character that a byte begins; 0 if it begins none."""
    if first < 0x80:
        return 1
    if 0xC2 <= first <= 0xDF:
        return 2
    if 0xE0 <= first <= 0xEF:
        return 3
    return 4 if 0xF0 <= first <= 0xF4 else 0


class Decoder:
    """Texts of ids. Bytes that are no UTF-8 become replacement characters.

    The machine's state is the bytes of the unfinished character, of which there are few
    enough to keep a table of moves by token for each. Where no character is unfinished, a token
    of whole characters is its text.
    """

    def __init__(self, ranks):
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.whole = {}
        for rank, token in self.tokens.items():
            try:
                self.whole[rank] = token.decode()
            except UnicodeDecodeError:
                pass
        self._reset()

    def _reset(self):
        self.states = {}
        self.known = 0
        self.start = self._state(b"")

    def _state(self, pending):
        return self.states.setdefault(pending, (pending, {}))

    def _move(self, state, token):
        if self.known >= PIECES:
            self._reset()
        text, unfinished = [], state[0]
        for byte in self.tokens[token]:
            if unfinished and not _continues(unfinished, byte):
                text.append(_REPLACEMENT)
                unfinished = b""
            if not unfinished and not _length(byte):
                text.append(_REPLACEMENT)
                continue
            unfinished += bytes((byte,))
            if len(unfinished) == _length(unfinished[0]):
                text.append(unfinished.decode())
                unfinished = b""
        self.known += 1
        move = state[1][token] = "".join(text), self._state(unfinished)
        return move

    def stream(self, ids):
        """Text of each token: only characters that are complete after it."""
        state = self.start
        for token in ids:
            text, state = state[1].get(token) or self._move(state, token)
            yield text
        if state[0]:
            yield _REPLACEMENT

    def decode(self, ids):
        """The text of all ids; the machine runs from tokens of broken characters on, until none
        is unfinished.
        """
        texts = list(map(self.whole.get, ids))
        broken = [i for i, text in enumerate(texts) if text is None] if None in texts else ()
        at = 0
        for first in broken:
            if first < at:
                continue
            at, state = first, self.start
            while at < len(ids):
                text, state = state[1].get(ids[at]) or self._move(state, ids[at])
                texts[at] = text
                at += 1
                if not state[0]:
                    break
            else:
                texts.append(_REPLACEMENT)
        return "".join(texts)


# Columns




def _share(spark, ranks):
    """The vocabulary and the halves of its tokens, sent to every executor."""
    merges = Merges(ranks)
    for token in merges.tokens:
        merges.split(token)
    return spark.sparkContext.broadcast((ranks, merges.halves))


def _frozen(batches, convert):
    """Convert each batch; the long-lived objects of the tables are kept from the collector.

    It does not run within a batch either, whose many new states would have it look through
    all of them again and again; no table refers back to what refers to it.
    """
    try:
        for batch in batches:
            gc.disable()
            done = convert(batch)
            gc.enable()
            yield done
            gc.freeze()
    finally:
        gc.enable()
        gc.unfreeze()


def _slices(batches):
    """A few rows of each batch at a time, so that results are never held for a whole batch."""
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield batch.iloc[at : at + ROWS]


_held = {}


def _tools(shared, pattern):
    """This worker's encoder and decoder, kept for all tasks it runs with one vocabulary.

    Their caches are bounded, and what the texts of one task have taught them serves the next.
    """
    vocabulary = shared.value
    if _held.get("vocabulary") is not vocabulary or _held["pattern"] != pattern:
        # Nothing in the tables refers back, so those of an earlier vocabulary go at once.
        _held.clear()
        ranks, halves = vocabulary
        _held.update(vocabulary=vocabulary, pattern=pattern)
        _held.update(encoder=Encoder(ranks, pattern, halves), decoder=Decoder(ranks))
    return _held["encoder"], _held["decoder"]


def encode_column(spark, text, ranks, pattern):
    """Ids of each text as little-endian unsigned 32-bit integers in one binary value."""
    shared = _share(spark, ranks)

    @F.pandas_udf("binary")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder, _ = _tools(shared, pattern)
        return _frozen(
            _slices(batches), lambda texts: pd.Series([encoder.packed(t) for t in texts])
        )

    return encode(text)


def decode_column(spark, ids, ranks):
    """Text of each binary value of ids; null has no ids."""
    shared = spark.sparkContext.broadcast(ranks)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decoder = Decoder(shared.value)
        for packed in _slices(batches):
            yield pd.Series([decoder.decode(_unpack(p or b"")) for p in packed])

    return decode(ids)


def round_trip_column(spark, text, ranks, pattern):
    """Packed ids of each text and the text decoded from them, by one worker a task."""
    shared = _share(spark, ranks)

    @F.pandas_udf("ids binary, decoded string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder, decoder = _tools(shared, pattern)

        def convert(texts):
            packed = [encoder.packed(t) for t in texts]
            decoded = [decoder.decode(_unpack(p)) for p in packed]
            return pd.DataFrame({"ids": packed, "decoded": decoded})

        return _frozen(_slices(batches), convert)

    return both(text)


def encode_documents(docs, ranks, pattern, text="text", output="ids"):
    """All columns of every row, ``n_tokens`` and the binary ids in ``output``.

    Null and empty texts have no ids. ``docs`` must not have the two columns yet. The
    vocabulary goes to every executor; its size is that of its file.
    """
    spark = docs.sparkSession
    ids = encode_column(spark, F.col(text), ranks, pattern)
    return docs.withColumn(output, ids).withColumn(
        "n_tokens", (F.octet_length(output) / 4).cast("long")
    )


def encode_and_decode_documents(docs, ranks, pattern, text="text", output="ids"):
    """As ``encode_documents``, with ``decoded_sha256``, the digest of the text decoded from the ids.

    Columns of ``docs`` that have the names of the three results, in any case, give way to them.
    Repeated rows stay, an empty table gives an empty one.
    """
    done = free_name(docs, "done")
    rows = docs.withColumn(done, round_trip_column(docs.sparkSession, F.col(text), ranks, pattern))
    made = {output.lower(), "n_tokens", "decoded_sha256"}
    return rows.select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in made],
        F.col(f"{done}.ids").alias(output),
        (F.octet_length(f"{done}.ids") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col(f"{done}.decoded"), 256).alias("decoded_sha256"),
    )


def round_trip(docs, ranks, pattern, key="doc_id", text="text"):
    """Key, ``ids`` and ``decoded``, the text that the ids decode to; other columns are left out.

    Null and empty texts give no ids and an empty text.
    """
    spark = docs.sparkSession
    done = free_name(docs, "done")
    rows = docs.select(key, round_trip_column(spark, F.col(text), ranks, pattern).alias(done))
    return rows.select(key, f"{done}.ids", f"{done}.decoded")
