"""Secret scans through nested encodings.

A document is a worklist of layers. The first is the text. Each layer is scanned by the patterns and
unwrapped once by every decoder: percent-encoding and Unicode escapes give the whole layer with
the escapes resolved, so what stands around them stays in view, an escape that only gives the
sign of another one being followed to its end at once; a base64 run, of either alphabet
and over line breaks, gives layers of its own at each of its four offsets, and one for each stretch
of compressed data in them, inflated. Bytes that are no UTF-8 become replacement characters. Inflated
data is a stream of any length, scanned in windows. Layers seen before are not taken up
again, which ends cycles; as no decoder makes a layer longer but inflation, the list runs empty.
Every layer carries, for each of its characters, the range of characters of the text it came from,
and findings are reported as such ranges.
"""

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import free_name

# The kinds in their order, and their patterns.
KINDS = ("assign", "access", "hex")
_KEYWORD = "|".join(
    "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    for word in ("password", "passwd", "secret", "token")
)
_ASSIGN = re.compile(
    rf"(?:{_KEYWORD}|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")

_HINTS = (b"passw", b"secret", b"token", b"api")
_HEX_BYTES = bytes(120 if c in b"0123456789abcdef" else 32 for c in range(256))
_BASE64_BYTES = bytes(
    120 if chr(c).isalnum() and c < 128 or c in b"+/-_" else 32 for c in range(256)
)
_BASE64_LEAST = 16
_ESCAPED = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_UNICODE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2})+")
# Escapes that give the first character of another escape: chains, resolved to their end at once.
_TWO = re.compile(r"[0-9A-Fa-f]{2}")
_UNIT = re.compile(r"u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8})|x([0-9A-Fa-f]{2})")
_UNIT_ANY = r"(?:u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|x[0-9A-Fa-f]{2})"
_PERCENT_CHAIN = re.compile(rf"%25[0-9A-Fa-f]{{2}}|%5[cC]{_UNIT_ANY}")
_UNICODE_CHAIN = re.compile(
    rf"\\(?:u0025|U00000025|x25)[0-9A-Fa-f]{{2}}|\\(?:u005[cC]|U0000005[cC]|x5[cC]){_UNIT_ANY}"
)
_UNICODE_UNIT = re.compile(r"\\(?:u(.{4})|U(.{8})|x(.{2}))")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]+(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+)*")
_ESCAPES = re.compile("[\udc80-\udcff]")
_BASE64_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
_WRAP = re.compile(rb"[ \t]*\r?\n[ \t]*")
_URL_SAFE = bytes.maketrans(b"-_", b"+/")
# Beginnings of gzip, bzip2, xz, zstd and zlib data.
_PACKED = re.compile(
    rb"\x1f\x8b\x08|BZh[1-9](?=1AY&SY|\x17rE8P\x90)|\xfd7zXZ\0|\x28\xb5\x2f\xfd|\x78[\x01\x5e\x9c\xda\x20\x3f\x7d\xbb\xf9]"
)

# No format needs fewer bytes.
_PACKED_LEAST = 8

# Inflated data is scanned to its end in windows of about so many bytes. A window ends outside
# encoded runs and grows for it up to ``WINDOW_MOST``; a longer run is cut there, which sets
# ``incomplete``, as do more than ``NESTED`` formats inside one another.
WINDOW = 1024 * 1024
WINDOW_MOST = 16 * WINDOW
NESTED = 64
# What the next window repeats: more than the shortest form of any match, with ``_SPACES`` spaces.
_OVERLAP = 512
_SPACES = 64
_CHUNK = 64 * 1024
# ASCII characters that end every encoded run.
_SAFE_CUT = re.compile(rb"[^A-Za-z0-9+/_=%\\\s\x80-\xff-]|(?<=[^\s])[ \t]+(?=[^\s])|\n[ \t\r]*\n")
_MANY_SPACES = re.compile(rb" {%d,}" % (_SPACES + 1))

RESULT = (
    T.StructType()
    .add("n_assign", T.LongType())
    .add("n_access", T.LongType())
    .add("n_hex", T.LongType())
    .add("base", T.StringType())
    .add("spans", T.StringType())
    .add("layers", T.LongType())
    .add("incomplete", T.BooleanType())
)


def scan(text):
    """(start, kind, end) of every pattern match, leftmost and apart within a kind."""
    found = []
    data = text.encode("utf-8", "surrogatepass")
    lower = data.lower()
    if any(hint in lower for hint in _HINTS):
        for match in _ASSIGN.finditer(text):
            if len(match[1]) >= 8:
                found.append((match.start(), 0, match.end()))
    if b"AKIA" in data:
        for match in _ACCESS.finditer(text):
            if match.end() - match.start() >= 16:
                found.append((match.start(), 1, match.end()))
    if b"x" * 32 in data.translate(_HEX_BYTES):
        found += [(match.start(), 2, match.end()) for match in _HEX.finditer(text)]
    return sorted(found)


class _Layer:
    """A text and the range in the document that each of its characters came from."""

    def __init__(self, text, starts, ends):
        self.text, self.starts, self.ends = text, starts, ends

    @classmethod
    def first(cls, text):
        return cls(text, np.arange(len(text)), np.arange(1, len(text) + 1))

    @classmethod
    def of(cls, text, start, end):
        """A layer whose characters all come from one range."""
        size = len(text)
        return cls(text, np.broadcast_to(np.int64(start), size), np.broadcast_to(np.int64(end), size))

    def spans(self):
        for start, kind, end in scan(self.text):
            yield int(self.starts[start]), kind, int(self.ends[start:end].max())

    def replaced(self, pieces):
        """The layer with (start, end, text, own ranges) in place of its characters."""
        texts, starts, ends, at = [], [], [], 0
        for start, end, text, ranges in pieces:
            texts += [self.text[at:start], text]
            starts += [self.starts[at:start], self.starts[start + ranges[:, 0]]]
            ends += [self.ends[at:start], self.ends[start + ranges[:, 1] - 1]]
            at = end
        texts.append(self.text[at:])
        starts.append(self.starts[at:])
        ends.append(self.ends[at:])
        return _Layer("".join(texts), np.concatenate(starts), np.concatenate(ends))

    def inner(self, start, text, ranges):
        """A layer of its own for what a run from ``start`` on holds."""
        return _Layer(text, self.starts[start + ranges[:, 0]], self.ends[start + ranges[:, 1] - 1])


def _decoded(data, ranges):
    """Text of bytes, and ranges of its characters from those of its bytes, if given.

    Each byte that is no UTF-8 becomes a replacement character.
    """
    text = data.decode("utf-8", "surrogateescape")
    if len(text) < len(data) and ranges is not None:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        lone = (codes >= 0xDC80) & (codes <= 0xDCFF)
        widths = 1 + (~lone & (codes >= 0x80)) + (~lone & (codes >= 0x800)) + (codes >= 0x10000)
        ends = np.cumsum(widths)
        ranges = np.stack([ranges[ends - widths, 0], ranges[ends - 1, 1]], axis=1)
    return _ESCAPES.sub("\ufffd", text), ranges


def _chain(text, at):
    """(end, value, is a byte) of the escape at a sign, followed as long as it gives a sign that
    begins another escape with what stands behind; None if there is no escape.

    The text of a chain is read once, however many levels it stands for.
    """
    sign, end, found = text[at], at + 1, None
    while True:
        match = (_TWO if sign == "%" else _UNIT).match(text, end)
        if match is None:
            return found
        value = int(match[0] if sign == "%" else match[match.lastindex], 16)
        if value > 0x10FFFF:
            return found
        end = match.end()
        found = end, value, sign == "%" or match[0][0] == "x" and value < 0x80
        if value not in (0x25, 0x5C):
            return found
        sign = chr(value)


def _resolved(layer, sign, unscanned):
    """The layer with all chains that begin with the sign resolved, and what their bytes hold."""
    text, pieces, at = layer.text, [], layer.text.find(sign)
    while at >= 0:
        begin, data, values, ranges = at, bytearray(), [], []
        while at < len(text) and text[at] == sign and (found := _chain(text, at)):
            end, value, is_byte = found
            if bool(is_byte) != (not values) and (data or values):
                break
            data.append(value) if is_byte else values.append(value)
            ranges.append((at - begin, end - begin))
            at = end
        if not ranges:
            at = text.find(sign, at + 1)
            continue
        ranges = np.array(ranges)
        if data:
            yield from _inflated(layer, bytes(data), begin + ranges, unscanned)
            pieces.append((begin, at, *_decoded(bytes(data), ranges)))
        else:
            pieces.append((begin, at, "".join(map(chr, values)), ranges))
        at = text.find(sign, at)
    if pieces:
        yield layer.replaced(pieces)


def _unescape_percent(layer, unscanned):
    if "%" not in layer.text:
        return
    if _PERCENT_CHAIN.search(layer.text):
        yield from _resolved(layer, "%", unscanned)
        return
    pieces = []
    for match in _ESCAPED.finditer(layer.text):
        data = bytes.fromhex(match[0].replace("%", ""))
        at = np.arange(len(data))
        ranges = np.stack([3 * at, 3 * at + 3], axis=1)
        pieces.append((match.start(), match.end(), *_decoded(data, ranges)))
        yield from _inflated(layer, data, match.start() + ranges, unscanned)
    if pieces:
        yield layer.replaced(pieces)


def _unescape_unicode(layer, unscanned):
    if "\\" not in layer.text:
        return
    if _UNICODE_CHAIN.search(layer.text):
        yield from _resolved(layer, "\\", unscanned)
        return
    pieces = []
    for match in _UNICODE.finditer(layer.text):
        units = [
            (unit.start(), unit.end(), int(unit[1] or unit[2] or unit[3], 16))
            for unit in _UNICODE_UNIT.finditer(match[0])
        ]
        if any(code > 0x10FFFF for _, _, code in units):
            continue
        if all(code < 256 for _, _, code in units):
            places = match.start() + np.array([unit[:2] for unit in units])
            yield from _inflated(layer, bytes(unit[2] for unit in units), places, unscanned)
        text, ranges = [], []
        for start, end, code in units:
            if 0xDC00 <= code <= 0xDFFF and text and 0xD800 <= ord(text[-1]) <= 0xDBFF:
                code = 0x10000 + (ord(text.pop()) - 0xD800) * 0x400 + code - 0xDC00
                start = ranges.pop()[0]
            text.append(chr(code))
            ranges.append((start, end))
        pieces.append((match.start(), match.end(), "".join(text), np.array(ranges)))
    if pieces:
        yield layer.replaced(pieces)


def _decompressor(head):
    """A decompressor for data that begins so, or None."""
    if head[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if len(head) > 2 and head[0] & 15 == 8 and (head[0] << 8 | head[1]) % 31 == 0:
        return zlib.decompressobj()
    if head[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if head[:6] == b"\xfd7zXZ\0":
        return lzma.LZMADecompressor()
    if head[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor().decompressobj()
    return None


def _pieces(unpack, data):
    """What a decompressor makes of some data, piece by piece, and None with what it left."""
    if isinstance(unpack, (bz2.BZ2Decompressor, lzma.LZMADecompressor)):
        yield unpack.decompress(data, _CHUNK), b""
        while not unpack.eof and not unpack.needs_input:
            yield unpack.decompress(b"", _CHUNK), b""
        yield None, unpack.unused_data
    elif hasattr(unpack, "copy"):
        while (piece := unpack.decompress(data, _CHUNK)) or (unpack.unconsumed_tail and not unpack.eof):
            data = unpack.unconsumed_tail
            yield piece, b""
            if unpack.eof:
                break
        yield None, unpack.unused_data
    else:
        # Has no limit of its own: a few bytes at a time.
        at = 0
        while at < len(data) and not unpack.eof:
            piece = unpack.decompress(data[at : at + 64])
            at += 64
            yield piece, b""
        yield None, unpack.unused_data + data[at:]


def _unpacked(chunks, left):
    """Decompressed pieces of all members that stand one after another in the chunks.

    ``left`` becomes the number of bytes behind them, unless damaged data ends them.
    """
    head = next(chunks, b"")
    try:
        while (unpack := _decompressor(head)) is not None:
            rest = b""
            while head is not None and not unpack.eof:
                for piece, rest in _pieces(unpack, head):
                    if piece:
                        yield piece
                if not unpack.eof:
                    head = next(chunks, None)
            if head is None:
                left[:] = [0]
                return
            head = rest.lstrip(b"\0")
            while len(head) < 6 and (more := next(chunks, None)) is not None:
                head = (head + more).lstrip(b"\0")
        left[:] = [len(head)]
    except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError, zstandard.ZstdError):
        return


def _levels(data, left):
    """Streams of what compressed data holds, of what that holds, and so on; None if too deep."""
    make = lambda: iter([data])
    for depth in range(NESTED + 1):
        head = b""
        for piece in make():
            head += piece
            if len(head) >= 6:
                break
        if _decompressor(head) is None:
            return
        if depth == NESTED:
            yield None
            return
        make = partial(_level, make, left if not depth else [0])
        yield make()


def _level(make, left):
    # The first piece must tell the format.
    pieces, head = make(), b""
    for piece in pieces:
        head += piece
        if len(head) >= 6:
            break
    return _unpacked(chain([head], pieces), left)


def _windows(pieces, cut_short):
    """Windows of a stream that overlap by more than a match needs and end outside encoded runs.

    Long runs of spaces are shortened: a match allows any number. If a run had to be
    cut, ``cut_short`` is called.
    """
    parts, size, goal = [], 0, WINDOW
    for piece in pieces:
        parts.append(piece)
        size += len(piece)
        if size < goal:
            continue
        data = _MANY_SPACES.sub(b" " * _SPACES, b"".join(parts))
        if len(data) >= goal:
            cut = _last_cut(data)
            if cut <= _OVERLAP and len(data) >= WINDOW_MOST:
                cut = len(data)
                cut_short()
            if cut > _OVERLAP:
                yield data[:cut]
                data = data[cut - _OVERLAP :]
            goal = len(data) + WINDOW
        parts, size = [data], len(data)
    data = _MANY_SPACES.sub(b" " * _SPACES, b"".join(parts))
    if data:
        yield data


def _last_cut(data):
    for at in (max(0, len(data) - _CHUNK), 0):
        cuts = [match.end() for match in _SAFE_CUT.finditer(data, at)]
        if cuts:
            return cuts[-1]
    return 0


def _runs(text):
    """(characters, their places) of each base64 run, whole and line by line."""
    for match in _BASE64.finditer(text):
        if match.end() - match.start() < _BASE64_LEAST:
            continue
        lines = [line.span() for line in _BASE64_LINE.finditer(text, *match.span())]
        whole = "".join(text[s:e] for s, e in lines)
        if len(whole) >= _BASE64_LEAST:
            yield whole, np.concatenate([np.arange(s, e) for s, e in lines])
        if len(lines) > 1:
            for s, e in lines:
                if e - s >= _BASE64_LEAST:
                    yield text[s:e], np.arange(s, e)


def _promising(text):
    return bool(scan(text)) or _may_unwrap(text)


def _unwrap_base64(layer, unscanned):
    if not _has_base64(layer.text):
        return
    for run, places in _runs(layer.text):
        standard = run.encode().translate(_URL_SAFE)
        for offset in range(4):
            body = standard[offset:]
            body = body[: len(body) - (len(body) % 4 == 1)]
            raw = base64.b64decode(body + b"=" * (-len(body) % 4))
            at = np.arange(len(raw))
            ranges = np.stack([places[offset + at * 8 // 6], places[offset + (at * 8 + 7) // 6] + 1], axis=1)
            whole = np.stack([ranges[:, 0], np.full(len(raw), places[-1] + 1)], axis=1)
            text, ranges = _decoded(raw, ranges)
            if text and (not offset and "".join(text.split()).isprintable() or _promising(text)):
                yield layer.inner(0, text, ranges)
            yield from _inflated(layer, raw, whole, unscanned)


def _inflated(layer, raw, places, unscanned):
    """Layers of what compressed data in some bytes holds; their places are ranges of the layer."""
    done = 0
    for start in _packed_starts(raw) if len(raw) >= _PACKED_LEAST else ():
        if start < done:
            continue
        origin = int(layer.starts[places[start][0]]), int(layer.ends[places[-1][1] - 1])
        left = []
        for level in _levels(raw[start:], left):
            if level is None:
                unscanned.add(origin)
                break
            for window in _windows(level, lambda: unscanned.add(origin)):
                yield _Layer.of(_decoded(window, None)[0], *origin)
        done = len(raw) - left[0] if left else done


def _packed_starts(data):
    """Where compressed data may begin: at the first byte in any form, at others by its magic."""
    found = [match.start() for match in _PACKED.finditer(data)]
    return found if found[:1] == [0] else [0, *found]


_DECODERS = (_unescape_percent, _unescape_unicode, _unwrap_base64)


def find_secrets(text):
    """(base spans, all spans, layers, incomplete) of one text; spans are (start, kind, end).

    All spans hold the base ones and those of decoded layers, each once.
    """
    base, spans, layers, unscanned = _search(text or "")
    return base, spans, layers, bool(unscanned)


def _search(text):
    """As ``find_secrets``, with the ranges (start, end) that were not scanned in every way."""
    base = scan(text)
    spans, seen, unscanned = set(base), set(), set()
    # Layers are made when their turn comes, so that few are held at a time.
    work = [iter([_Layer.first(text)] if _may_unwrap(text) else [])]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if not layer.text:
            continue
        # Equal texts from equal places hold the same; a decoder that leads back ends here.
        digest = hashlib.sha256(layer.text.encode("utf-8", "surrogatepass")).digest()
        place = digest, int(layer.starts[0]), int(layer.ends[-1])
        if place in seen:
            continue
        seen.add(place)
        spans.update(layer.spans())
        work.append(chain.from_iterable([decoder(layer, unscanned) for decoder in _DECODERS]))
    return base, sorted(spans), max(1, len(seen)), sorted(unscanned)


def _may_unwrap(text):
    """Whether any decoder could find something; spares plain texts their maps."""
    if "%" in text and _ESCAPED.search(text) or "\\" in text and _UNICODE.search(text):
        return True
    return _has_base64(text)


def _has_base64(text):
    """Whether there is a run of enough characters, line breaks and indents left out."""
    data = text.encode("utf-8", "surrogatepass")
    if b"\n" in data:
        data = _WRAP.sub(b"", data)
    return b"x" * _BASE64_LEAST in data.translate(_BASE64_BYTES)


def _joined(spans):
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


@F.pandas_udf(RESULT)
def secrets_column(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        rows = []
        for text in texts:
            base, spans, layers, incomplete = find_secrets(text)
            counts = [sum(kind == k for _, kind, _ in base) for k in range(len(KINDS))]
            rows.append((*counts, _joined(base), _joined(spans), layers, incomplete))
        yield pd.DataFrame(rows, columns=RESULT.names)


def secret_report(docs, key="doc_id", text="text"):
    """Key, counts by kind, ``base`` and ``spans`` (kind:start:end by start, in code points, end
    exclusive), ``layers`` and ``incomplete`` of every row.

    The counts and ``base`` are of the text itself, ``spans`` also of all decoded layers. A
    null text is empty. Repeated rows stay, an empty table gives an empty one; spans of one start are
    in the order of the kinds. Other columns are left out.
    """
    found = free_name(docs, "found")
    rows = docs.select(key, secrets_column(F.col(text)).alias(found))
    return rows.select(key, f"{found}.*")


def _redacted(text):
    """What could not be scanned in every way goes as a secret does."""
    _, spans, _, unscanned = _search(text or "")
    found = [(start, f"[{KINDS[kind]}]", end) for start, kind, end in spans]
    found = sorted(found + [(start, "[unscanned]", end) for start, end in unscanned])
    parts, at = [], 0
    for start, name, end in found:
        if start >= at:
            parts += [text[at:start], name]
        at = max(at, end)
    return "".join(parts) + text[at:] if found else text


@F.pandas_udf(T.StringType())
def redacted_column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([_redacted(text) for text in texts], dtype=object)


def redact_secrets(docs, text="text", length="n_chars"):
    """All rows and columns, each secret replaced by its kind in brackets.

    Overlapping secrets become one. ``length``, if it is a column, follows the text where it
    changed. A null text stays null.
    """
    clean = free_name(docs, "clean")
    rows = docs.withColumn(clean, redacted_column(F.col(text)))
    if length in docs.columns:
        changed = ~F.col(text).eqNullSafe(F.col(clean))
        new = F.length(clean).cast(docs.schema[length].dataType)
        rows = rows.withColumn(length, F.when(changed, new).otherwise(F.col(length)))
    return rows.withColumn(text, F.col(clean)).drop(clean)
