"""Byte-level BPE encoding and decoding with reuse of content-defined chunks.

Texts are cut into chunks where a rolling (gear) hash of the last 16 bytes has its low bits zero, so that
passages which documents share give the same chunks wherever they stand. A chunk is encoded once per worker
and kept in a bounded cache. A cut may fall anywhere, even within a character, so the joins are repaired. A boundary
is a place where a pre-token begins in any context, whatever the script: before white space that follows something
visible, and between letters, digits and other signs (but not behind an apostrophe, which may begin a contraction).
A chunk keeps the tokens between its first and last boundary; what lies between the last boundary before a join
and the first one after it is encoded again, over further chunks where one has no boundary, so that the tokens on
both sides agree exactly with an encoding of the whole text.

The cache is per worker, not a table that all workers read: to share chunks across machines, their
texts and their tokens would cross the network, which is more than encoding them anew costs.

Nulls and edges: a null text counts as empty and has no tokens; special tokens in a text are recognised, as
the tokenizers library does; texts of any length are encoded whole; extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import json
import re
import unicodedata
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from .common import in_arrow, tokenizer_path

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Chunks are 2**CHUNK_BITS bytes on average, and MOST at most.
CHUNK_BITS, MOST = 10, 16_384
#: Bytes that a worker's cache takes: chunks, their tokens, and ENTRY for the objects around each.
CACHE_BYTES, ENTRY = 16 << 20, 400
_GEAR = np.frombuffer(hashlib.shake_128(b"gear").digest(1024), "<u4")
#: White space of the pattern, by Unicode's property.
_SPACES = frozenset("\t\n\v\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
#: What libraries do not agree on whether it is white space.
_DOUBTFUL = frozenset("\x1c\x1d\x1e\x1f\u0085\u180e\u200b\ufeff")


@functools.lru_cache(maxsize=1 << 16)
def kind(c: str) -> str:
    """Class of a character in the pattern: L, N, S (space), ' or P (others); "" where versions of Unicode may differ."""
    if c == "'" or c in _SPACES:
        return "'" if c == "'" else "S"
    now, then = unicodedata.category(c), unicodedata.ucd_3_2_0.category(c)
    if c in _DOUBTFUL or "Cn" in (now, then) or now[0] != then[0]:
        return ""
    return now[0] if now[0] in "LN" else "P"


def certain(a: str, b: str) -> bool:
    """Whether a pre-token begins between these characters in any context."""
    x, y = kind(a), kind(b)
    return bool(x and y) and x != y and x != "S" and not (x == "'" and y in "LP" or y == "'" and x == "P")


def _start(data: bytes, at: int) -> int:
    """Where the character that holds byte ``at`` begins."""
    while 0 < at < len(data) and data[at] & 0xC0 == 0x80:
        at -= 1
    return at


def boundary(data: bytes, at: int, ahead: bool = True, apart: frozenset[str] = frozenset()) -> int:
    """The first boundary at ``at`` or after it (or the last before or at it); -1 if there is none.

    ``data`` may begin and end within a character. No boundary is seen between two characters of ``apart``.
    """
    low = 0
    while low < min(3, len(data)) and data[low] & 0xC0 == 0x80:
        low += 1  # a character that is cut off
    size = 64
    start, end = (max(low, _start(data, at - 1)), 0) if ahead else (0, min(len(data), at + 4))
    while True:
        if ahead:
            end = _start(data, start + size)
        else:
            start = max(low, _start(data, end - size))
        text = data[start:end].decode("utf-8", "ignore")
        for j in range(1, len(text)) if ahead else range(len(text) - 1, 0, -1):
            if certain(text[j - 1], text[j]) and text[j - 1 : j + 1] not in apart:
                place = start + len(text[:j].encode())
                if place >= at if ahead else place <= at:
                    return place
        if ahead and end >= len(data) or not ahead and start <= low:
            return -1
        if ahead:
            start = _start(data, end - 1)
        else:
            end = _start(data, start + 4)  # a character and more in both
        size *= 2


def cuts(data: np.ndarray, bits: int = CHUNK_BITS, most: int = MOST) -> list[int]:
    """Ends of the content-defined chunks of ``data``."""
    h = _GEAR[data]
    for w in (1, 2, 4, 8):
        h[w:] = h[w:] + (h[:-w] << np.uint32(w))
    ends, last = [], 0
    for e in np.flatnonzero(h >> np.uint32(32 - bits) == 0) + 1:
        while e - last > most:
            last += most
            ends.append(last)
        ends.append(last := int(e))
    while len(data) - last > most:
        last += most
        ends.append(last)
    if last < len(data):
        ends.append(len(data))
    return ends


class Codec:
    """Encodes and decodes as the tokenizers library does with a byte-level BPE file."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES, bits: int = CHUNK_BITS):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in visible)}
        self.special = {x["content"].encode(): x["id"] for x in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in k): v for k, v in spec["model"]["vocab"].items() if v not in self.special.values()}
        self.table = [b""] * (max([*ranks.values(), *self.special.values()]) + 1)
        for k, v in [*ranks.items(), *self.special.items()]:
            self.table[v] = k
        self.plain = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cache: OrderedDict[bytes, tuple[int, int, np.ndarray]] = OrderedDict()
        self.room, self.held, self.bits = cache_bytes, 0, bits
        self.apart = frozenset(x["content"][i : i + 2] for x in spec["added_tokens"] for i in range(len(x["content"]) - 1))
        self.found = re.compile(b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or b"(?!)")
        self.reused = self.encoded = 0

    def direct(self, data: bytes) -> np.ndarray:
        """Tokens of bytes that hold no special token, without chunks."""
        return self.plain.encode_to_numpy(data.decode("utf-8"), disallowed_special=()) if data else np.empty(0, np.uint32)

    def chunk(self, data: bytes) -> tuple[int, int, np.ndarray]:
        """First boundary, last boundary, and the tokens between; (-1, -1, none) without boundaries."""
        found = self.cache.get(data)
        if found is not None:
            self.reused += len(data)
            self.cache.move_to_end(data)
            return found
        first = boundary(data, 1)
        last = boundary(data, len(data) - 1, ahead=False) if first > 0 else -1
        found = (first, last, self.direct(data[first:last]) if first > 0 else np.empty(0, np.uint32))
        self.encoded += max(0, last - first)
        self.cache[data] = found
        self.held += self._size(data, found[2])
        while self.held > self.room:
            old, (_, _, ids) = self.cache.popitem(last=False)
            self.held -= self._size(old, ids)
        return found

    @staticmethod
    def _size(data: bytes, ids: np.ndarray) -> int:
        return len(data) + ids.nbytes + ENTRY

    def segment(self, data: bytes) -> list[np.ndarray]:
        """Tokens of bytes that hold no special token."""
        out, seam, start = [], [], 0
        for end in cuts(np.frombuffer(data, np.uint8), self.bits):
            piece, start = data[start:end], end
            first, last, ids = self.chunk(piece)
            if first < 0:
                seam.append(piece)  # no place to agree on: the seam goes on
                continue
            join = b"".join([*seam, piece[:first]])
            out += [self.direct(join), ids]
            self.encoded += len(join)
            seam = [piece[last:]]
        join = b"".join(seam)
        self.encoded += len(join)
        return [*out, self.direct(join)]

    def parts(self, data: bytes) -> Iterator[bytes | int]:
        """``data`` cut at special tokens (leftmost first, then longest), which come as their ids."""
        at = 0
        for m in self.found.finditer(data):
            if m.start() > at:
                yield data[at : m.start()]
            yield self.special[m[0]]
            at = m.end()
        if at < len(data):
            yield data[at:]

    def encode(self, data: bytes) -> np.ndarray:
        out: list[np.ndarray] = []
        for x in self.parts(data):
            out += [np.array([x], np.uint32)] if isinstance(x, int) else self.segment(x)
        return np.concatenate(out) if out else np.empty(0, np.uint32)

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.table.__getitem__, ids.tolist())).decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


_KINDS = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}


def _mapped(docs: DataFrame, columns: list[str], schema: str, row: Callable[[Codec, list], tuple], path: str | None) -> DataFrame:
    """Applies ``row`` to the values of ``columns``, batch by batch; ``columns[0]`` is handed on as it is."""
    path = path or tokenizer_path()
    kind = docs.schema[columns[0]].dataType.simpleString()
    names, kinds = zip(*((name, _KINDS[kind]) for name, kind in map(str.split, schema.split(", "))), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                rows = [row(own, x) for x in zip(*(part.column(i) for i in range(1, len(columns))), strict=True)]
                columns_out = zip(*rows, strict=True) if rows else [[] for _ in names]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(list(c), k) for c, k in zip(columns_out, kinds, strict=True))], [columns[0], *names])

    return in_arrow(docs.select(columns), run, f"`{columns[0]}` {kind}, {schema}")


def _bytes(x: pa.Scalar) -> bytes:
    return x.as_buffer().to_pybytes() if x.is_valid else b""


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """id_col, ids binary (little-endian unsigned 32-bit), n_tokens long."""

    def row(own: Codec, x: tuple) -> tuple:
        ids = own.encode(_bytes(x[0]))
        return ids.astype("<u4").tobytes(), len(ids)

    return _mapped(docs, [id_col, text_col], "ids binary, n_tokens long", row, path)


def decode(encoded: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """id_col, text string: what the ids of ``encode`` stand for, special tokens included."""
    return _mapped(encoded, [id_col, ids_col], "text string", lambda own, x: (own.decode(np.frombuffer(_bytes(x[0]), "<u4")),), path)


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """id_col, n_tokens, ids_sha256, decoded_sha256: encodes, and decodes the ids again, in one pass."""

    def row(own: Codec, x: tuple) -> tuple:
        ids = own.encode(_bytes(x[0])).astype("<u4")
        text = own.decode(ids)
        return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    return _mapped(docs, [id_col, text_col], "n_tokens long, ids_sha256 string, decoded_sha256 string", row, path)
