"""Hashes of words and their parts, for whole batches of texts at once.

Bytes are mapped through a table of random 64-bit numbers and summed with powers of an odd number, so
that the hash of any stretch is a difference of two running sums. Texts of any length are hashed in windows
of bounded size, cut between words.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np

_RANDOM = np.frombuffer(hashlib.shake_128(b"bytes").digest(2048), "<u8").copy()
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
#: Bytes hashed at a time; longer only where one word is.
WINDOW = 1 << 18
SPACE = b" \t\n\x0b\x0c\r"


def mapping(lower: bool = True, also_space: bytes = b"") -> bytes:
    """A translation that lower-cases A-Z and makes every separator a space."""
    out = bytearray(range(256))
    for b in SPACE + also_space:
        out[b] = 0x20
    if lower:
        for b in range(65, 91):
            out[b] = b + 32
    return bytes(out)


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE, np.uint64), np.full(n, _UNBASE, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


class Spans:
    """The words of one window: where they begin and end, and hashes of stretches of bytes."""

    def __init__(self, data: bytes):
        self.data = np.frombuffer(data, np.uint8)
        word = np.empty(len(data) + 2, bool)
        word[0] = word[-1] = False
        np.not_equal(self.data, 0x20, out=word[1:-1])
        edges = np.flatnonzero(word[1:] != word[:-1])
        self.start, self.end = edges[::2], edges[1::2]
        size = max(1 << 16, 1 << (len(data) + 1).bit_length())
        self.up, self.down = _powers(size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_RANDOM[self.data] * self.up[: len(data)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def windows(data: bytes) -> Iterator[bytes]:
    """``data`` (mapped) in pieces of about WINDOW bytes, cut at spaces; a piece after the first begins with its space."""
    start = 0
    while len(data) - start > WINDOW:
        end = data.rfind(b" ", start + 1, start + WINDOW)
        if end < 0:
            end = data.find(b" ", start + WINDOW)
            if end < 0:
                break
        yield data[start:end]
        start = end
    yield data[start:] if start else data


def batched(texts: list[bytes | None], table: bytes) -> Iterator[tuple[list[int], bytes]]:
    """Numbers of texts, and these texts mapped and joined by a space, in groups of about WINDOW bytes."""
    group: list[int] = []
    parts: list[bytes] = []
    size = 0
    for i, t in enumerate(texts):
        t = (t or b"").translate(table)
        if group and size + len(t) > WINDOW:
            yield group, b" ".join(parts)
            group, parts, size = [], [], 0
        group.append(i)
        parts.append(t)
        size += len(t) + 1
    if group:
        yield group, b" ".join(parts)


def word_hashes(texts: list[bytes | None], table: bytes) -> Iterator[np.ndarray]:
    """The hashes of each text's words, in order, text by text."""
    for group, joined in batched(texts, table):
        if len(group) == 1:
            parts = [s.hash(s.start, s.end) for s in map(Spans, windows(joined))]
            yield np.concatenate(parts)
            continue
        s = Spans(joined)
        h = s.hash(s.start, s.end)
        lengths = np.array([len(texts[i] or b"") + 1 for i in group])
        ends = np.searchsorted(s.start, np.cumsum(lengths))
        a = 0
        for b in ends.tolist():
            yield h[a:b]
            a = b
