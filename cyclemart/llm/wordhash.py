"""Words of whole texts as 64-bit hashes, worked out on Arrow's byte buffers with numpy.

A batch of texts is one run of UTF-8 bytes. Words are found by a 256-entry table
of word bytes, and hashed by a polynomial over their bytes (prefix sums, then a
shift to the word's start) followed by a mixer. Hashes only find candidates or
count set sizes; whatever is reported as equal is compared again or has 64 bits
to differ in.

Memory: texts are taken in blocks of about ``BLOCK_BYTES``; a longer text is a
block of its own, with one byte mask each byte and a few numbers each word, and
its hashes are again taken ``BLOCK_BYTES`` at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

#: Byte tables. Every byte of a multi-byte character is a word byte in both.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_powers: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    if not _powers:
        n = BLOCK_BYTES + 1
        for factor in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(n, factor, np.uint64)
            steps[0] = 1
            _powers.append(np.multiply.accumulate(steps))
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """Words of some consecutive texts: ``first`` is the first text's place in its batch,
    ``counts`` has each text's number of words, and the rest is by word."""

    first: int
    counts: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray

    @property
    def texts(self) -> np.ndarray:
        """The text (from 0 in this block) of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    power, inverse = _tables()
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        if ends[at] - starts[at] >= BLOCK_BYTES:
            digest = hashlib.blake2b(data[starts[at]:ends[at]].tobytes(), digest_size=8).digest()
            out[at] = int.from_bytes(digest, "little")
            at += 1
            continue
        low = starts[at]
        to = at + max(1, int(np.searchsorted(ends[at:], low + BLOCK_BYTES, "right")))
        piece = data[low:ends[to - 1]]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * power[: len(piece)], out=sums[1:])
        begin, end = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[end] - sums[begin]) * inverse[begin]
        at = to
    return mix(out + (ends - starts).astype(np.uint64))


def blocks(texts: pa.Array, word_bytes: np.ndarray, lower: bool = True) -> Iterator[Words]:
    """Words of a batch of texts, block by block; a null text has none."""
    if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type):
        kind = np.int64
    else:
        kind = np.int32
    if len(texts) == 0:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    missing = texts.is_null().to_numpy(zero_copy_only=False)
    at = 0
    while at < len(texts):
        to = at + max(1, int(np.searchsorted(offsets[at + 1:], offsets[at] + BLOCK_BYTES, "right")))
        yield _block(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at], missing[at:to], at, word_bytes, lower)
        at = to


def _block(data: np.ndarray, offsets: np.ndarray, missing: np.ndarray, first: int, word_bytes: np.ndarray, lower: bool) -> Words:
    if lower:
        data = LOWER[data]
    inside = word_bytes[data]
    if missing.any():  # Arrow leaves a null's bytes undefined
        for i in np.flatnonzero(missing):
            inside[offsets[i]:offsets[i + 1]] = False
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    bounds = offsets[:-1][offsets[:-1] < len(data)]
    before[bounds] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    lasts = offsets[1:] - 1
    after[lasts[lasts >= 0]] = False
    ends = np.flatnonzero(inside & ~after) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return Words(first, counts, data, starts, ends, _hashes(data, starts, ends))


def gram_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each run of ``n`` words that lies in one text, index of its first word)."""
    total = len(words.hashes)
    if total < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    out = np.zeros(total - n + 1, np.uint64)
    for i in range(n):
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + words.hashes[i:total - n + 1 + i])
    texts = words.texts
    whole = np.flatnonzero(texts[: total - n + 1] == texts[n - 1:])
    return out[whole], whole
