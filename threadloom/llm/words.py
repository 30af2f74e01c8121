"""Words and word windows of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a longest run of bytes other than space and the bytes 9 to 13. Hashes have 64 bits; two
different words or windows share one with a probability of about 2**-60, which every operator here
takes as never.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
# words are hashed from so many bytes at a time: the arrays of a number for each byte stay small
HASH_BYTES = 256 << 10

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_JOIN = np.uint64(0xD6E8FEB86659FD93)
_rng = np.random.default_rng(20260401)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE[LOWER]
_powers: dict[str, np.ndarray] = {}


def _power(which: str, n: int) -> np.ndarray:
    known = _powers.get(which)
    if known is None or len(known) < n:
        known = np.full(max(n, HASH_BYTES + 1), _BASE if which == "up" else _INVERSE)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if n <= HASH_BYTES + 1:
            _powers[which] = known
    return known


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finisher of a known hash)."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


class Texts:
    """Some texts of a column: ``first`` row, ``data`` bytes, ``offsets`` of len(self) + 1."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1


def texts_of(column, first: int = 0) -> Texts:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    return Texts(first, data, offsets - offsets[0])


def chunks(column, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The column in runs of texts of about ``limit`` bytes; a longer text is a run of its own."""
    whole = texts_of(column)
    start = 0
    while start < len(whole):
        stop = int(np.searchsorted(whole.offsets, whole.offsets[start] + limit, "right")) - 1
        stop = min(max(stop, start + 1), len(whole))
        base = whole.offsets[start]
        yield Texts(
            start, whole.data[base : whole.offsets[stop]], whole.offsets[start : stop + 1] - base
        )
        start = stop


class Words:
    """The words of some texts: byte ranges, their text's number, and first word of each text."""

    def __init__(self, texts: Texts):
        data, offsets = texts.data, texts.offsets
        self.texts = texts
        gap = SEPARATOR[data]
        before = np.empty(len(data), bool)
        after = np.empty(len(data), bool)
        if len(data):
            before[1:], after[:-1] = gap[:-1], gap[1:]
            before[0] = after[-1] = True
            full = offsets[:-1] < offsets[1:]
            before[offsets[:-1][full]] = True
            after[offsets[1:][full] - 1] = True
        self.start = np.flatnonzero(~gap & before)
        self.end = np.flatnonzero(~gap & after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.text = np.repeat(np.arange(len(texts)), self.count)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, lower: bool) -> np.ndarray:
        table = _BYTE_LOWER if lower else _BYTE
        out = np.empty(len(self), np.uint64)
        first = 0
        while first < len(self):
            base = self.start[first]
            stop = max(first + 1, int(np.searchsorted(self.end, base + HASH_BYTES, "right")))
            data = self.texts.data[base : self.end[stop - 1]]
            start, end = self.start[first:stop] - base, self.end[first:stop] - base
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(table[data] * _power("up", len(data) + 1)[: len(data)], out=sums[1:])
            out[first:stop] = (sums[end] - sums[start]) * _power("down", len(data) + 1)[start]
            first = stop
        return mix(out + (self.end - self.start).astype(np.uint64) * _JOIN)

    def inside(self, width: int) -> np.ndarray:
        """For each word, whether the window of ``width`` words from it stays in its text."""
        left = np.repeat(self.first[1:], self.count) - np.arange(len(self))
        return left >= width

    def joined(self, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and text offsets of the kept words, joined by one space."""
        edge = np.zeros(len(self.texts.data) + 2, np.int8)
        edge[self.start[keep]] += 1
        edge[self.end[keep]] -= 1
        inside = np.cumsum(edge[:-1], dtype=np.int8).astype(bool)
        kept = np.flatnonzero(keep)
        last = np.zeros(len(kept), bool)
        if len(kept):
            last[:-1] = self.text[kept[1:]] != self.text[kept[:-1]]
            last[-1] = True
        blanks = self.end[kept[~last]]
        # a word that ends its text has no byte after it there, but then it is the last one
        out = np.empty(len(inside), np.uint8)
        out[: len(self.texts.data)] = self.texts.data
        out[blanks] = 0x20
        inside[blanks] = True
        total = np.zeros(len(inside) + 1, np.int32 if len(inside) < 1 << 31 else np.int64)
        np.cumsum(inside, dtype=total.dtype, out=total[1:])
        return out[inside], total[self.texts.offsets]


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each word on, ignoring text ends; shorter by width - 1.

    Built by doubling: a window is hashed from two windows of half its length.
    """
    if len(words) < width:
        return np.zeros(0, np.uint64)
    done, out = 0, None
    power, size = words, 1
    while True:
        if width & size:
            if out is None:
                out, done = power, size
            else:
                n = len(words) - done - size + 1
                out = mix(out[:n] * _JOIN + power[done : done + n])
                done += size
        if done == width:
            return out[: len(words) - width + 1]
        n = len(power) - size
        power = mix(power[:n] * _JOIN + power[size : size + n])
        size *= 2


def strings(data: np.ndarray, offsets: np.ndarray, kind=pa.string()) -> pa.Array:
    """Arrow strings (or binary) from bytes and offsets."""
    large = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    )
    return large.cast(pa.binary()).cast(kind)
