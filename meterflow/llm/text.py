"""Words and hashes of many texts at once, in numpy, for use inside tasks.

A word is a maximal run of bytes other than space and the controls 9 to 13.
Hashes are 64 bits and depend on the bytes of a word only, so they agree
between tasks and runs.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked on in slices of about this many bytes, which bounds a task's memory.
SLICE_BYTES = 1 << 20
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x):
    """Spread 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n):
    """Powers of an odd base and of its inverse, up to n."""
    if len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + (SLICE_BYTES >> 1))
        for k, base in enumerate((_ODD, pow(_ODD, -1, 1 << 64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def slices(column, size=SLICE_BYTES):
    """(first row, string array without nulls) pieces of a column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
        column = column.cast(pa.string())
    column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    first = 0
    while first < len(column):
        last = int(np.searchsorted(ends, ends[first] + size, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, column.slice(first, last - first)
        first = last


class Words:
    """Word positions of the texts of one slice.

    ``start``, ``end``: byte ranges of all words; words of text d are those
    numbered ``ptr[d]`` to ``ptr[d + 1]``.
    """

    def __init__(self, texts):
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        self.bytes = raw[offsets[0] : offsets[-1]]
        self.offsets = offsets - offsets[0]
        n = len(self.bytes)
        word = np.zeros(n + 2, bool)
        word[1:-1] = ~IS_SPACE[self.bytes]
        cut = np.zeros(n + 1, bool)
        cut[self.offsets] = True
        inside = word[1:-1]
        self.start = np.flatnonzero(inside & (~word[:-2] | cut[:-1]))
        self.end = np.flatnonzero(inside & (~word[2:] | cut[1:])) + 1
        self.ptr = np.searchsorted(self.start, self.offsets)
        self.count = np.diff(self.ptr)

    def __len__(self):
        return len(self.start)

    def hashes(self, lower=False):
        """A hash per word; ``lower`` makes A-Z count as a-z."""
        n = len(self.bytes)
        up, down = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((_BYTE_LOWER if lower else _BYTE)[self.bytes] * up[:n], out=total[1:])
        return mix((total[self.end] - total[self.start]) * down[self.start] + (self.end - self.start).astype(np.uint64))

    def text_of_word(self):
        return np.repeat(np.arange(len(self.count)), self.count)

    def left_in_text(self):
        """Words from this one to the end of its text."""
        return np.repeat(self.ptr[1:], self.count) - np.arange(len(self.start))


def windows(word_hashes, k):
    """Hash of every k consecutive words (also across texts: mask with left_in_text)."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    factor = 1
    for j in range(k):
        factor = factor * 0xD6E8FEB86659FD93 & _MASK
        total += word_hashes[j : j + n] * np.uint64(factor)
    return mix(total)


def whole(word_hashes, ptr):
    """Order-dependent hash of each text's whole word sequence."""
    up, down = _powers(len(word_hashes) + 1)
    total = np.zeros(len(word_hashes) + 1, np.uint64)
    np.cumsum(word_hashes * up[: len(word_hashes)], out=total[1:])
    return mix((total[ptr[1:]] - total[ptr[:-1]]) * down[ptr[:-1]] + (ptr[1:] - ptr[:-1]).astype(np.uint64) * np.uint64(_ODD))


def per_text_sum(values, ptr):
    """Sums of ``values`` between the pointers, for integer or float values."""
    total = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=total[1:])
    return total[ptr[1:]] - total[ptr[:-1]]


def crc_mod(ids, modulus):
    """crc32 of each id as text, modulo ``modulus`` (null: as of the text 'null')."""
    import zlib

    return np.array([zlib.crc32(str("null" if v is None else v).encode()) % modulus for v in ids], np.int64)
