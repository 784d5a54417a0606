"""Words of many texts at once: positions, hashes and sliding windows in numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_RADIX = np.uint64(0x9E3779B97F4A7C15)
_RADIX_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Longer words are hashed one by one: modulo 2**64 a polynomial can be made to collide on long inputs.
_LONG_WORD = 256
_SEGMENT = 1 << 20


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins (one entry more than texts). Null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of bytes other than 0x20 and 0x09-0x0D, and each text's first word (one more)."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.ones(len(data), bool)
    before[1:] = space[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = space[1:]
    starts = np.flatnonzero(~space & (before | edge[:-1]))
    ends = np.flatnonzero(~space & (after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _powers(radix: np.uint64, n: int) -> np.ndarray:
    powers = np.full(n, radix, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit Rabin-Karp hash of each word's bytes, a segment of the bytes at a time."""
    import xxhash

    out = np.empty(len(starts), np.uint64)
    byte = mixed(np.arange(1, 257, dtype=np.uint64))
    long = ends - starts > _LONG_WORD
    begin = 0
    while begin < len(starts):
        end = max(begin + 1, int(np.searchsorted(ends, starts[begin] + _SEGMENT, side="right")))
        if end == begin + 1 and long[begin]:
            begin = end
            continue
        base = starts[begin]
        part = data[base : ends[end - 1]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(byte[part] * _powers(_RADIX, len(part)), out=sums[1:])
        s, e = starts[begin:end] - base, ends[begin:end] - base
        out[begin:end] = (sums[e] - sums[s]) * _powers(_RADIX_INVERSE, len(part) + 1)[s]
        begin = end
    for i in np.flatnonzero(long):
        out[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]].tobytes())
    return mixed(out ^ mixed((ends - starts).astype(np.uint64)))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of each ``width`` consecutive numbers, whatever text they belong to."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    for begin in range(0, n, _SEGMENT):
        end = min(n, begin + _SEGMENT)
        part = hashes[begin : end + width - 1]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _powers(_RADIX, len(part)), out=sums[1:])
        out[begin:end] = (sums[width:] - sums[:-width]) * _powers(_RADIX_INVERSE, end - begin)
    return mixed(out)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values, by doubling."""
    have = 1
    while have < width:
        step = min(have, width - have)
        values = np.minimum(values[: len(values) - step], values[step:])
        have += step
    return values


def whole_windows(first: np.ndarray, width: int) -> np.ndarray:
    """Which of the windows of ``width`` words lie within one text."""
    n = max(0, int(first[-1]) - width + 1)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]
    return np.arange(n) + width <= first[1:][text]
