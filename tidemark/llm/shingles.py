"""Word shingles of whole texts as 64-bit hashes, computed for many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes that are hashed at once; a longer text is hashed alone.
CHUNK = 1 << 18
_STEP = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_SEPARATES = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
for _upper in range(ord("A"), ord("Z") + 1):
    _BYTE[_upper] = _BYTE[_upper + 32]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of the input."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse."""
    if len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_STEP), -1, 1 << 64))
        for i, base in enumerate((_STEP, inverse)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a buffer begin, and a hash of each; A-Z count as a-z."""
    separates = _SEPARATES[data]
    edge = np.flatnonzero(separates[1:] != separates[:-1]) + 1
    bounds = np.concatenate([[0] if len(data) and not separates[0] else [], edge, [len(data)]]).astype(np.int64)
    starts, ends = bounds[: len(bounds) // 2 * 2 : 2], bounds[1::2]
    power, inverse = _power_tables(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * power[: len(data)], dtype=np.uint64)])
    hashed = (sums[ends] - sums[starts]) * inverse[starts]
    return starts, mix(hashed ^ mix((ends - starts).astype(np.uint64)))


def shingle_sets(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles of ``words`` words.

    Words are runs of bytes other than space and 0x09 to 0x0D. A text with fewer words has one shingle, of all of
    them, and a text without words none.
    """
    low = 0
    while low < len(texts):
        high, size = low, 0
        while high < len(texts) and (high == low or size + len(texts[high]) < CHUNK):
            size += len(texts[high]) + 1
            high += 1
        yield from _chunk(texts[low:high], words)
        low = high


def _chunk(texts: list[bytes], words: int) -> Iterator[np.ndarray]:
    data = np.frombuffer(b" ".join(texts), np.uint8)
    starts, hashed = word_hashes(data)
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes + 1)])
    first = np.searchsorted(starts, begin)
    factors = mix(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    shingles = np.zeros(max(0, len(hashed) - words + 1), np.uint64)
    for k in range(words):
        shingles += hashed[k : k + len(shingles)] * factors[k]
    shingles = mix(shingles)
    for i in range(len(texts)):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= words:
            yield np.unique(shingles[a : b - words + 1])
        elif b > a:
            short = (hashed[a:b] * factors[: b - a]).sum(dtype=np.uint64, keepdims=True)
            yield mix(short + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)
