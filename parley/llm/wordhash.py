"""Hashes of words and of runs of neighbouring words, for whole batches of texts at once.

A word's hash is a polynomial of its lower-cased bytes modulo 2**64, read off running sums; a
shingle's hash mixes those of its words. Both are alike wherever the words stand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes whose running sums are held at once; a longer text is cut at white space.
CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0xD6E8FEB86659FD93)
_HALF = np.uint64(32)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[65:91] += np.uint64(32)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> _HALF) * _STEP
    x = (x ^ x >> _HALF) * _STEP
    return x ^ x >> _HALF


class _Powers:
    """Powers of the base and of its inverse, grown as longer stretches come."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            size = max(n, 4096)
            steps = np.full((2, size), 1, np.uint64)
            steps[0, 1:], steps[1, 1:] = _BASE, pow(_BASE, -1, 1 << 64)
            self.up, self.down = np.multiply.accumulate(steps, axis=1)


_powers = _Powers()


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of a stretch of bytes."""
    n = len(raw)
    blank = np.ones(n + 2, bool)
    blank[1:-1] = _SPACE[raw]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    first, last = edges[::2], edges[1::2]
    _powers.reach(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LOWER[raw] * _powers.up[:n], out=sums[1:])
    return mix((sums[last] - sums[first]) * _powers.down[np.minimum(first, max(n - 1, 0))]), first


def _stretches(raw: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of stretches of about ``CHUNK`` bytes that no word crosses; texts are cut only where they must be."""
    begin, end = 0, int(at[-1])
    while end - begin > CHUNK:
        k = int(np.searchsorted(at, begin + CHUNK, "right")) - 1
        stop = int(at[k])
        if stop <= begin:  # one text is longer than that
            stop, most = begin + CHUNK, int(at[k + 1])
            gaps = np.flatnonzero(_SPACE[raw[stop:most]])
            stop = stop + int(gaps[0]) if len(gaps) else most
        yield begin, stop
        begin = stop
    yield begin, end


def shingle_hashes(raw: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word shingles of the texts raw[at[i]:at[i + 1]], and each text's bounds in them.

    A text of fewer words is one shingle, one without words none. Texts must not run into each
    other: the caller puts white space between them.
    """
    hashes, firsts = [], []
    for a, b in _stretches(raw, at):
        h, first = word_hashes(raw[a:b])
        hashes.append(h)
        firsts.append(first + a)
    words, first = np.concatenate(hashes), np.concatenate(firsts)
    bound = np.searchsorted(first, at)
    counts = np.diff(bound)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    padded = np.concatenate([words, np.zeros(width, np.uint64)])
    sums = np.zeros(len(words), np.uint64)
    for k in range(width):
        sums += padded[k : k + len(words)] * factors[k]
    inside = np.repeat(bound[1:], counts) - np.arange(len(words)) >= width
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        a, b = int(bound[i]), int(bound[i + 1])
        sums[a], inside[a] = (words[a:b] * factors[: b - a]).sum(dtype=np.uint64), True
    sizes = np.where((counts > 0) & (counts < width), 1, np.maximum(counts - width + 1, 0))
    return mix(sums[inside]), np.concatenate([[0], np.cumsum(sizes)])


def of_texts(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of UTF-8 texts and each text's bounds in them."""
    lens = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    return shingle_hashes(np.frombuffer(b" ".join([*texts, b""]), np.uint8), np.concatenate([[0], np.cumsum(lens)]), width)
