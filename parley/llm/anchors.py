"""Content-defined anchors: places in a text that equal passages choose alike.

Of the k-grams inside a window the one with the least hash is its anchor (the leftmost of
equals). Windows with the same bytes have the same anchor at the same place, so two equal
windows always meet under one key, and windows of one anchor form a run.
"""

from __future__ import annotations

import numpy as np

GRAM = 40
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
#: Window starts handled at once; bounds memory for very long texts.
CHUNK = 1 << 19
_PLACE_BITS = 20


def _powers(n: int, base: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    if n > 1:
        out[1:] = base
        out = np.multiply.accumulate(out)
    return out


class _Hasher:
    def __init__(self) -> None:
        size = CHUNK + 4096
        self.up = _powers(size, _BASE)
        self.down = _powers(size, pow(_BASE, -1, 1 << 64))

    def grams(self, raw: np.ndarray, k: int) -> np.ndarray:
        """A 64-bit hash of each k-gram, alike wherever it stands."""
        n = len(raw)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        h = (sums[k:] - sums[: n - k + 1]) * self.down[: n - k + 1]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ h >> np.uint64(32)


_hasher: _Hasher | None = None


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours, from running minima of blocks of w in both directions."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def anchor_runs(raw: np.ndarray, window: int, k: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of window starts with one anchor: first start, number of starts, the anchor's hash.

    Every start 0 .. len(raw) - window lies in exactly one run of its chunk; chunks overlap
    by a window, so a run that a chunk's end cuts is two runs under the same key.
    """
    global _hasher
    if _hasher is None:
        _hasher = _Hasher()
    firsts, counts, keys = [], [], []
    w = window - k + 1
    for at in range(0, max(0, len(raw) - window + 1), CHUNK):
        part = raw[at : at + CHUNK + window - 1]
        h = _hasher.grams(part, k)
        place = np.arange(len(h), dtype=np.uint64)
        ranked = h >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS) | place
        chosen = (sliding_min(ranked, w) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        cut = np.flatnonzero(np.diff(chosen)) + 1
        first = np.concatenate([[0], cut])
        firsts.append(first + at)
        counts.append(np.diff(np.concatenate([first, [len(chosen)]])))
        keys.append(h[chosen[first]])
    if not firsts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(firsts), np.concatenate(counts), np.concatenate(keys)
