"""Induced suffix sorting with common prefixes, on queues that overflow to disk.

The text's S* suffixes (of type S after type L) are ranked first, over the reduced string of
their substrings' names. Two scans then induce all other suffixes: a queue keyed by first
byte holds tuples of position and common prefix in rank order; taking a bucket's tuples in
order and pushing their predecessors sorts the L suffixes left to right, then the S suffixes
right to left. The common prefix of two neighbours in a bucket is one more than the least
common prefix between the suffixes that induced them.

A queue keeps at most ``memory`` bytes; beyond that, runs go to an unnamed scratch file of
the task and come back in order. Suffixes are compared over at most ``depth`` bytes, all that
a search for repeats of that length needs. Positions and ranks are 32-bit numbers where
the text allows: a sort holds a small multiple of its text.
"""

from __future__ import annotations

import tempfile

import numpy as np


#: Pairs of suffixes compared at once.
_BLOCK = 1 << 16


class BucketQueue:
    """Tuples (position, common prefix) by first byte, first in first out within a byte."""

    def __init__(self, memory: int) -> None:
        self.memory, self.held = memory, 0
        self.runs: list[list] = [[] for _ in range(256)]
        self.file = None

    def push(self, byte: int, positions: np.ndarray, common: np.ndarray) -> None:
        self.runs[byte].append((positions, common))
        self.held += positions.nbytes + common.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile(prefix="parley-queue-")
        self.file.seek(0, 2)
        for runs in self.runs:
            for i, run in enumerate(runs):
                if not isinstance(run[0], int):
                    at = self.file.tell()
                    for part in run:
                        self.file.write(part.tobytes())
                    runs[i] = (at, len(run[0]), run[0].dtype)
        self.held = 0

    def pop(self, byte: int) -> tuple[np.ndarray, np.ndarray] | None:
        """All tuples of a byte, in the order they were pushed."""
        runs, self.runs[byte] = self.runs[byte], []
        if not runs:
            return None
        out = []
        for run in runs:
            if isinstance(run[0], int):
                at, n, kind = run
                self.file.seek(at)
                run = np.frombuffer(self.file.read(kind.itemsize * n), kind), np.frombuffer(self.file.read(2 * n), np.int16)
            else:
                self.held -= run[0].nbytes + run[1].nbytes
            out.append(run)
        return (np.concatenate([r[0] for r in out]), np.concatenate([r[1] for r in out])) if len(out) > 1 else out[0]

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True for type S: smaller than the suffix after it; the last suffix is S."""
    types = np.ones(len(text), bool)
    types[:-1] = text[:-1] < text[1:]
    same = np.flatnonzero(text[:-1] == text[1:])
    if len(same):  # a stretch of one byte is of the type of its last place
        last = np.flatnonzero(np.append(np.diff(same) > 1, True))
        types[same] = np.repeat(types[same[last] + 1], np.diff(last, prepend=-1))
    return types


def _words(text: np.ndarray, after: int) -> np.ndarray:
    """Eight bytes from each place on as one big-endian number, zeros after the end; ``after`` places more. A view: no word is copied."""
    padded = np.concatenate([text, np.zeros(after + 8, np.uint8)])
    return np.ndarray(len(text) + after, ">u8", padded, strides=(1,))


def _refined(ranks: np.ndarray, of: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Dense ranks in which the members ``of`` whole groups of equals are told apart by a key."""
    m, kind = len(ranks), ranks.dtype
    group = ranks[of]
    if key.dtype != np.uint64 and m < 1 << 31:  # two ranks fit one number
        order = np.argsort(group.astype(np.int64) * (m + 1) + key)
    else:
        order = np.lexsort((key, group))
    group, key, of = group[order], key[order], of[order]
    del order
    opens = np.ones(len(of), bool)
    opens[1:] = group[1:] != group[:-1]
    leads = opens.copy()
    leads[1:] |= key[1:] != key[:-1]
    del group, key
    place = np.arange(len(of), dtype=kind)
    further = np.maximum.accumulate(np.where(leads, place, 0))
    further -= np.maximum.accumulate(np.where(opens, place, 0))
    del place, opens, leads
    first = np.bincount(ranks, minlength=m).astype(kind)
    first = np.cumsum(first, dtype=kind) - first
    spaced = first[ranks]
    spaced[of] += further
    del further, of, first
    used = np.zeros(m, bool)
    used[spaced] = True
    used = np.cumsum(used, dtype=kind)
    used -= 1
    return used[spaced]


def _name(words: np.ndarray, stars: np.ndarray, size: int, depth: int) -> np.ndarray:
    """Ranks of the substrings from one S* position to the next, inclusive, to ``depth`` bytes."""
    lengths = np.append(stars[1:] + 1, stars.dtype.type(size)) - stars
    every = np.uint64(0xFFFFFFFFFFFFFFFF)

    def word(of: np.ndarray, k: int) -> np.ndarray:
        over = np.clip(k + 8 - lengths[of], 0, 8).astype(np.uint64)
        tail = np.where(over == 8, every, (np.uint64(1) << (over % np.uint64(8)) * np.uint64(8)) - np.uint64(1))
        tail |= words[np.minimum(stars[of] + k, len(words) - 1)]
        return tail  # a substring that is another's prefix is the larger

    names = np.zeros(len(stars), stars.dtype)
    for k in range(0, depth + 8, 8):
        longer = lengths > k
        if not longer.any():
            break
        mixed = np.zeros(len(stars), bool)
        mixed[names[longer]] = True
        mixed &= np.bincount(names, minlength=len(stars)) > 1
        of = np.flatnonzero(mixed[names])
        if len(of):
            names = _refined(names, of, word(of, k))
    return names


def rank_stars(words: np.ndarray, stars: np.ndarray, size: int, depth: int) -> np.ndarray:
    """S* positions in suffix order: the reduced string of names, ranked by doubling."""
    if not len(stars):
        return stars
    ranks = _name(words, stars, size, depth)
    m, reach = len(stars), 1
    while reach < m:
        far = np.append(stars, np.full(reach, size + depth, stars.dtype))[reach:]
        tied = np.bincount(ranks, minlength=m)[ranks] > 1
        wanted = np.zeros(m, bool)
        wanted[ranks[tied & (far - stars < depth)]] = True
        of = np.flatnonzero(wanted[ranks])
        if not len(of):
            break
        ranks = _refined(ranks, of, np.append(ranks + 1, np.zeros(reach, ranks.dtype))[reach:][of])
        reach *= 2
    return stars[np.argsort(ranks, kind="stable")]


def common_prefixes(words: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, up to ``depth``."""
    out = np.full(len(a), depth, np.int16)
    for begin in range(0, len(a), _BLOCK):
        todo = np.arange(begin, min(len(a), begin + _BLOCK))
        for k in range(0, depth, 8):
            x = words[a[todo] + k] ^ words[b[todo] + k]
            differ = x != 0
            if differ.any():
                high = np.floor(np.log2(x[differ].astype(np.float64))).astype(np.int64)
                # a float of 53 bits may round up to the next power of two
                high -= (x[differ] >> np.minimum(high, 63).astype(np.uint64) == 0) | (high > 63)
                out[todo[differ]] = np.minimum(depth, k + 7 - high // 8)
            todo = todo[~differ]
            if not len(todo):
                break
    return out


class _Scan:
    """One direction's scan: takes sorted tuples and pushes the predecessors of one type."""

    def __init__(self, text, types, s_type: bool, depth: int, memory: int) -> None:
        self.text, self.types, self.s_type, self.depth = text, types, s_type, depth
        self.queue = BucketQueue(memory)
        self.least = np.full(256, -1, np.int64)  # least prefix since a bucket's last tuple; -1 before its first

    def take(self, positions: np.ndarray, common: np.ndarray) -> None:
        wide = common.astype(np.int64)
        before = np.maximum(positions - 1, 0)
        of = np.flatnonzero((positions > 0) & (self.types[before] == self.s_type))
        byte = self.text[before[of]]
        order = np.argsort(byte, kind="stable")
        of, byte = of[order], byte[order]
        cuts = np.flatnonzero(np.diff(byte)) + 1
        seen = {}
        for own in np.split(of, cuts) if len(of) else ():
            b = int(self.text[positions[own[0]] - 1])
            first = min(self.least[b], wide[: own[0] + 1].min())
            rest = np.minimum.reduceat(wide[: own[-1] + 1], own[:-1] + 1) if len(own) > 1 else wide[:0]
            prefix = np.minimum(np.concatenate([[first], rest]) + 1, self.depth).astype(np.int16)
            seen[b] = wide[own[-1] + 1 :].min() if own[-1] + 1 < len(wide) else self.depth
            self.queue.push(b, positions[own] - 1, prefix)
        self.least = np.minimum(self.least, wide.min())
        for b, v in seen.items():
            self.least[b] = v


def _run(text: np.ndarray, at: int, depth: int) -> int:
    part = text[at : at + depth]
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


def repeated_starts(text: np.ndarray, depth: int, memory: int = 64 << 20) -> np.ndarray:
    """True where the suffix shares its first ``depth`` bytes with another suffix.

    ``text`` holds bytes 1 .. 254, with a zero after each piece and at the end. Positions with
    fewer than ``depth`` bytes before the zero may be true for pieces that repeat in order;
    callers look at the others only.
    """
    n = len(text)
    flags = np.zeros(n, bool)
    if n < 2:
        return flags
    types = suffix_types(text)
    is_star = np.zeros(n, bool)
    is_star[1:] = types[1:] & ~types[:-1]
    words = _words(text, depth)
    kind = np.int32 if n + depth < 1 << 31 else np.int64
    stars = rank_stars(words, np.flatnonzero(is_star).astype(kind), n, depth)
    del is_star
    star_common = np.zeros(len(stars), np.int16)
    star_common[1:] = common_prefixes(words, stars[:-1], stars[1:], depth)
    del words
    star_byte = text[stars]
    begin = np.searchsorted(star_byte, np.arange(257))

    def mark(positions, common, previous):
        hit = np.flatnonzero(common >= depth)
        flags[positions[hit]] = True
        flags[positions[hit[hit > 0] - 1]] = True
        if len(hit) and hit[0] == 0 and previous is not None:
            flags[previous] = True

    left = _Scan(text, types, False, depth, memory)
    kept = BucketQueue(memory)
    for b in range(256):
        last = None
        while (got := left.queue.pop(b)) is not None:
            mark(*got, last)
            kept.push(b, *got)
            left.take(*got)
            last = int(got[0][-1])
        seeds, common = stars[begin[b] : begin[b + 1]], star_common[begin[b] : begin[b + 1]].copy()
        if len(seeds):
            common[0] = 0 if last is None else min(_run(text, last, depth), _run(text, int(seeds[0]), depth))
            left.take(seeds, common)
    left.queue.close()

    right = _Scan(text, types, True, depth, memory)
    for b in range(255, -1, -1):
        last = None
        while (got := right.queue.pop(b)) is not None:
            mark(*got, last)
            right.take(*got)
            last = int(got[0][-1])
        if (got := kept.pop(b)) is not None:
            positions, common = got[0][::-1], np.roll(got[1][::-1], 1)
            common[0] = 0 if last is None else min(_run(text, last, depth), _run(text, int(positions[0]), depth))
            if common[0] >= depth:
                flags[[last, positions[0]]] = True
            right.take(positions, common)
    kept.close()
    right.queue.close()
    return flags
