"""CRC-32 of runs of neighbouring words, for all runs of a stretch of text at once.

A CRC is linear: the state after reading A and then B is the state after A, moved on by the
length of B, xor the state after B alone from zero. So each word is read once, and the runs
that end with it follow from tables that move a state on by so many bytes.
"""

from __future__ import annotations

import zlib
from functools import cache

import numpy as np

START = np.uint32(0xFFFFFFFF)
#: Words up to this length are read column by column, longer ones by zlib, one at a time.
SHORT = 64


@cache
def _bytes() -> np.ndarray:
    """State after one byte, for each low byte of the state."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, np.uint32(0xEDB88320) ^ (out >> 1), out >> 1)
    return out


def _apply(tables: np.ndarray, state: np.ndarray) -> np.ndarray:
    """One (4, 256) table for all states, or a table for each state."""
    parts = [(state >> np.uint32(8 * k)) & np.uint32(255) for k in range(4)]
    picked = [tables[k][p] if tables.ndim == 2 else tables[:, k][np.arange(len(p)), p] for k, p in enumerate(parts)]
    return picked[0] ^ picked[1] ^ picked[2] ^ picked[3]


@cache
def _moves() -> np.ndarray:
    """(SHORT + 1, 4, 256): states of one byte each, moved on by 0 to SHORT zero bytes."""
    now = np.arange(256, dtype=np.uint32)[None] << (np.uint32(8) * np.arange(4, dtype=np.uint32))[:, None]
    out = [now]
    for _ in range(SHORT):
        now = _bytes()[now & np.uint32(255)] ^ (now >> np.uint32(8))
        out.append(now)
    return np.stack(out)


@cache
def _doubled(k: int) -> np.ndarray:
    """The move by SHORT * 2**k bytes."""
    if k == 0:
        return _moves()[SHORT]
    half = _doubled(k - 1)
    return np.stack([_apply(half, half[j]) for j in range(4)])


def moved(state: np.ndarray, by: np.ndarray) -> np.ndarray:
    """States after ``by`` more zero bytes each."""
    flat, low = _moves().reshape(-1), (by % SHORT).astype(np.int64) * 1024
    out = flat[low + (state & 255)] ^ flat[low + 256 + ((state >> 8) & 255)] ^ flat[low + 512 + ((state >> 16) & 255)] ^ flat[low + 768 + (state >> 24)]
    left, k = by // SHORT, 0
    while left.any():
        at = np.flatnonzero(left & 1)
        if len(at):
            out[at] = _apply(_doubled(k), out[at])
        left, k = left >> 1, k + 1
    return out


def word_states(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """State after each word from zero."""
    state, table = np.zeros(len(begin), np.uint32), _bytes()
    order = np.argsort(size, kind="stable")
    ends = np.searchsorted(size[order], np.arange(1, SHORT + 1))
    stop = int(np.searchsorted(size[order], SHORT, side="right"))
    for j in range(SHORT):
        at = order[ends[j] : stop]
        if not len(at):
            break
        now = state[at]
        state[at] = table[(now ^ data[begin[at] + j]) & np.uint32(255)] ^ (now >> np.uint32(8))
    if stop < len(order):
        far = order[stop:]
        whole = np.array([zlib.crc32(data[begin[i] : begin[i] + size[i]]) for i in far], np.uint32)
        state[far] = whole ^ START ^ moved(np.full(len(far), START), size[far])
    return state


def run_crcs(data: np.ndarray, begin: np.ndarray, size: np.ndarray, owner: np.ndarray, longest: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1 to ``longest`` words of one owner, joined by one space: first word and unsigned CRC-32."""
    alone, first = word_states(data, begin, size), np.arange(len(begin))
    state = moved(np.full(len(begin), START), size) ^ alone
    out = [(first, ~state)]
    for k in range(1, longest):
        at = np.flatnonzero(first + k < len(begin))
        at = at[owner[first[at] + k] == owner[first[at]]]
        first, now = first[at], state[at]
        now = _bytes()[(now ^ np.uint32(32)) & np.uint32(255)] ^ (now >> np.uint32(8))
        state = moved(now, size[first + k]) ^ alone[first + k]
        out.append((first, ~state))
    return out
