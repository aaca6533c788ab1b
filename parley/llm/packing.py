"""Packing documents into training sequences along a space-filling curve.

Each document's hashed byte-gram vector is projected to three dimensions; the Hilbert key of
that point orders the corpus, so that documents with like wording are packed next to each
other. The curve is cut into ranges of like size and each task cuts its range
into full sequences. What is left at the end of a stretch is cut into sequences whose lengths
are powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .wordbpe import encoder

DIMS, ORDER = 3, 16
BUCKETS = 512
#: Bytes of text of one range of the curve, which one task packs; more where there would be more than so many ranges.
RANGE_BYTES, MOST_RANGES = 16 << 20, 100_000
#: Documents that say where ranges are cut: for each range, and in all. It sets the tasks' sizes, and what is packed together only at their ends.
RANGE_SAMPLE, SAMPLE_ROWS = 100, 200_000
_NULL_ID = -(1 << 63)
#: Sequences of one task are numbered from its partition's number times this.
SEQUENCES = 1 << 40


def document_vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Root counts of hashed 3-byte grams, as unit vectors; a text without one is zero."""
    n = len(offsets) - 1
    if len(data) < 3:
        return np.zeros((n, BUCKETS), np.float32)
    wide = data.astype(np.uint32)
    gram = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
    bucket = (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS.bit_length() + 1)
    owner = np.repeat(np.arange(n), np.diff(offsets))[:-2]
    inside = np.arange(len(gram)) + 3 <= offsets[owner + 1]
    counts = np.bincount(owner[inside] * BUCKETS + bucket[inside], minlength=n * BUCKETS)
    v = np.sqrt(counts.reshape(n, BUCKETS)).astype(np.float32)
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)


def hilbert_keys(points: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Hilbert index of each row of unsigned coordinates below 2 ** order."""
    x = points.astype(np.uint64).T.copy()
    dims, one = len(x), np.uint64(1)
    for b in range(order - 1, 0, -1):
        bit = one << np.uint64(b)
        low = bit - one
        for i in range(dims):
            up = (x[i] & bit) != 0
            swap = np.where(up, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(order - 1, 0, -1):
        bit = one << np.uint64(b)
        turn ^= np.where((x[-1] & bit) != 0, bit - one, np.uint64(0))
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(order - 1, -1, -1):
        for i in range(dims):
            key = key << one | (x[i] >> np.uint64(b)) & one
    return key.astype(np.int64)


def curve_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Hilbert keys of a batch of texts, given as bytes and row offsets."""
    plane = np.random.default_rng(7).standard_normal((BUCKETS, DIMS)).astype(np.float32)
    spread = 0.5 + 0.5 * np.tanh(document_vectors(data, offsets) @ plane)
    return hilbert_keys(np.minimum(spread * (1 << ORDER), (1 << ORDER) - 1).astype(np.uint64))


def with_curve_key(docs: DataFrame, key: str = "curve_key") -> DataFrame:
    """doc_id, text and the document's place on the curve; a null text counts as empty."""
    return _keyed(docs, np.zeros((0, 2), np.int64), key).drop("range")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def _keyed(docs: DataFrame, cuts: np.ndarray, key: str) -> DataFrame:
    """doc_id, text, key and range: how many of the ``cuts`` (key, doc_id) a row does not come before."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = common.utf8_parts(batch.column(1))
            parts = [curve_keys(data[at[i] : at[j]], at[i : j + 1] - at[i]) for i, j in common.small_parts(np.diff(at))]
            keys = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            low, high = (np.searchsorted(cuts[:, 0], keys, side) for side in ("left", "right"))
            if (low != high).any():  # copies of one text share a key: ids tell them apart
                ids = np.array([_NULL_ID if i is None else i for i in batch.column(0).to_pylist()], np.int64)
                for r in np.flatnonzero(low != high):
                    low[r] += np.searchsorted(cuts[low[r] : high[r], 1], ids[r], "right")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys), pa.array(low.astype(np.int32))], names=["doc_id", "text", key, "range"])

    return common.map_arrow(_plain(docs), f"doc_id long, text string, {key} long, range int", keyed)


def curve_cuts(docs: DataFrame) -> np.ndarray:
    """Places (key, doc_id) that cut the curve into ranges of about equal bytes, from a bounded sample of documents."""
    row = _plain(docs).agg(F.count("*").alias("n"), F.sum(F.octet_length("text").cast("long") + 1).alias("bytes")).first()
    ranges = -(-(row["bytes"] or 0) // max(RANGE_BYTES, (row["bytes"] or 0) // MOST_RANGES))
    if ranges < 2:
        return np.zeros((0, 2), np.int64)
    share = min(1.0, min(SAMPLE_ROWS, ranges * RANGE_SAMPLE) / row["n"])
    some = docs if share == 1 else docs.sample(fraction=share, seed=7)
    rows = with_curve_key(some).select("curve_key", F.coalesce("doc_id", F.lit(_NULL_ID)).alias("doc_id"), F.octet_length("text").alias("bytes")).toPandas()
    rows = rows.sort_values(["curve_key", "doc_id"], ignore_index=True)
    filled = rows["bytes"].cumsum() / max(1, rows["bytes"].sum())
    at = np.searchsorted(filled, np.arange(1, ranges) / ranges)
    return rows.loc[np.unique(at[at < len(rows)]), ["curve_key", "doc_id"]].to_numpy(np.int64)


def powers_of_two(n: int) -> list[int]:
    """n as a sum of distinct powers of two, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Cuts a stream of documents into sequences of ``size`` ids, and the rest by powers of two."""

    def __init__(self, size: int, first_sequence: int) -> None:
        self.size, self.sequence, self.used = size, first_sequence, 0
        self.open: list[tuple] = []  # doc_id, start, ids, doc_tokens of the unfinished sequence

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        start, n = 0, len(ids)
        while start < n:
            take = min(self.size - self.used, n - start)
            self.open.append((doc_id, start, ids[start : start + take], n))
            self.used += take
            start += take
            if self.used == self.size:
                yield from self._close(self.size)

    def finish(self) -> Iterator[tuple]:
        for length in powers_of_two(self.used):
            yield from self._close(length)

    def _close(self, length: int) -> Iterator[tuple]:
        offset, left = 0, []
        for doc_id, start, ids, n in self.open:
            take = min(len(ids), length - offset)
            if take:
                yield doc_id, start, take, zlib.crc32(ids[:take]), n, self.sequence, offset
                offset += take
            if take < len(ids):
                left.append((doc_id, start + take, ids[take:], n))
        self.open, self.used, self.sequence = left, self.used - length, self.sequence + 1


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
PIECE_TYPES = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, size: int = 2048) -> DataFrame:
    """Pieces of sequences of at most ``size`` ids; each id of each document is in one piece.

    A document's ids end with ``end_id``, so null and empty texts give one id. Repeated rows
    are packed each on their own, and extra columns are left out. Padding is zero: sequences
    are full, or as long as a power of two.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, tail = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        packer = Packer(size, TaskContext.get().partitionId() * SEQUENCES)
        rows: list[tuple] = []

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=PIECE_TYPES)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += packer.add(doc_id, np.frombuffer(enc.encode(text) + tail, "<u4"))
            if len(rows) >= 4096:
                yield batch_of(rows)
                rows = []
        rows += packer.finish()
        if rows:
            yield batch_of(rows)

    key, cuts = "curve_key", curve_cuts(docs)
    ranged = _keyed(docs, cuts, key).repartitionById(len(cuts) + 1, F.col("range"))
    ordered = ranged.sortWithinPartitions(key, "doc_id", "text")
    return common.map_arrow(ordered.select("doc_id", "text"), PIECES, cut)
