"""Token-ID output: fixed-width bit packing with block offsets.

A shard file is a header, a document index and a payload. Each id takes the least number of
bits that the vocabulary needs. Ids are packed in blocks of ``BLOCK``; each block starts at a
64-bit boundary that its offset names, so numpy unpacks a block at once and a reader opens
any range of ids without the blocks before it.

Layout, little-endian: magic (8 bytes) | bits u32 | block u32 | documents u64 | ids u64 |
doc_id i64 x documents | null flag u8 x documents | end id u64 x documents |
block offset u64 x (blocks + 1) | payload of 64-bit words.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .wordbpe import encoder, vocabulary_size

MAGIC = b"PARLEYB1"
HEAD = struct.Struct("<8sIIQQ")
#: Ids of a block; a multiple of 64, so that a block's packed ids fill whole 64-bit words.
BLOCK = 4096
#: Ids after which a task closes a shard file, at the next end of a document.
SHARD_IDS = 4_000_000
_WHOLE = {8: "<u1", 16: "<u2", 32: "<u4"}


def bits_for(vocabulary: int) -> int:
    """Least width that holds ids 0 .. vocabulary - 1."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """Ids as 64-bit words, ``bits`` each; 64 ids fill exactly ``bits`` words."""
    rows = -(-len(ids) // 64)
    if bits in _WHOLE:  # ids that fill whole bytes are an array of that type already
        whole = np.zeros(rows * 64, _WHOLE[bits])
        whole[: len(ids)] = ids
        return whole.view("<u8")
    full = np.zeros(rows * 64, np.uint64)
    full[: len(ids)] = ids
    full = full.reshape(rows, 64)
    words = np.zeros((rows, bits), np.uint64)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        words[:, word] |= full[:, j] << np.uint64(shift)
        if shift + bits > 64:
            words[:, word + 1] |= full[:, j] >> np.uint64(64 - shift)
    return words.ravel()


def unpack(words: np.ndarray, bits: int, n: int) -> np.ndarray:
    """The first ``n`` ids of packed words."""
    if bits in _WHOLE:
        return words.view(_WHOLE[bits])[:n].astype(np.uint32)
    words = words.reshape(-1, bits)
    out = np.empty((len(words), 64), np.uint64)
    mask = np.uint64((1 << bits) - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        column = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            column |= words[:, word + 1] << np.uint64(64 - shift)
        out[:, j] = column & mask
    return out.ravel()[:n].astype(np.uint32)


def encode_shard(doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray, bits: int) -> bytes:
    """A shard file's bytes; ``ends`` holds each document's end in ``ids``."""
    if bits < 64 and len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    parts = [pack(ids[i : i + BLOCK], bits) for i in range(0, len(ids), BLOCK)]
    offsets = np.concatenate([[0], np.cumsum([p.nbytes for p in parts], dtype=np.int64)]).astype("<u8")
    return b"".join(
        [
            HEAD.pack(MAGIC, bits, BLOCK, len(doc_ids), len(ids)),
            np.array([x or 0 for x in doc_ids], "<i8").tobytes(),
            np.array([x is None for x in doc_ids], "u1").tobytes(),
            ends.astype("<u8").tobytes(),
            offsets.tobytes(),
            *(p.astype("<u8", copy=False).tobytes() for p in parts),
        ]
    )


class Shard:
    """A reader of one shard file's bytes with random access by id position."""

    def __init__(self, blob: bytes) -> None:
        magic, self.bits, self.block, docs, self.n_ids = HEAD.unpack_from(blob)
        if magic != MAGIC:
            raise ValueError("not a packed token file")
        at = HEAD.size
        self.doc_ids = np.frombuffer(blob, "<i8", docs, at)
        self.nulls = np.frombuffer(blob, "u1", docs, at := at + 8 * docs)
        self.ends = np.frombuffer(blob, "<u8", docs, at := at + docs).astype(np.int64)
        blocks = -(-self.n_ids // self.block)
        self.offsets = np.frombuffer(blob, "<u8", blocks + 1, at := at + 8 * docs).astype(np.int64)
        self.at, self.blob = at + 8 * (blocks + 1), blob

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` .. ``stop``, reading only the blocks that hold them."""
        first, last = start // self.block, -(-stop // self.block)
        parts = [
            unpack(
                np.frombuffer(self.blob, "<u8", (self.offsets[b + 1] - self.offsets[b]) // 8, self.at + self.offsets[b]),
                self.bits,
                min(self.block, self.n_ids - b * self.block),
            )
            for b in range(first, last)
        ]
        got = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        return got[start - first * self.block : stop - first * self.block]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col="doc_id", text_col="text") -> DataFrame:
    """Encode documents in ascending ``id_col`` order (ties by text) into shard files in ``path``.

    Returns the manifest, read back from storage: shard, part, seq, n_docs, n_ids. A null text
    counts as empty; a null id comes first. Files are moved into place whole, so that a task
    that runs again overwrites its own files with the same bytes.
    """
    bits = bits_for(max(vocabulary_size(tokenizer), end_id + 1))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq = encoder(tokenizer), TaskContext.get().partitionId(), 0
        tail = np.array([end_id], "<u4").tobytes()
        doc_ids, ends, chunks, total = [], [], [], 0

        def close():
            nonlocal seq, doc_ids, ends, chunks, total
            name = f"{part:08d}-{seq:06d}.bin"
            ids = np.frombuffer(b"".join(chunks), "<u4")
            common.write_blob(path, name, encode_shard(doc_ids, np.array(ends, np.int64), ids, bits))
            row = pa.RecordBatch.from_pydict({"shard": [name], "part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "n_docs": [len(doc_ids)], "n_ids": [total]})
            seq, doc_ids, ends, chunks, total = seq + 1, [], [], [], 0
            return row

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = enc.encode(text or "") + tail
                total += len(raw) // 4
                doc_ids.append(doc_id)
                ends.append(total)
                chunks.append(raw)
                if total >= SHARD_IDS:
                    yield close()
        if doc_ids:
            yield close()

    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    return common.stored(common.map_arrow(ordered, "shard string, part int, seq int, n_docs long, n_ids long", write), "manifest")


def read_tokens(manifest: DataFrame, path: str) -> DataFrame:
    """Documents of the shard files: doc_id, start, n_tokens, ids_crc32, all from the files.

    ``start`` adds the ids of all shards before, from the manifest (one row for each file).
    """
    spark = manifest.sparkSession
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("shard_start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                shard = Shard(blob.as_buffer().to_pybytes())
                starts = np.concatenate([[0], shard.ends[:-1]]).astype(np.int64)
                n = len(starts)
                for i in range(0, n, 4096):
                    j = min(n, i + 4096)
                    base = int(starts[i])
                    ids = shard.ids(base, int(shard.ends[j - 1])).astype("<u4")
                    crcs = [zlib.crc32(ids[a - base : b - base]) for a, b in zip(starts[i:j].tolist(), shard.ends[i:j].tolist())]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "shard": [name] * (j - i),
                            "doc_id": pa.array(shard.doc_ids[i:j], mask=shard.nulls[i:j].astype(bool)),
                            "local": starts[i:j],
                            "n_tokens": shard.ends[i:j] - starts[i:j],
                            "ids_crc32": pa.array(crcs, pa.int64()),
                        }
                    )

    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(path)
    files = files.select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content")
    rows = common.map_arrow(files, "shard string, doc_id long, local long, n_tokens long, ids_crc32 long", read)
    return rows.join(starts, "shard").select("doc_id", (F.col("shard_start") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
