"""Session, storage and Arrow helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows and bytes of an Arrow batch handed to Python. Whole texts travel in these batches, so
#: the defaults of 10,000 rows and 64 MB would hold too much when documents are long.
BATCH_ROWS, BATCH_BYTES = 256, 4 << 20

DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables, read with batches small enough for whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which driver and executors share.

    Where the session names none (tests on one machine) a temporary folder is set.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="parley-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder of the shared storage through Hadoop's file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_blob(path: str, name: str, blob: bytes) -> None:
    """Store one file whole: written under another name, then moved. A file that a run before left is replaced."""
    fs, root = pafs.FileSystem.from_uri(path)
    fs.create_dir(root, recursive=True)
    part, whole = f"{root}/_{name}.{uuid.uuid4().hex}", f"{root}/{name}"
    with fs.open_output_stream(part) as out:
        out.write(blob)
    if fs.get_file_info(whole).type != pafs.FileType.NotFound:
        fs.delete_file(whole)  # not every file system moves onto a file
    fs.move(part, whole)


def row_of(df: DataFrame) -> Column:
    """All columns, whatever their names, as one struct named ``row``; functions of tasks then pass it on whole."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row")


def schema_of(df: DataFrame, names: list[str], more: str = "") -> StructType:
    """The types of ``names`` in ``df``, then the fields of ``more``: names need no quoting."""
    return StructType([*(df.schema[n] for n in names), *(StructType.fromDDL(more).fields if more else [])])


def map_arrow(
    df: DataFrame, schema: str | StructType, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    return df.mapInArrow(fn, schema)


def release() -> None:
    """Hand memory that is free back to the system: a worker serves task after task, and its allocators keep what one freed."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's; others need none
    if trim:
        trim(0)


def map_large(
    df: DataFrame, schema: str | StructType, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> DataFrame:
    """:func:`map_arrow` for tasks that hold much at once: none starts or ends with free memory held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from fn(batches)
        release()

    return map_arrow(df, schema, run)


def utf8_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows, without copying."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    big = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    width = np.int64 if big else np.int32
    _, offsets, data = column.buffers()
    if offsets is None:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def small_parts(sizes: np.ndarray, most: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Bounds of stretches of rows of at most ``most`` bytes together; a larger row is one by itself.

    Batches have a number of rows, so long texts would otherwise multiply what a task holds at once.
    """
    begin, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch, null read as empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def crc32_text(column: Column | str) -> Column:
    """Unsigned crc32 of a value's text form."""
    return F.crc32(F.col(column).cast("string") if isinstance(column, str) else column.cast("string"))
