"""Removal of repeated byte strings by sharded, externally sorted suffixes.

Every ``WINDOW``-byte string of the corpus has an anchor that its copies share, so strings
are gathered by anchor: a run is a stretch of strings of one document with one anchor. Equal
runs get one name, as equal substrings do in induced sorting, and a name that occurs under no
second wording of its anchor needs no further sorting. The other names' bytes are sorted,
shard by shard, with :mod:`induced`; strings that share ``WINDOW`` bytes with a neighbour in
suffix order are repeats. Matches are judged on the input and never cross documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .anchors import anchor_runs
from .induced import repeated_starts

WINDOW = 200
#: Wordings of one anchor that one sort takes. An anchor with more (the edge of a passage that
#: very many documents share) is resolved string by string, over the whole cluster.
WORDINGS = 50_000
#: Bytes of runs that one induced sort takes, closed at the next anchor.
SHARD_BYTES = 4 << 20


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc (id), mark (hash of the text) and text; rows alike in both have the same repeats."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc = F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))
    return docs.select(doc.alias("doc"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _runs(keyed: DataFrame, window: int) -> DataFrame:
    """doc, mark, first, n, key (anchor) and name (hash of the run's bytes) of every run."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            data, at = common.utf8_parts(batch.column(2))
            view = memoryview(data)
            out: list[list] = [[], [], [], [], [], []]
            for i, (doc, mark) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                lo = int(at[i])
                first, n, key = anchor_runs(data[lo : at[i + 1]], window)
                names = [digest(view[a : a + m + window - 1]) for a, m in zip((first + lo).tolist(), n.tolist())]
                for column, values in zip(out, (np.full(len(n), doc), np.full(len(n), mark), first, n, key.view(np.int64), np.array(names, np.uint64).view(np.int64))):
                    column.append(values)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in out], names=["doc", "mark", "first", "n", "key", "name"])

    return common.map_large(keyed, "doc long, mark long, first long, n long, key long, name long", cut)


def _sorted_shard(rows: list[tuple], window: int) -> Iterator[tuple]:
    """doc, mark, first and repeated stretches (from, to) of starts, for rows of a name that occurs once.

    Names that occur more often are repeats as a whole and only lend their bytes.
    """
    raws = [np.frombuffer(r[3], np.uint8) for r in rows]
    sizes = np.array([len(r) for r in raws])
    text = np.zeros(int(sizes.sum()) + len(rows), np.uint8)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    for raw, b in zip(raws, begins):
        text[b : b + len(raw)] = raw + 1  # zero ends a run
    flags = repeated_starts(text, window)
    for (_, _, copies, _, *at), b, size in zip(rows, begins, sizes):
        own = flags[b : b + size - window + 1]
        edge = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
        if len(edge) and copies == 1:
            yield *at, edge[::2].tolist(), edge[1::2].tolist()


def _repeats(segments: DataFrame, window: int) -> DataFrame:
    """Repeated stretches of the names that occur once, from rows of key, name, copies, bytes, doc, mark and first."""

    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        types = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2
        columns = list(zip(*found)) if found else [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc", "mark", "first", "from", "to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(7))):
                if last == row[:2]:
                    continue  # the same name fetched from a row that occurs again
                if size >= SHARD_BYTES and last[0] != row[0]:
                    yield batch_of(list(_sorted_shard(rows, window)))
                    rows, size = [], 0
                rows.append(row)
                size += len(row[3])
                last = row[:2]
        if rows:
            yield batch_of(list(_sorted_shard(rows, window)))

    ordered = segments.repartition("key").sortWithinPartitions("key", "name")
    return common.map_large(ordered, "doc long, mark long, first long, `from` array<long>, `to` array<long>", run)


def _repeats_by_string(segments: DataFrame, window: int) -> DataFrame:
    """The same as :func:`_repeats`, with each string of a run a row under its 128-bit hash."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for i in range(batch.num_rows):
                copies, raw, doc, mark, first = (batch.column(k)[i].as_py() for k in range(2, 7))
                n = len(raw) - window + 1
                halves = np.frombuffer(b"".join([digest(raw[j : j + window]) for j in range(n)]), ">i8").reshape(n, 2).astype(np.int64)
                same = {c: pa.array([x] * n, pa.int64()) for c, x in (("copies", copies), ("doc", doc), ("mark", mark), ("first", first))}
                yield pa.RecordBatch.from_pydict(same | {"at": np.arange(n), "h": halves[:, 0], "g": halves[:, 1]})

    rows = common.stored(common.map_arrow(segments.dropDuplicates(["key", "name"]), "copies long, doc long, mark long, first long, at long, h long, g long", explode), "strings")
    twice = common.stored(rows.groupBy("h", "g").agg(F.sum("copies").alias("total")).where("total > 1").select("h", "g"), "twice")
    hit = rows.where("copies = 1").join(twice, ["h", "g"]).groupBy("doc", "mark", "first").agg(F.collect_set("at").alias("at"))  # a run's length bounds its set
    return hit.select("doc", "mark", "first", F.col("at").alias("from"), F.transform("at", lambda x: x + 1).alias("to"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc, mark and spans (from, to) of bytes that a repeated ``window``-byte string covers."""
    spark = docs.sparkSession
    keyed = _keyed(docs, id_col, text_col)
    runs = common.stored(_runs(keyed, window), "runs")
    keys = runs.groupBy("key").agg(F.count("*").alias("total"), F.min("name").alias("low"), F.max("name").alias("high")).where("total > 1")
    keys = common.stored(keys, "keys")  # a side of its own in the join, so that a hot anchor's runs can be split
    held = common.stored(runs.join(keys, "key").select("doc", "mark", "first", "n", "key", "name", (F.col("low") != F.col("high")).alias("mixed")), "held")
    common.delete_dir(spark, runs.inputFiles()[0].rsplit("/", 1)[0]) if runs.inputFiles() else None

    names = held.where("mixed").groupBy("key", "name").agg(F.count("*").alias("copies"), F.min(F.struct("doc", "mark", "first", "n")).alias("at"))
    names = common.stored(names.select("key", "name", "copies", "at.*"), "names")
    crowded = common.stored(names.groupBy("key").agg(F.count("*").alias("wordings")).where(F.col("wordings") > WORDINGS).select("key", F.lit(True).alias("crowded")), "crowded")
    wanted = names.join(crowded, "key", "left")
    raw = F.substring(F.col("text").cast("binary"), F.col("first").cast("int") + 1, F.col("n").cast("int") + F.lit(window - 1))
    segments = wanted.join(keyed, ["doc", "mark"]).select("key", "name", "copies", raw.alias("bytes"), "doc", "mark", "first", "crowded")
    sorted_ = _repeats(segments.where("crowded is null").drop("crowded"), window)
    if not crowded.isEmpty():
        sorted_ = sorted_.unionByName(_repeats_by_string(segments.where("crowded").drop("crowded"), window))
    found = common.stored(sorted_, "repeats")

    # a name that occurs more than once is repeated as a whole, wherever it stands
    once = names.where("copies = 1").select("key", "name", F.lit(True).alias("once"))
    whole = held.join(once, ["key", "name"], "left").where("once is null").select("doc", "mark", F.col("first").alias("from"), (F.col("first") + F.col("n") + window - 1).alias("to"))
    part = (
        found.select("doc", "mark", "first", F.explode(F.arrays_zip("from", "to")).alias("s"))
        .select("doc", "mark", (F.col("first") + F.col("s.from")).alias("from"), (F.col("first") + F.col("s.to") + window - 1).alias("to"))
    )
    # a document's own runs bound its set; rows that occur again add nothing to it
    return whole.unionByName(part).groupBy("doc", "mark").agg(F.collect_set(F.struct("from", "to")).alias("spans"))


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((s["from"], s["to"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _with_spans(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    side = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64(text).alias("mark"), text.alias("text"), *more)
    return side.join(spans, ["doc", "mark"], "left")


def digest(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256, a row for each input row; null text is empty."""
    spans = repeated_spans(docs, window, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, spans in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                cuts, kept, at = _merged(spans or []), [], 0
                for a, b in cuts:
                    kept.append(text[at:a])
                    at = b
                kept = b"".join([*kept, text[at:]])
                rows.append((doc_id, len(text), len(text) - len(kept), len(cuts), hashlib.sha256(kept).hexdigest()))
            types = [pa.int64()] * 4 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 5, types)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = _with_spans(docs, spans, id_col, text_col, F.col(id_col).cast("long").alias("doc_id")).select("doc_id", "text", "spans")
    return common.map_arrow(rows, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", run)


def without_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with repeated strings taken out of their texts, and all other columns.

    Bytes of a character that a span's edge would split stay in the text. A row whose text is
    left as it was (no repeats, or null) comes back unchanged; ``n_chars`` follows the text.
    """
    spans = repeated_spans(docs, window, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist()):
                kept, at = [], 0
                for a, b in _merged(spans or []):
                    while a < b and text[a] & 0xC0 == 0x80:
                        a += 1
                    while b > a and b < len(text) and text[b] & 0xC0 == 0x80:
                        b -= 1
                    kept.append(text[at:a])
                    at = b
                out.append((b"".join(kept) + text[at:]).decode("utf-8"))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.string())], names=["row", "text"])

    rows = _with_spans(docs, spans, id_col, text_col, common.row_of(docs)).select("row", "text", "spans")
    kept = common.map_arrow(rows, common.schema_of(rows, ["row"], "text string"), run)
    changed = F.col(f"row.{text_col}").isNotNull() & (F.col("text") != F.col(f"row.{text_col}"))
    columns = []
    for c in docs.columns:
        value = F.col(f"row.`{c}`")
        if c == text_col:
            value = F.when(changed, F.col("text")).otherwise(value)
        elif c == "n_chars":
            value = F.when(changed, F.length("text").cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return kept.select(*columns)
