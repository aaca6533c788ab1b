"""Importance resampling towards a target distribution.

Hashed features of words and of runs of two and three words are counted over all documents
and over the target's texts. The gain of each bucket is one array, so a document's weight is
a sum of array entries. A seeded double exponential turns weights into scores whose greatest
are a draw without replacement, and ranks come from parallel sorting by regular sampling:
sorted runs give regular splitters, rows go to the segments between splitters, each segment
is merged by itself, and the counts of the segments before it make its ranks exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .crcruns import run_crcs

BUCKETS = 10_000
LONGEST = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Rows between the samples of a sorted run; runs of large inputs take fewer, so that about SAMPLES come back.
STEP, SAMPLES = 64, 1 << 18
#: Segments between splitters, at most, and the rows that one should hold.
SEGMENTS, SEGMENT_ROWS = 4096, 4096

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORD = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])


def _features(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """For stretches of rows: their bounds, words of each row, and row and bucket of the features by length."""
    raw, at = common.utf8_parts(column)
    for i, j in common.small_parts(np.diff(at)):
        data = np.frombuffer(raw[at[i] : at[j]].tobytes().translate(_LOWER), np.uint8)
        inside = _WORD[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cuts = at[i:j] - at[i]
        cuts = cuts[cuts < len(data)]
        begins[cuts] |= inside[cuts]  # a word does not go on in the next row
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | begins[1:]
        begin = np.flatnonzero(begins)
        size = np.flatnonzero(ends) + 1 - begin
        owner = np.searchsorted(at[i : j + 1] - at[i], begin, side="right") - 1
        runs = run_crcs(data, begin, size, owner, LONGEST)
        yield i, j, np.bincount(owner, minlength=j - i), [(owner[first], crc % np.uint32(BUCKETS)) for first, crc in runs]


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features in each bucket over all rows of ``text``; nulls hold none."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for _, _, _, runs in _features(batch.column(0).fill_null("")):
                for _, bucket in runs:
                    sums += np.bincount(bucket, minlength=BUCKETS)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(sums[at])], names=["bucket", "n"])

    rows = common.map_arrow(texts.select("text"), "bucket int, n long", counted).groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BUCKETS, np.int64)
    for r in rows:  # no more than BUCKETS
        out[r["bucket"]] = r["n"]
    return out


def gains(docs: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's gain: thousandths of the log ratio of the smoothed shares, rounded down."""
    all_docs, all_target, n = int(docs.sum()), int(target.sum()), len(docs)
    return np.array([math.floor(1000 * math.log((t + 1) * (all_docs + n) / ((s + 1) * (all_target + n)))) for s, t in zip(docs.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """A document's seeded share of the score; a null id reads as an empty one."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, weight = (np.zeros(len(batch), np.int64) for _ in range(3))
            for i, j, n, runs in _features(batch.column(1).fill_null("")):
                words[i:j] = n
                for owner, bucket in runs:
                    features[i:j] += np.bincount(owner, minlength=j - i)
                    total = np.concatenate([[0], np.cumsum(gain[bucket])])
                    cut = np.searchsorted(owner, np.arange(j - i + 1))
                    weight[i:j] += total[cut[1:]] - total[cut[:-1]]
            chance = np.array([noise(x, seed) for x in batch.column(0).to_pylist()], np.int64)
            columns = [batch.column(0), *(pa.array(x) for x in (words, features, weight, weight + chance))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return common.map_arrow(rows, "doc_id long, n_words long, n_features long, weight long, score long", scored)


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    """(greatest score, smallest id, smallest row) as 24 bytes that sort alike; a null id comes last."""
    score = (~batch.column("score").to_numpy(zero_copy_only=False)).view(np.uint64)
    ids = batch.column("doc_id").fill_null((1 << 63) - 1).to_numpy(zero_copy_only=False).view(np.uint64)
    row = batch.column("row").to_numpy(zero_copy_only=False).view(np.uint64)
    out = np.stack([score ^ np.uint64(1 << 63), ids ^ np.uint64(1 << 63), row], axis=1).astype(">u8")
    return np.ascontiguousarray(out).view("S24").reshape(-1)


def _order() -> tuple[Column, ...]:
    return F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()


def splitters(rows: DataFrame, n_rows: int) -> np.ndarray:
    """Keys that cut ``rows`` (doc_id, score, row) into segments, from regular samples of sorted runs.

    Samples lie ``step`` rows apart in each run, so a segment holds at most about ``step`` rows of
    each run more than its share. The step grows with the input: about SAMPLES keys come back.
    """
    step = max(STEP, -(-n_rows // SAMPLES))

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            keys = _keys(batch)[(-seen - 1) % step :: step]
            seen += len(batch)
            yield pa.RecordBatch.from_arrays([pa.array([k.ljust(24, b"\0") for k in keys.tolist()], pa.binary())], names=["key"])

    runs = rows.sortWithinPartitions(*_order())
    keys = np.sort(np.array([bytes(r["key"]) for r in common.map_arrow(runs, "key binary", sampled).collect()], "S24"))
    segments = min(SEGMENTS, -(-n_rows // SEGMENT_ROWS), len(keys) + 1)
    return keys[[len(keys) * k // segments for k in range(1, segments)]]


def ranked(rows: DataFrame, cut: np.ndarray, drawn: int) -> DataFrame:
    """``rows`` with rank: 1, 2, 3 ... for the ``drawn`` first ones, null for the others.

    Only segments that hold a drawn row are exchanged and merged.
    """
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("segment", pa.array(np.searchsorted(cut, _keys(batch), side="right"), pa.int32()))

    held = common.map_arrow(rows, common.schema_of(rows, rows.columns, "segment int"), placed)
    counts = np.zeros(len(cut) + 1, np.int64)
    for r in held.groupBy("segment").count().collect():  # no more than SEGMENTS
        counts[r["segment"]] = r["count"]
    before = np.cumsum(counts) - counts
    last = int(np.searchsorted(before, drawn)) - 1  # the last segment that begins before all are drawn
    offsets = F.array(*(F.lit(int(n)) for n in before[: last + 1])) if last >= 0 else F.array(F.lit(0))
    merged = Window.partitionBy("segment").orderBy(*_order())
    rank = F.get(offsets, F.col("segment")).cast("long") + F.row_number().over(merged)
    inside = held.where(F.col("segment") <= last).withColumn("rank", rank).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    outside = held.where(F.col("segment") > last).withColumn("rank", F.lit(None).cast("long"))
    return inside.unionByName(outside).drop("segment")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``, drawn towards ``target``.

    Drawn are the floor(percent / 100) of the rows with at least ``least_words`` words that score
    highest, ties to the smaller doc_id (null last), then to the earlier row; equal rows are rows
    like others. Null and empty texts have no features, weight 0 and no rank. Long texts are
    counted whole, a stretch of rows at a time. An empty table gives no rows, an empty target
    smoothed shares alone. Other columns are not read.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scored = common.stored(weighed(docs, gain, seed).withColumn("row", F.monotonically_increasing_id()), "weights")
    able = scored.where(F.col("n_words") >= least_words)
    n = able.count()
    drawn = percent * n // 100
    columns = ("doc_id", "n_features", "weight", "score", "rank")
    short = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    if not drawn:
        return scored.withColumn("rank", F.lit(None).cast("long")).select(*columns)
    cut = splitters(able.select("doc_id", "score", "row"), n)
    return ranked(able, cut, drawn).unionByName(short).select(*columns)


def oracle() -> str:
    """The same draw over tables ``documents`` and ``benchmark`` as DuckDB SQL; CRC-32 goes byte by byte."""
    step = "CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END"
    return rf"""
    WITH RECURSIVE bits AS (
      SELECT i AS b, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
      UNION ALL SELECT b, {step}, k + 1 FROM bits WHERE k < 8
    ), crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
    texts AS (
      SELECT 'd' AS side, doc_id AS id, coalesce(text, '') AS text FROM documents
      UNION ALL SELECT 'b', row_number() OVER (), coalesce(text, '') FROM benchmark
    ), words AS (
      SELECT side, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
    ), f AS (
      SELECT side, id, unnest(w) AS f FROM words
      UNION ALL SELECT side, id, unnest([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) FROM words
      UNION ALL SELECT side, id, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)]) FROM words
    ), counted AS (SELECT side, id, f, count(*) AS n FROM f GROUP BY ALL),
    hashed AS (
      SELECT f, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, [('0x' || substr(hex(encode(f)), 2 * i - 1, 2))::BIGINT FOR i IN range(1, octet_length(encode(f)) + 1)]),
        lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1]))) % {BUCKETS} AS bucket
      FROM (SELECT DISTINCT f FROM counted), crc
    ), placed AS (SELECT side, id, bucket, sum(n)::BIGINT AS n FROM counted JOIN hashed USING (f) GROUP BY ALL),
    sums AS (
      SELECT b AS bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::BIGINT AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::BIGINT AS t
      FROM range({BUCKETS}) r(b) LEFT JOIN placed ON bucket = b GROUP BY b
    ), gains AS (
      SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM sums) + {BUCKETS})::DOUBLE / ((s + 1) * ((SELECT sum(t) FROM sums) + {BUCKETS}))))::BIGINT AS gain FROM sums
    ), weights AS (SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM placed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
    scored AS (
      SELECT d.id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) AS n_words,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || d.id), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
      FROM (SELECT id, w FROM words WHERE side = 'd') d LEFT JOIN weights USING (id)
    ), ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_words >= {LEAST_WORDS})
    SELECT doc_id, n_features::BIGINT AS n_features, weight, score, CASE WHEN r <= {PERCENT} * n // 100 THEN r END::BIGINT AS rank
    FROM scored LEFT JOIN ranks USING (doc_id)
    """
