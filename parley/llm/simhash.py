"""SimHash near-duplicates, linked by multi-index hashing.

Fingerprints are cut into segments. Two fingerprints within ``DISTANCE`` bits differ in some
segment by at most that segment's radius, because the radii's successors add up to more than
``DISTANCE``. One side looks up the small Hamming ball around each segment's value, the other
its exact values, and every table match is verified over all bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .components import components

DISTANCE = 4
#: (lowest bit, bits, radius) of each segment.
SEGMENTS = ((0, 21, 1), (21, 21, 1), (42, 22, 0))
SHINGLE_WORDS, SEED = 4, 42
#: Shingles whose bits are counted at once.
_BLOCK = 16_384


def fingerprint(text: str, width: int = SHINGLE_WORDS) -> int:
    """Majority of the bits of the text's shingle hashes; zero for a text without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    stops = ends[width - 1 :] if len(words) >= width else ends[-1:]
    digest, seed = xxhash.xxh64_intdigest, SEED
    ones = np.zeros(64, np.int64)
    for k in range(0, n, _BLOCK):
        a, b = starts[k : min(n, k + _BLOCK)].tolist(), stops[k : k + _BLOCK].tolist()
        h = np.array([digest(joined[i:j], seed) for i, j in zip(a, b)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long); null text counts as empty."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t) for t in common.texts_of(batch)], "u8").view("i8")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return common.map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text_col).alias("text")), "doc_id long, fp long", hashed)


def _part(fp: Column, segment: tuple[int, int, int]) -> Column:
    low, bits, _ = segment
    return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << bits) - 1))


def _apart(a: Column, b: Column, segment: tuple[int, int, int] | None = None) -> Column:
    bits = a.bitwiseXOR(b)
    return F.bit_count(_part(bits, segment) if segment else bits)


def _segments(fp: Column) -> Column:
    return F.array(*(F.struct(F.lit(i).alias("seg"), _part(fp, s).alias("key")) for i, s in enumerate(SEGMENTS)))


def _balls(fp: Column) -> Column:
    """All values within a segment's radius of the fingerprint's own, for each segment."""
    return F.array(
        *(
            F.struct(F.lit(i).alias("seg"), _part(fp, s).bitwiseXOR(F.lit(flip).cast("long")).alias("key"))
            for i, s in enumerate(SEGMENTS)
            for flip in [0, *((1 << b for b in range(s[1])) if s[2] else ())]
        )
    )


def star_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs (u, v) within ``DISTANCE`` bits, v having the smallest fingerprint of a segment's value that both share."""
    fp = F.col("fp")
    keyed = nodes.select("rep", "fp", F.explode(_segments(fp)).alias("k")).select("rep", "fp", "k.*")
    heads = keyed.groupBy("seg", "key").agg(F.min(F.struct("fp", "rep")).alias("head"), F.count("*").alias("n")).where("n > 1")
    near = keyed.join(heads, ["seg", "key"]).where((_apart(fp, F.col("head.fp")) <= DISTANCE) & (fp != F.col("head.fp")))
    return near.select(F.col("rep").alias("u"), F.col("head.rep").alias("v")).distinct()


def ball_pairs(grouped: DataFrame) -> DataFrame:
    """Pairs (u, v) of two groups within ``DISTANCE`` bits, with their groups; a pair may come more than once."""
    fp, a, b = F.col("fp"), F.col("fp_u"), F.col("fp_v")
    near = grouped.select("rep", "fp", "group", F.explode(_balls(fp)).alias("k")).select(F.col("rep").alias("u"), F.col("fp").alias("fp_u"), F.col("group").alias("group_u"), "k.*")
    held = grouped.select("rep", "fp", "group", F.explode(_segments(fp)).alias("k")).select(F.col("rep").alias("v"), F.col("fp").alias("fp_v"), F.col("group").alias("group_v"), "k.*")
    met = (near["seg"] == held["seg"]) & (near["key"] == held["key"]) & (a < b) & (F.col("group_u") != F.col("group_v")) & (_apart(a, b) <= DISTANCE)
    return near.join(held, met).select("u", "v", "group_u", "group_v")


def links(nodes: DataFrame) -> DataFrame:
    """Pairs (u, v) of representatives whose fingerprints lie within ``DISTANCE`` bits.

    ``nodes`` has distinct fingerprints fp with representatives rep. Fingerprints that agree
    in a whole segment are first linked to that value's smallest fingerprint where the
    distance allows, which contracts dense groups of near copies to a star. The ball search
    then leaves out pairs inside one star, so a group of n copies costs far fewer than n * n
    links, and every group that any pair connects stays connected.
    """
    stars = common.stored(star_pairs(nodes), "stars")
    part = components(stars).select(F.col("node").alias("rep"), F.col("component").alias("group"))
    grouped = common.stored(nodes.join(part, "rep", "left").select("rep", "fp", F.coalesce("group", "rep").alias("group")), "groups")
    found = ball_pairs(grouped).select(F.col("group_u").alias("u"), F.col("group_v").alias("v"))
    return stars.unionByName(found.distinct())


def near_duplicates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row for each input row.

    component_id is the smallest doc_id reachable over links of at most ``DISTANCE`` bits.
    Equal fingerprints (exact copies, and all texts without words) are one node of the graph.
    Rows without a doc_id keep their fingerprint and have no component.
    """
    fps = common.stored(fingerprints(docs, text_col), "fingerprints")
    nodes = common.stored(fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep")), "nodes")
    part = components(links(nodes)).select(F.col("node").alias("rep"), "component")
    labels = nodes.join(part, "rep", "left").select("fp", F.coalesce("component", "rep").alias("component"))
    return fps.join(labels, "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with the smallest doc_id of each near-duplicate group, with all their columns.

    Of rows that repeat both that doc_id and the text one stays. Rows without a doc_id stay as they are.
    """
    groups = near_duplicates(docs, text_col)
    kept = common.stored(groups.where("doc_id = component_id").select(F.col("doc_id").alias("kept_id")).distinct(), "kept")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("id"), F.col(text_col).alias("text"))
    named = rows.where(F.col("id").isNotNull())
    stay = named.join(kept, named["id"] == kept["kept_id"], "left_semi").dropDuplicates(["id", "text"])
    return stay.unionByName(rows.where(F.col("id").isNull())).select("row.*")
