"""Near-duplicates by Jaccard similarity of word shingles: SimHash proposals, then a join.

A text is the set of its hashed shingles. SimHash fingerprints of all shingles are searched by
multi-index hashing (:mod:`simhash`): texts that share a segment's value meet its smallest
fingerprint, then small Hamming balls find the rest within a few bits. Two sets of similarity
0.8 differ in about ten bits, which no small ball covers, so every other pair is found by keys
that similar sets share: the first n - ceil(s * n) + 1 of a set's shingles under one order of
all shingles, of which two sets of similarity s share one, or for large sets ``LEAST`` least
hashes, of which they share none with a probability below (1 - s) ** ``LEAST``. Pairs meet only
across groups that earlier links left apart, and where sizes, places and bit sketches rule the
similarity out they are never formed. All links are verified on the whole sets, so none rests
on a fingerprint's distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common, simhash, wordhash
from .components import components

WIDTH, SIMILARITY = 5, 0.8
#: Documents whose shingles say which are common; it sets the order of shingles, never the result.
SAMPLE_DOCS, COMMON = 4_000, 3
#: Least hashes of a set of more than ``LARGE`` shingles, taken over those that are not common. Sets with more
#: than ``MOSTLY`` common ones have a prefix instead. Both limits overlap by what similar sets may differ in.
LEAST, LARGE, MOSTLY = 32, 160, 0.7
#: Rounds that link sets to one drawn under each shingle of more than so many rows; they only save comparisons.
ROUNDS, DENSE = 1, 16
#: Least hashes of the whole set, under which sets meet the smallest one.
STARS = 4
#: 64-bit words of a set's sketch, in which each member turns one bit over.
SKETCH = 16
_BITS = [f"b{k}" for k in range(SKETCH)]
_MULTIPLIERS = np.arange(1, LEAST + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
#: Pairs with one set that a task compares with it, about.
_STREAM = 256
_BLOCK = 16_384
_EPS = 1e-9


def _shingles(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Hashes of each text's shingles in order, repeats included."""
    texts = [x or b"" for x in column.cast(pa.binary()).to_pylist()]
    for i, j in common.small_parts(np.array([len(t) for t in texts], np.int64)):
        hashes, at = wordhash.of_texts(texts[i:j], width)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            yield hashes[a:b]


def _fingerprint(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _BLOCK):
        ones += np.unpackbits(hashes[k : k + _BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def _least(members: np.ndarray, count: int) -> np.ndarray:
    """The least of the set under ``count`` other hashes, each marked with its hash's number."""
    out = np.empty(count, np.uint64)
    for k, factor in enumerate(_MULTIPLIERS[:count]):
        mixed = (members ^ members >> np.uint64(29)) * factor
        out[k] = (mixed ^ mixed >> np.uint64(32)).min()
    return wordhash.mix(out + _MULTIPLIERS[:count]).view(np.int64)


def _sketch(members: np.ndarray) -> np.ndarray:
    """Bits turned over once for each member: two sketches differ in no more bits than the sets in members."""
    odd = np.bincount((members >> np.uint64(24)).astype(np.int64) % (64 * SKETCH), minlength=64 * SKETCH) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _keys(members: np.ndarray, common_hashes: np.ndarray, counts: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """The set's first shingles (those the sample did not find common, then the others, rarest first) and its least hashes.

    Similar sets have one kind in common: sizes differ at most by a factor of ``similarity``,
    and shares of common shingles by less than (1 - similarity) / similarity.
    """
    n = len(members)
    rank = np.zeros(n, np.int64)
    if len(common_hashes):
        at = np.minimum(np.searchsorted(common_hashes, members), len(common_hashes) - 1)
        rank = np.where(common_hashes[at] == members, counts[at], 0)
    share = float((rank > 0).mean())
    first = least = members[:0].view(np.int64)
    if n <= LARGE / similarity or share >= MOSTLY - (1 - similarity) / similarity:
        first = members[np.argsort(rank, kind="stable")[: n - math.ceil(similarity * n - _EPS) + 1]].view(np.int64)
    if n >= LARGE and share <= MOSTLY:
        least = _least(members[rank == 0], LEAST)
    return first, least


def _common(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles in several documents of a bounded sample, ascending, and in how many."""
    every = max(1, docs.count() // SAMPLE_DOCS)
    sample = docs.where(F.pmod(F.xxhash64("doc_id", "mark"), F.lit(every)) == 0).select("text")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.unique(h) for h in _shingles(batch.column(0), width)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64) if found else [], pa.int64())], names=["h"])

    top = common.map_arrow(sample, "h long", each).groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    rows = top.orderBy(F.desc("n"), "h").limit(100_000).toPandas()
    hashes = rows["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], rows["n"].to_numpy(np.int64)[order]


def _signature(members: np.ndarray) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(members.tobytes())).astype(np.int64))


def _described(docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """doc_id, mark, sig (names the shingle set), n (its size), fp (SimHash), stars (least hashes), sketch, prefix and least."""
    hashes, counts = _common(docs, width)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        long, longs, none = pa.int64(), pa.list_(pa.int64()), np.zeros(0, np.int64)
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], []]
            for found in _shingles(batch.column(2), width):
                members = np.unique(found)
                some = len(members) > 0
                first, least = _keys(members, hashes, counts, similarity) if some else (none, none)
                row = (_signature(members), len(members), _fingerprint(found), _least(members, STARS) if some else none, _sketch(members), first, least)
                for column, value in zip(out, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(out, (long, long, long, longs, longs, longs, longs)))], names=["doc_id", "mark", "sig", "n", "fp", "stars", "sketch", "prefix", "least"])

    return common.map_large(docs, "doc_id long, mark long, sig long, n long, fp long, stars array<long>, sketch array<long>, prefix array<long>, least array<long>", described)


def _reaches(shared: Column, sizes: Column, similarity: float) -> Column:
    return shared * (1 + similarity) >= sizes * similarity - _EPS


def _differ() -> Column:
    """Bits in which the sketches b0, ... and c0, ... differ."""
    return reduce(add, (F.bit_count(F.col(b).bitwiseXOR(F.col(f"c{b[1:]}"))) for b in _BITS))


def _alike(similarity: float) -> Column:
    """Whether sets of n and m members can reach ``similarity`` by their sizes and sketches."""
    sizes = F.col("n") + F.col("m")
    return (F.least("n", "m") >= F.greatest("n", "m") * similarity - _EPS) & _reaches((sizes - _differ()) / 2, sizes, similarity)


def _as_other(nodes: DataFrame, *more: Column) -> DataFrame:
    return nodes.select(F.col("sig").alias("v"), F.col("n").alias("m"), *(F.col(b).alias(f"c{b[1:]}") for b in _BITS), *more)


def _nearest(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """For each u of the pairs that sizes and sketches leave, the v whose sketch differs least."""
    own = nodes.select(F.col("sig").alias("u"), "n", *_BITS)
    left = pairs.distinct().join(own, "u").join(_as_other(nodes), "v").where(_alike(similarity))
    return left.groupBy("u").agg(F.min(F.struct(_differ().alias("d"), "v")).alias("x")).select("u", "x.v")


def _verified(pairs: DataFrame, docs: DataFrame, firsts: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs (u, v) of sets whose Jaccard similarity is at least ``similarity``, stored.

    The texts of all u of one v are streamed past v's set; a v with many is dealt to several tasks.
    """
    pairs = common.stored(pairs.distinct(), "pairs")
    deals = pairs.groupBy("v").agg(F.ceil(F.count("*") / _STREAM).alias("deals"))
    dealt = pairs.join(deals, "v").select("u", "v", F.pmod(F.xxhash64("u"), "deals").alias("deal"))
    sides = dealt.select(F.col("u").alias("sig"), "v", "deal", F.lit(1).alias("side")).unionByName(dealt.select(F.col("v").alias("sig"), "v", "deal", F.lit(0).alias("side")).distinct())
    wanted = common.stored(sides.join(firsts, "sig"), "wanted")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held = None, None
        for batch in batches:
            found = []
            for v, side, sig, hashes in zip(*(batch.column(k).to_pylist() for k in range(3)), _shingles(batch.column(3), width)):
                members = np.unique(hashes)
                if _signature(members) != sig:
                    continue  # another text of the same id and mark
                if side == 0:
                    of, held = v, members
                elif of == v:
                    shared = len(np.intersect1d(held, members, assume_unique=True))
                    if shared * (1 + similarity) >= (len(held) + len(members)) * similarity - _EPS:
                        found.append((sig, v))
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["u", "v"])

    texts = docs.join(wanted, ["doc_id", "mark"]).select("v", "deal", "side", "sig", "text")
    texts = texts.repartition("v", "deal").sortWithinPartitions("v", "deal", "side")
    return common.stored(common.map_large(texts.select("v", "side", "sig", "text"), "u long, v long", compared).distinct(), "verified")


def _least_stars(nodes: DataFrame) -> DataFrame:
    """Pairs of each set with the smallest set under each of its least hashes."""
    keyed = nodes.select("sig", F.posexplode("stars").alias("slot", "key"))
    heads = keyed.groupBy("slot", "key").agg(F.min("sig").alias("head"), F.max("sig").alias("last")).where("head <> last")
    return keyed.join(heads, ["slot", "key"]).where("sig <> head").select(F.col("sig").alias("u"), F.col("head").alias("v"))


def _grouped(nodes: DataFrame, links: DataFrame) -> DataFrame:
    part = components(links).select(F.col("node").alias("sig"), F.col("component").alias("group"))
    return common.stored(nodes.join(part, "sig", "left").withColumn("group", F.coalesce("group", "sig")), "grouped")


def _shared(nodes: DataFrame) -> DataFrame:
    """sig, i and key of the keys that more than one set has; a shingle of a prefix is the set's i-th."""
    every = nodes.select("sig", F.size("prefix").alias("k"), F.posexplode(F.concat("prefix", "least")).alias("i", "key"))
    every = every.select("sig", "key", F.when(F.col("i") < F.col("k"), F.col("i")).otherwise(0).alias("i")).repartition("key")
    keys = every.groupBy("key").agg(F.min("sig").alias("least"), F.max("sig").alias("most")).where("least <> most")
    return common.stored(every.join(keys.select("key"), "key", "left_semi"), "shared")


def _mixed(shared: DataFrame, grouped: DataFrame) -> DataFrame:
    """Rows of the keys that more than one group has, with their sets' columns and how many rows the key has."""
    rows = shared.join(grouped.select("sig", "group"), "sig")
    keys = rows.groupBy("key").agg(F.min("group").alias("least"), F.max("group").alias("most"), F.count("*").alias("rows")).where("least <> most")
    left = rows.join(keys.select("key", "rows"), "key").drop("group")
    return common.stored(left.join(grouped.select("sig", "group", "n", *_BITS), "sig"), "mixed")


def _can_reach(similarity: float) -> Column:
    """Whether sets of n and m members can reach ``similarity`` when one shared member stands at i and j in their orders."""
    most = F.least("i", "j") + 1 + F.least(F.col("n") - F.col("i") - 1, F.col("m") - F.col("j") - 1)
    return _reaches(most, F.col("n") + F.col("m"), similarity)


def _drawn(rows: DataFrame, round_: int, similarity: float) -> DataFrame:
    """Under each shingle of many rows, pairs of all its sets with one set drawn by hash, where their groups differ."""
    dense = rows.where(F.col("rows") > DENSE)
    draw = F.struct(F.xxhash64("sig", "key", F.lit(round_)).alias("h"), F.col("sig"), F.col("group").alias("group_v"), F.col("n"), F.col("i").alias("j"), *_BITS)
    heads = dense.groupBy("key").agg(F.min(draw).alias("head")).select("key", "head.*")
    heads = _as_other(heads, F.col("key"), F.col("group_v"), F.col("j"))
    met = (dense["key"] == heads["key"]) & (F.col("group") != F.col("group_v")) & _can_reach(similarity) & _alike(similarity)
    return dense.join(heads, met).select(F.col("sig").alias("u"), "v")


def _across(rows: DataFrame, similarity: float) -> DataFrame:
    """Every pair of sets of two groups that can reach ``similarity``: by a shared prefix shingle, sizes, places and sketches."""
    other = _as_other(rows, F.col("key"), F.col("group").alias("group_v"), F.col("i").alias("j"))
    met = (rows["key"] == other["key"]) & (F.col("group") < F.col("group_v")) & _can_reach(similarity) & _alike(similarity)
    return rows.join(other, met).select(F.least("sig", "v").alias("u"), F.greatest("sig", "v").alias("v"))


def _parts(rows: DataFrame, docs: DataFrame, width: int, similarity: float) -> DataFrame:
    """sig and part, for each set: sets of one part are joined by links."""
    firsts = common.stored(rows.groupBy("sig").agg(F.min(F.struct("doc_id", "mark")).alias("first")).select("sig", "first.*"), "firsts")
    chosen = firsts.select("sig", F.col("doc_id").alias("first_id"), F.col("mark").alias("first_mark"))
    nodes = rows.join(chosen, "sig").where("doc_id = first_id and mark = first_mark").dropDuplicates(["sig"])
    nodes = common.stored(nodes.select("sig", "n", "fp", "stars", *(F.col("sketch")[k].alias(b) for k, b in enumerate(_BITS)), "prefix", "least"), "nodes")

    def verified(pairs: DataFrame) -> DataFrame:
        return _verified(pairs, docs, firsts, width, similarity)

    alike = nodes.groupBy("fp").agg(F.min("sig").alias("rep"))
    same = nodes.join(alike, "fp").where("sig <> rep").select(F.col("sig").alias("u"), F.col("rep").alias("v"))
    links = verified(_nearest(same.unionByName(simhash.star_pairs(alike)).unionByName(_least_stars(nodes)), nodes, similarity))
    grouped = _grouped(nodes.drop("prefix", "least", "stars"), links)
    reps = grouped.select("sig", "fp", "group").join(alike.select(F.col("rep").alias("sig")), "sig", "left_semi").withColumnRenamed("sig", "rep")
    proposed = simhash.ball_pairs(reps).select("u", "v")
    shared = _shared(nodes)
    mixed = _mixed(shared, grouped)
    for k in range(ROUNDS):
        found = verified(_nearest(proposed.unionByName(_drawn(mixed, k, similarity)) if k == 0 else _drawn(mixed, k, similarity), nodes, similarity))
        if found.isEmpty():
            break
        links = links.unionByName(found)
        grouped = _grouped(nodes.drop("prefix", "least", "stars"), links)
        mixed = _mixed(shared, grouped)
    links = links.unionByName(verified(_across(mixed, similarity)))
    part = components(links).select(F.col("node").alias("sig"), F.col("component").alias("part"))
    return common.stored(firsts.join(part, "sig", "left").select("sig", F.coalesce("part", "sig").alias("part")), "parts")


def _numbered(docs: DataFrame, text_col: str) -> DataFrame:
    """Ids, hashes of texts and texts; rows without an id count as after all others."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))


_LAST = (1 << 63) - 1


def near_duplicates(docs: DataFrame, text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id and component_id (the smallest doc_id over links of at least ``similarity``), for rows with a doc_id.

    Texts with the same shingle set, as all without words have, are one node.
    """
    docs = _numbered(docs.where(F.col("doc_id").isNotNull()), text_col)
    rows = common.stored(_described(docs, width, similarity), "described")
    parts = _parts(rows, docs, width, similarity)
    labelled = rows.select("doc_id", "sig").join(parts, "sig")
    names = labelled.groupBy("part").agg(F.min("doc_id").alias("component_id"))
    return labelled.join(names, "part").select("doc_id", "component_id")


def one_of_each(docs: DataFrame, text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest doc_id, with all its columns.

    Rows without a doc_id come after all others. Of rows that repeat both that doc_id and the
    text's shingles one stays; rows that repeat only a doc_id are documents of their own.
    """
    texts = _numbered(docs, text_col)
    rows = common.stored(_described(texts, width, similarity), "described")
    labelled = rows.select("doc_id", "sig").join(_parts(rows, texts, width, similarity), "sig")
    kept = labelled.groupBy("part").agg(F.min(F.struct("doc_id", "sig")).alias("kept"))
    counted = labelled.groupBy("doc_id", "sig", "part").agg(F.count("*").alias("rows")).join(kept, "part")
    # most rows stay, so those that go and those that occur again are what is joined
    marks = counted.select(F.col("doc_id").alias("id"), "sig", (F.struct("doc_id", "sig") == F.col("kept")).alias("stays"), "rows")
    marks = common.stored(marks.where("not stays or rows > 1"), "marks")

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = [_signature(np.unique(h)) for h in _shingles(batch.column(2), width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sigs, pa.int64())], names=["row", "id", "sig"])

    plain = docs.select(common.row_of(docs), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    named = common.map_arrow(plain, common.schema_of(plain, ["row"], "id long, sig long"), signed)
    marked = named.join(marks, ["id", "sig"], "left")
    again = marked.where("stays").dropDuplicates(["id", "sig"])
    return marked.where("stays is null").select("row.*").unionByName(again.select("row.*"))
