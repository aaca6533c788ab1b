"""Interval algebra on half-open integer ranges, for all entities of a key at once.

Islands are found in two passes: inside fixed buckets of time first, then over the buckets'
islands. One entity that holds a large share of the rows is then spread over its buckets,
and only its islands meet in one window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_MS = 60_000


def _islands(df: DataFrame, keys: list[str], gap: Column | int, *aggs: Column) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("start_ms", "end_ms")
    reach = F.max("end_ms").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = (reach.isNull() | (F.col("start_ms") - reach > gap)).cast("long")
    marked = df.withColumn("·new", fresh).withColumn("·island", F.sum("·new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "·island").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), *aggs).drop("·island")


def merge(df: DataFrame, keys: list[str], gap: int = 0, count: str = "n") -> DataFrame:
    """Unions of ranges that lie at most ``gap`` apart (touching ranges join), with their number."""
    bucketed = df.select(*keys, "start_ms", "end_ms", F.expr(f"start_ms div {BUCKET_MS}").alias("·b"))
    local = _islands(bucketed, [*keys, "·b"], gap, F.count("*").alias(count))
    return _islands(local.drop("·b"), keys, gap, F.sum(count).alias(count))


def group_by_gap(islands: DataFrame, keys: list[str], gap: int, least: int = 0, count: str = "n_islands") -> DataFrame:
    """Groups of ranges whose gaps are at most ``gap``, kept from an outer length of ``least``."""
    return merge(islands, keys, gap, count).where(F.col("end_ms") - F.col("start_ms") >= least)


def hard_split(df: DataFrame, most: int) -> DataFrame:
    """Pieces of at most ``most``; adds piece, counted from 0."""
    last = F.greatest(F.lit(0).cast("long"), F.expr(f"(end_ms - start_ms + {most - 1}) div {most} - 1"))
    rows = df.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    start = F.col("start_ms") + F.col("piece") * most
    return rows.withColumn("end_ms", F.least(F.col("end_ms"), start + most)).withColumn("start_ms", start)


def pad(df: DataFrame, limit: Column | str, before: int, after: int, most: int) -> DataFrame:
    """Widen ranges inside 0 .. ``limit`` without exceeding ``most``.

    The room left is halved, the odd part in front; what one side cannot use goes to the other.
    """
    limit = F.col(limit) if isinstance(limit, str) else limit
    room = F.lit(most) - (F.col("end_ms") - F.col("start_ms"))
    front = F.least(F.col("start_ms"), F.lit(before))
    back = F.least(limit - F.col("end_ms"), F.lit(after))
    half_front = F.least(front, F.expr(f"({most} - (end_ms - start_ms) + 1) div 2"))
    half_back = F.least(back, F.expr(f"({most} - (end_ms - start_ms)) div 2"))
    grown_front = half_front + F.least(front - half_front, room - half_front - half_back)
    grown_back = half_back + F.least(back - half_back, room - grown_front - half_back)
    return df.select("*", grown_front.alias("·f"), grown_back.alias("·a")).withColumn("start_ms", F.col("start_ms") - F.col("·f")).withColumn("end_ms", F.col("end_ms") + F.col("·a")).drop("·f", "·a")


def indexed(df: DataFrame, keys: list[str], name: str = "part_index") -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("start_ms", "end_ms")
    return df.withColumn(name, (F.row_number().over(w) - 1).cast("long"))


def overlap(a_start: Column, a_end: Column, b_start: Column, b_end: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(a_end, b_end) - F.greatest(a_start, b_start))


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", bucket: int = BUCKET_MS) -> DataFrame:
    """Pairs of overlapping ranges; the right side's bounds are named r_start and r_end.

    Both sides are dealt to the buckets of time that they touch, so the join has an equi-key
    finer than the entity. A pair is taken in the first bucket that holds both.
    """
    if how not in ("inner", "left"):
        raise ValueError("inner and left joins only")
    names = [c for c in left.columns if c not in keys]
    tagged = left.withColumn("·row", F.struct(*names)) if how == "left" else left
    a = tagged.withColumn("·b", F.explode(F.expr(f"sequence(start_ms div {bucket}, greatest(start_ms, end_ms - 1) div {bucket})")))
    b = right.withColumnsRenamed({"start_ms": "r_start", "end_ms": "r_end"}).withColumn("·b", F.explode(F.expr(f"sequence(r_start div {bucket}, greatest(r_start, r_end - 1) div {bucket})")))
    hit = (F.col("r_end") > F.col("start_ms")) & (F.col("r_start") < F.col("end_ms")) & (F.col("·b") == F.expr(f"greatest(start_ms, r_start) div {bucket}"))
    pairs = a.join(b, [*keys, "·b"]).where(hit).drop("·b")
    if how == "inner":
        return pairs
    extra = [c for c in right.columns if c not in [*keys, "start_ms", "end_ms"]]
    found = pairs.select(*keys, "·row", "r_start", "r_end", *extra)
    return left.withColumn("·row", F.struct(*names)).join(found, [*keys, "·row"], "left").drop("·row")
