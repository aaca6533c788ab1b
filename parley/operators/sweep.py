"""Sweep-line operators: who speaks alone, and the reference speech chosen from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..policy import ReferencePolicy
from .intervals import BUCKET_MS, merge


def _edges(ranges: DataFrame, keys: list[str], weight: int) -> DataFrame:
    """Starts and ends of ranges: at t the number of speakers changes by d, and the sum of their numbers by ds."""
    speaker = F.col("speaker").cast("long")
    sides = F.explode(F.array(F.struct(F.col("start_ms").alias("t"), F.lit(weight).alias("d")), F.struct(F.col("end_ms").alias("t"), F.lit(-weight).alias("d"))))
    return ranges.select(*keys, speaker.alias("s"), sides.alias("e")).select(*keys, "e.t", "e.d", (F.col("e.d") * F.col("s")).alias("ds"))


def _swept(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Stretches between neighbouring bounds: how many speakers are live, and the sum of their numbers.

    Bounds are summed inside buckets of time; what is live at a bucket's start, and where the
    next one begins, come from one row a bucket. A recording with a large share of all rows is
    so spread over its buckets.
    """
    at = edges.groupBy(*keys, F.expr(f"t div {BUCKET_MS}").alias("bucket"), "t").agg(F.sum("d").alias("d"), F.sum("ds").alias("ds"))
    per = at.groupBy(*keys, "bucket").agg(F.min("t").alias("first"), F.sum("d").alias("d"), F.sum("ds").alias("ds"))
    w = Window.partitionBy(*keys).orderBy("bucket")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    borders = per.select(*keys, "bucket", F.lead("first").over(w).alias("next_t"), *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("d", "ds")))
    inside = Window.partitionBy(*keys, "bucket").orderBy("t")
    run = inside.rowsBetween(Window.unboundedPreceding, 0)
    live, speaker = (F.sum(c).over(run) + F.col(f"{c}_before") for c in ("d", "ds"))
    end = F.coalesce(F.lead("t").over(inside), F.col("next_t"))
    return at.join(borders, [*keys, "bucket"]).select(*keys, F.col("t").alias("start_ms"), end.alias("end_ms"), live.alias("live"), speaker.alias("speaker"))


def _pieces(turns: DataFrame, keys: list[str]) -> DataFrame:
    """Stretches between neighbouring bounds in which exactly one speaker is active."""
    spoken = merge(turns, [*keys, "speaker"])
    # after the union each speaker is active at most once, so counts and speaker sums name the one
    return _swept(_edges(spoken, keys, 1), keys).where("live = 1 and end_ms > start_ms").select(*keys, "speaker", "start_ms", "end_ms")


def pure_intervals(turns: DataFrame, keys: list[str]) -> DataFrame:
    """Maximal ranges with exactly one active speaker: keys, speaker, start_ms, end_ms."""
    return merge(_pieces(turns, keys), [*keys, "speaker"]).select(*keys, "speaker", "start_ms", "end_ms")


def audit_pieces(turns: DataFrame, keys: list[str]) -> DataFrame:
    """Single-speaker ranges cut at every turn's bounds, for comparing separated tracks."""
    edges = _edges(merge(turns, [*keys, "speaker"]), keys, 1).unionByName(_edges(turns, keys, 0))
    return _swept(edges, keys).where("live = 1 and end_ms is not null").select(*keys, "speaker", "start_ms", "end_ms")


def longest_pure(pure: DataFrame, keys: list[str], trim: int = 500, most: int = 30_000) -> DataFrame:
    """Each speaker's longest range after trimming both ends, the earliest of equals, capped."""
    w = Window.partitionBy(*keys, "speaker").orderBy(F.col("len").desc(), "start_ms")
    rows = pure.withColumn("len", F.col("end_ms") - F.col("start_ms")).where(F.col("len") > 2 * trim).withColumn("r", F.row_number().over(w)).where("r = 1")
    start = F.col("start_ms") + trim
    return rows.select(*keys, "speaker", start.alias("start_ms"), F.least(F.col("end_ms") - trim, start + most).alias("end_ms"))


def reference_topk(pure: DataFrame, keys: list[str], policy: ReferencePolicy = ReferencePolicy()) -> DataFrame:
    """Longest trimmed ranges of each speaker until a budget is spent; the last is cut to fit."""
    own = [*keys, "speaker"]
    trimmed = pure.select(*own, (F.col("start_ms") + policy.trim).alias("start_ms"), (F.col("end_ms") - policy.trim).alias("end_ms")).withColumn("len", F.col("end_ms") - F.col("start_ms"))
    w = Window.partitionBy(*own).orderBy(F.col("len").desc(), "start_ms", "end_ms")
    spent = F.coalesce(F.sum("len").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = trimmed.where(F.col("len") > policy.least_segment).withColumn("spent", spent).withColumn("rank", F.row_number().over(w)).where(F.col("spent") < policy.most_effective)
    taken = taken.withColumn("take", F.least(F.col("len"), F.lit(policy.most_effective) - F.col("spent")))
    total = F.sum("take").over(Window.partitionBy(*own))
    return taken.withColumn("total_ms", total).where(F.col("total_ms") >= policy.least_effective).select(*own, F.col("rank").cast("long").alias("rank"), "start_ms", (F.col("start_ms") + F.col("take")).alias("end_ms"), "total_ms")
