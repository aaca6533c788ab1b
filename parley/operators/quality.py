"""Quality decisions on speech, and the good regions built from their runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..policy import QualityPolicy
from ..storage import stored
from .intervals import merge, overlap, overlap_join
from .runs import with_previous, with_running, with_runs


def music_overlap(speech: DataFrame, music: DataFrame, keys: list[str]) -> DataFrame:
    """Milliseconds of each speech range that music covers (music is merged first)."""
    over = overlap(F.col("start_ms"), F.col("end_ms"), F.col("r_start"), F.col("r_end"))
    pairs = overlap_join(speech, merge(music, keys).drop("n"), keys).groupBy(*speech.columns).agg(F.sum(over).alias("music_ms"))
    return speech.join(pairs, speech.columns, "left").withColumn("music_ms", F.coalesce("music_ms", F.lit(0).cast("long")))


def decide(rows: DataFrame, policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """Adds music_ratio and is_good to rows of start_ms, end_ms, music_ms and snr_db; equality passes."""
    ratio = F.col("music_ms") / (F.col("end_ms") - F.col("start_ms"))
    return rows.withColumn("music_ratio", ratio).withColumn("is_good", (F.col("snr_db") >= policy.least_snr_db) & (F.col("music_ratio") <= policy.most_music))


def label_runs(rows: DataFrame, keys: list[str], label: str = "is_good") -> DataFrame:
    """Runs of neighbours with one label: run, label, start_ms, end_ms, n."""
    runs = with_runs(rows, keys, label)
    return runs.groupBy(*keys, "run", label).agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.count("*").alias("n"))


def absorb(rows: DataFrame, keys: list[str], policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """Decisions in which short bad runs between good ones count as good.

    Runs alternate, so one pass over the runs reaches the fixpoint of repeated absorption.
    """
    tagged = stored(with_runs(rows, keys, "is_good", "·run"), "tagged")
    runs = tagged.groupBy(*keys, "·run").agg(F.min("start_ms").alias("a"), F.max("end_ms").alias("b"), F.first("is_good").alias("g"))
    top = runs.groupBy(*keys).agg(F.max("·run").alias("top"))
    inner = (F.col("·run") > 1) & (F.col("·run") < F.col("top"))
    short = runs.join(top, keys).select(*keys, "·run", (inner & ~F.col("g") & (F.col("b") - F.col("a") < policy.absorb_below)).alias("·short"))
    return tagged.join(short, [*keys, "·run"]).withColumn("is_good", F.col("is_good") | F.col("·short")).select(*rows.columns)


def good_regions(decisions: DataFrame, music: DataFrame, keys: list[str], policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """Good runs after absorption, cut where music falls into a gap, from the least length on."""
    rows = absorb(decisions, keys, policy).select(*keys, "start_ms", "end_ms", "is_good")
    rows = stored(with_previous(rows, keys, {"p_end": "end_ms", "p_good": "is_good"}), "decided")
    gaps = rows.where("p_end < start_ms").select(*keys, F.col("p_end").alias("start_ms"), F.col("start_ms").alias("end_ms"))
    struck = overlap_join(gaps, merge(music, keys).drop("n"), keys).select(*keys, F.col("end_ms").alias("start_ms"), F.lit(True).alias("struck")).distinct()
    rows = rows.join(struck, [*keys, "start_ms"], "left")
    cut = (F.col("p_good").isNull() | (F.col("p_good") != F.col("is_good")) | F.coalesce("struck", F.lit(False))).cast("long")
    parts = with_running(rows, keys, cut, "region")
    regions = parts.where("is_good").groupBy(*keys, "region").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"))
    return regions.where(F.col("end_ms") - F.col("start_ms") >= policy.least_region).drop("region")


def align_to_turns(regions: DataFrame, turns: DataFrame, keys: list[str]) -> DataFrame:
    """Regions stretched to the turns they overlap; a region without a turn goes."""
    pairs = overlap_join(regions, turns.select(*keys, "start_ms", "end_ms"), keys)
    return pairs.groupBy(*keys, F.col("start_ms").alias("region_start"), F.col("end_ms").alias("region_end")).agg(F.min("r_start").alias("start_ms"), F.max("r_end").alias("end_ms"))


def probability_runs(series: DataFrame, threshold: float, hop: int, rate: int, policy: QualityPolicy = QualityPolicy()) -> DataFrame:
    """Ranges of probabilities at or above a threshold, gaps filled, longer than the minimum."""
    w = Window.partitionBy("series_id").orderBy("idx")
    loud = series.where(F.col("p") >= threshold).withColumn("g", F.col("idx") - F.row_number().over(w))
    runs = loud.groupBy("series_id", "g").agg(F.min("idx").alias("a"), (F.max("idx") + 1).alias("b"))
    ms = lambda c: F.expr(f"(2 * {c} * {hop} * 1000 + {rate}) div (2 * {rate})").cast("long")  # noqa: E731  half up
    spans = runs.select("series_id", ms("a").alias("start_ms"), ms("b").alias("end_ms")).where("end_ms > start_ms")
    return merge(spans, ["series_id"], policy.music_gap).where(F.col("end_ms") - F.col("start_ms") > policy.music_least).drop("n")
