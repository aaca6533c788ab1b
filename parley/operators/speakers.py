"""Per-speaker statistics and predicates on windows of turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..policy import PlannerPolicy
from .intervals import overlap, overlap_join


def in_windows(windows: DataFrame, turns: DataFrame, keys: list[str]) -> DataFrame:
    """Turns that overlap each window, with clipped length and whether they lie inside."""
    pairs = overlap_join(windows, turns, keys)
    inside = (F.col("r_start") >= F.col("start_ms")) & (F.col("r_end") <= F.col("end_ms"))
    return pairs.withColumn("clipped", overlap(F.col("start_ms"), F.col("end_ms"), F.col("r_start"), F.col("r_end"))).withColumn("inside", inside)


def speaker_stats(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Per window and speaker: longest and total contained turn, airtime and longest clipped turn."""
    own = F.when(F.col("inside"), F.col("r_end") - F.col("r_start")).otherwise(F.lit(0).cast("long"))
    return pairs.groupBy(*keys, "start_ms", "end_ms", "speaker").agg(F.max(own).alias("longest_ms"), F.sum(own).alias("total_ms"), F.sum("clipped").alias("airtime_ms"), F.max("clipped").alias("longest_clipped_ms"))


def strict_two_speaker(stats: DataFrame, keys: list[str], policy: PlannerPolicy = PlannerPolicy()) -> DataFrame:
    """Windows in which exactly two speakers talk, each with enough contained speech."""
    enough = (F.col("longest_ms") >= policy.speaker_turn) & (F.col("total_ms") >= policy.speaker_total)
    per = stats.groupBy(*keys, "start_ms", "end_ms").agg(F.count("*").alias("n"), F.min(enough.cast("int")).alias("ok"))
    return per.where("n = 2 and ok = 1").select(*keys, "start_ms", "end_ms")


def extra_speaker(stats: DataFrame, keys: list[str]) -> DataFrame:
    """Of windows with more than two speakers the one with least airtime, ties to the smaller id."""
    window = [*keys, "start_ms", "end_ms"]
    return stats.where("airtime_ms > 0").groupBy(*window).agg(F.count("*").alias("n_speakers"), F.min(F.struct("airtime_ms", "speaker")).alias("x")).where("n_speakers > 2").select(*window, "n_speakers", F.col("x.speaker").alias("extra_speaker"), F.col("x.airtime_ms").alias("airtime_ms"))


def clip(chunks: DataFrame, turns: DataFrame, keys: list[str]) -> DataFrame:
    """Turns cut to their chunk and counted from its start."""
    pairs = overlap_join(chunks, turns, keys)
    start = F.greatest("r_start", "start_ms") - F.col("start_ms")
    end = F.least("r_end", "end_ms") - F.col("start_ms")
    return pairs.select(*keys, F.col("start_ms").alias("chunk_start"), start.alias("start_ms"), end.alias("end_ms"), "speaker", "turn_id")


def speech_summary(turns: DataFrame, keys: list[str]) -> DataFrame:
    """Per speaker: turns, milliseconds, seconds (2 digits) and share in percent (1 digit), half up."""
    per = turns.groupBy(*keys, "speaker").agg(F.count("*").alias("n_turns"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("total_ms"))
    all_ms = F.sum("total_ms").over(Window.partitionBy(*keys))
    seconds = F.round(F.col("total_ms").cast("decimal(18,0)") / 1000, 2).cast("decimal(18,2)")
    share = F.when(all_ms > 0, F.round(F.col("total_ms").cast("decimal(18,0)") * 100 / all_ms.cast("decimal(18,0)"), 1)).otherwise(0).cast("decimal(5,1)")
    return per.select(*keys, "speaker", "n_turns", "total_ms", seconds.cast("double").alias("total_seconds"), share.cast("double").alias("percentage"))


def first_seen_ids(turns: DataFrame, keys: list[str], label: str, order: list[str]) -> DataFrame:
    """keys, label and speaker: labels numbered from 0 by where they first occur, ties by the label.

    A recording's labels meet in a window, its turns never do. A null label is one of its own, numbered like others.
    """
    first = turns.groupBy(*keys, label).agg(F.min(F.struct(*order)).alias("first"))
    w = Window.partitionBy(*keys).orderBy("first", F.col(label).asc_nulls_first())
    return first.select(*keys, label, (F.row_number().over(w) - 1).cast("long").alias("speaker"))
