"""Separated tracks: alignment decisions, audits, rendering, seeds and bar levels."""

from __future__ import annotations

import hashlib
import uuid
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, ShortType

from ..storage import stored
from .blocks import BLOCK, interval_rms
from .signal import cosine, rms


def aligned_track(a: Column, b: Column, reference: Column, voiced: float = 1e-4, least: float = 0.86, margin: float = 0.01) -> Column:
    """Which of two tracks continues the reference: 'a', 'b', or 'reject' where it is unclear."""
    va, vb = rms(a) >= voiced, rms(b) >= voiced
    ca, cb = cosine(a, reference), cosine(b, reference)
    clear = (F.greatest(ca, cb) >= least) & (F.abs(ca - cb) >= margin)
    return F.when(~va & ~vb, "reject").when(va & ~vb, "a").when(vb & ~va, "b").when(~F.coalesce(clear, F.lit(False)), "reject").when(ca > cb, "a").otherwise("b")


def audit(pieces: DataFrame, keys: list[str], least: int = 3_000, ratio: float = 1.05) -> DataFrame:
    """Verdict for each chunk from single-speaker pieces (start_ms, end_ms, slot, rms0, rms1).

    A piece votes direct where the louder track is its speaker's, unless both are alike. The
    verdict needs votes for both speakers and no contradiction.
    """
    loud = F.greatest("rms0", "rms1") / F.greatest(F.least("rms0", "rms1"), F.lit(1e-12))
    votes = pieces.where((F.col("end_ms") - F.col("start_ms") > least) & (loud >= ratio)).withColumn("direct", (F.when(F.col("rms1") > F.col("rms0"), 1).otherwise(0) == F.col("slot")).cast("int"))
    per = votes.groupBy(*keys).agg(F.count("*").alias("n_votes"), F.sum("direct").alias("n_direct"), F.count_distinct("slot").alias("slots"))
    verdict = F.when(F.coalesce("n_votes", F.lit(0)) == 0, "inconclusive").when(F.col("slots") < 2, "inconclusive").when(F.col("n_direct") == F.col("n_votes"), "direct").when(F.col("n_direct") == 0, "swapped").otherwise("inconsistent")
    return pieces.select(*keys).distinct().join(per, keys, "left").select(*keys, F.coalesce("n_votes", F.lit(0)).alias("n_votes"), verdict.alias("verdict"))


def trimmed(pieces: DataFrame, rate: int, trim: int = 1_000) -> DataFrame:
    """Adds from_sample and to_sample: a piece less ``trim`` milliseconds on either side."""
    return pieces.withColumn("from_sample", F.expr(f"(start_ms + {trim}) * {rate} div 1000")).withColumn("to_sample", F.expr(f"(end_ms - {trim}) * {rate} div 1000"))


def with_levels(pieces: DataFrame, first: DataFrame, second: DataFrame, keys: list[str], size: int = BLOCK) -> DataFrame:
    """Adds rms0 and rms1, two tracks' levels from from_sample to before to_sample; pieces without samples go.

    Both tracks come as blocks, so a piece reads no more of them than its borders.
    """
    asked = stored(pieces.where("from_sample >= 0 and to_sample > from_sample"), "pieces")
    own = [*keys, "from_sample", "to_sample"]
    for name, track in (("rms0", first), ("rms1", second)):
        asked = asked.join(interval_rms(track, asked, keys, size).withColumnRenamed("rms", name), own)
    return asked


def fitted(samples: Column, n: Column) -> Column:
    """A sample array cut or filled with silence to ``n`` samples."""
    zero = F.lit(0).cast("double")
    return F.slice(F.concat(samples.cast("array<double>"), F.array_repeat(zero, F.greatest(F.lit(0), n - F.size(samples)).cast("int"))), F.lit(1), F.greatest(F.lit(0), n).cast("int"))


def in_order(tracks: Column, swapped: Column) -> Column:
    """Two tracks, exchanged where the alignment says so."""
    return F.when(swapped, F.array(tracks[1], tracks[0])).otherwise(tracks)


@F.pandas_udf(ArrayType(DecimalType(20, 0)))
def window_seeds(chunk_id: pd.Series, windows: pd.Series) -> pd.Series:
    """The seeds of a chunk's windows: SHAKE-256 over the 16 bytes of its UUID, cut into unsigned numbers of eight bytes."""

    def seeds(chunk: str, n: int) -> list[Decimal]:
        drawn = hashlib.shake_256(uuid.UUID(chunk).bytes).digest(8 * n)
        return [Decimal(int.from_bytes(drawn[8 * k : 8 * k + 8], "big")) for k in range(n)]

    return pd.Series([seeds(c, int(n)) for c, n in zip(chunk_id, windows)])


@F.pandas_udf(ArrayType(ShortType()))
def rendered(starts: pd.Series, parts: pd.Series, frames: pd.Series) -> pd.Series:
    """Utterances' samples laid on a silent track at their frames; later ones replace earlier."""

    def one(at, sounds, n):
        track = np.zeros(int(n), np.int16)
        for a, s in zip(at, sounds):
            s = np.asarray(s, np.int16)[: max(0, int(n) - int(a))]
            track[int(a) : int(a) + len(s)] = s
        return track

    return pd.Series([one(a, s, n) for a, s, n in zip(starts, parts, frames)])


def normalised(tracks: Column, level: float = 0.9) -> Column:
    """Arrays of samples scaled so that the loudest sample of all has ``level``."""
    peak = F.array_max(F.transform(tracks, lambda t: F.array_max(F.transform(t, lambda x: F.abs(x)))))
    return F.when(peak > 0, F.transform(tracks, lambda t: F.transform(t, lambda x: x / peak * level))).otherwise(tracks)


def silent(track: Column, least: float = 1e-6) -> Column:
    return F.coalesce(F.array_max(F.transform(track, lambda x: F.abs(x))) <= least, F.lit(True))


def with_silence(a: Column, frames: int, b: Column) -> Column:
    return F.concat(a, F.array_repeat(F.lit(0.0), frames), b)


def timed_peaks(rows: DataFrame, keys: list[str], time: str, value: str, audible: float, buckets: int) -> DataFrame:
    """Peak of each bucket of time relative to the loudest, silence after the ``audible`` share of the time.

    Lengths and loudest bars are aggregated and joined, so no window meets a track's samples.
    """
    span = rows.join(rows.groupBy(*keys).agg((F.max(time) + 1).alias("span")), keys)
    bar = F.floor(F.col(time) * buckets / F.col("span")).cast("long")
    level = F.when(F.col(time) <= (F.col("span") - 1) * audible, F.abs(value)).otherwise(0.0)
    levels = span.select(*keys, bar.alias("bar"), level.alias("level")).groupBy(*keys, "bar").agg(F.max("level").alias("level"))
    loudest = levels.groupBy(*keys).agg(F.greatest(F.max("level"), F.lit(1e-10)).alias("loudest"))
    return levels.join(loudest, keys).select(*keys, "bar", F.round(F.col("level") / F.col("loudest"), 3).alias("height"))


def downsampled(levels: Column, bars: int) -> Column:
    """Bars of 0.65 maximum + 0.35 mean over equal stretches of levels."""
    n = F.size(levels)

    def bar(i: Column) -> Column:
        a = F.floor(i * n / bars).cast("int")
        part = F.slice(levels, a + 1, F.greatest(F.lit(1), F.floor((i + 1) * n / bars).cast("int") - a))
        return 0.65 * F.array_max(part) + 0.35 * F.aggregate(part, F.lit(0.0), lambda s, x: s + x) / F.size(part)

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.lit(bars - 1)), bar)).otherwise(F.array_repeat(F.lit(0.0), bars))


def shifted(levels: Column, offset: Column) -> Column:
    """Levels moved right by a fraction of their span: silence first, the rest resampled to fit."""
    n = F.size(levels)
    lead = F.floor(n * offset).cast("int")
    index = lambda i: F.least(n - 1, F.floor((i - lead) * n / F.greatest(F.lit(1), n - lead)).cast("int"))
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < lead, F.lit(0.0)).otherwise(F.get(levels, index(i))))).otherwise(levels)
