"""Conversions between seconds, frames and milliseconds, each with its own rounding rule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RATE = 16_000


def _decimal(seconds: Column) -> Column:
    return seconds.cast("string").cast("decimal(28,12)")


def seconds_to_frames(seconds: Column, rate: int = RATE) -> Column:
    """Half up on the decimal text of the number."""
    return F.round(_decimal(seconds) * rate, 0).cast("long")


def seconds_to_ms(seconds: Column) -> Column:
    return F.round(_decimal(seconds) * 1000, 0).cast("long")


def exact_ms(seconds: Column) -> Column:
    """Milliseconds where the number has whole ones, else null."""
    ms = _decimal(seconds) * 1000
    return F.when(ms == F.floor(ms), ms.cast("long"))


def frames_to_ms(frames: Column, rate: int = RATE) -> Column:
    return F.floor((frames * 1000 + rate // 2) / F.lit(rate)).cast("long")


def ms_to_frames(ms: Column, rate: int = RATE) -> Column:
    return F.floor((ms * rate + 500) / F.lit(1000)).cast("long")


def half_even(value: Column) -> Column:
    return F.bround(value, 0).cast("long")


def normal_spans(start: Column, end: Column, frames: int, rate: int = RATE) -> tuple[Column, Column, Column]:
    """Frame bounds of a detected range in seconds, clamped to the recording, and whether any is left."""
    finite = ~(F.isnan(start) | F.isnan(end) | (F.abs(start) == float("inf")) | (F.abs(end) == float("inf")))
    lo = F.greatest(F.lit(0).cast("long"), seconds_to_frames(start, rate))
    hi = F.least(F.lit(frames).cast("long"), seconds_to_frames(end, rate))
    return lo, hi, finite & (end > start) & (hi > lo)
