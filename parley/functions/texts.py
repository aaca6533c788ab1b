"""Small texts of the stages: spoken text, clock times, bounded messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .timebase import RATE, half_even

MOST_ERROR = 512


def spoken(tags: Column, text: Column) -> Column:
    """Tags, then the words if there are any, joined by single spaces: what a voice model is given."""
    return F.array_join(F.concat(F.coalesce(tags, F.array().cast("array<string>")), F.when(text != "", F.array(text)).otherwise(F.array().cast("array<string>"))), " ")


def clock(frames: Column, rate: int = RATE) -> Column:
    """HH:MM:SS.mmm of a number of frames, milliseconds half to even; hours grow beyond two digits."""
    ms = half_even(frames.cast("decimal(20,0)") * 1000 / rate)
    part = lambda unit, size: F.floor(ms / unit) % size
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(ms / 3_600_000), part(60_000, 60), part(1000, 60), ms % 1000)


def safe_error(code: Column, most: int = MOST_ERROR) -> Column:
    """A stable code without what an exception says, cut to what its column holds; unknown failures have none of their own."""
    return F.substring(F.coalesce(F.when(code.rlike("^[a-z0-9_]+$"), code), F.lit("processing_failed")), 1, most)
