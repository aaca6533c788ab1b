"""Resampling and mel spectra of block-wise tracks; what a block's samples need of its neighbours comes as a halo."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from .blocks import BLOCK, with_halo


@dataclass(frozen=True)
class MelPolicy:
    rate: int = 22_050
    fft: int = 1024
    hop: int = 512
    bins: int = 80
    lowest: float = 27.5
    highest: float = 8000.0
    least_power: float = 1e-7
    range_db: float = 80.0

    def __post_init__(self) -> None:
        if not (0 < self.hop <= self.fft and self.fft % 2 == 0 and 0 <= self.lowest < self.highest <= self.rate / 2 and self.bins > 0):
            raise ValueError("bounds of the mel policy are out of order")


def _mel(hz: np.ndarray) -> np.ndarray:
    """Linear up to 1000 Hz, 15 mel there, then 27 mel to each factor of 6.4."""
    return np.where(hz < 1000, hz * 3 / 200, 15 + 27 * np.log(np.maximum(hz, 1e-9) / 1000) / math.log(6.4))


def _hz(mel: np.ndarray) -> np.ndarray:
    return np.where(mel < 15, mel * 200 / 3, 1000 * np.exp((mel - 15) * math.log(6.4) / 27))


def mel_filters(p: MelPolicy) -> np.ndarray:
    """(bins, fft / 2 + 1): triangles between neighbours of equal mel steps, each of area 2 over its width in Hz."""
    edges = _hz(np.linspace(float(_mel(np.array(p.lowest))), float(_mel(np.array(p.highest))), p.bins + 2))
    at = np.arange(p.fft // 2 + 1) * p.rate / p.fft
    low, mid, high = edges[:-2, None], edges[1:-1, None], edges[2:, None]
    return np.maximum(0, np.minimum((at - low) / (mid - low), (high - at) / (high - mid))) * 2 / (high - low)


def mel_frames(samples: np.ndarray, centres: np.ndarray, p: MelPolicy, filters: np.ndarray) -> np.ndarray:
    """Decibels of mel power in the frames around ``centres``; samples beyond the array are silence."""
    half = p.fft // 2
    padded = np.concatenate([np.zeros(half), samples, np.zeros(half)])
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(p.fft) / p.fft)
    frames = np.lib.stride_tricks.sliding_window_view(padded, p.fft)[centres] * window
    power = np.abs(np.fft.rfft(frames, axis=1)) ** 2
    return 10 * np.log10(np.maximum(p.least_power, power @ filters.T))


def _keyed(haloed: DataFrame, keys: list[str], *fields: StructField) -> StructType:
    return StructType([*(haloed.schema[k] for k in keys), *fields])


def mel_spectrum(blocks: DataFrame, keys: list[str], p: MelPolicy = MelPolicy(), size: int = BLOCK) -> DataFrame:
    """keys, frame (from 0) and bands: a frame is centred on every ``hop``-th sample, the track's end included.

    A block computes the frames whose centres it holds. ``fft`` is at most two blocks.
    """
    haloed = with_halo(blocks, keys, p.fft // 2)
    schema = _keyed(haloed, keys, StructField("frame", LongType()), StructField("bands", ArrayType(DoubleType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = mel_filters(p)
        for batch in batches:
            for i in range(len(batch)):
                held = {c: batch.column(c)[i].as_py() for c in ("block", "last")}
                before, own, after = (batch.column(c)[i].values.to_numpy() for c in ("before", "samples", "after"))
                start = held["block"] * size
                end = start + len(own) + (1 if held["last"] else 0)  # the last block has the frame at its very end, too
                frames = np.arange(-(-start // p.hop), -(-end // p.hop))
                if len(frames):
                    bands = mel_frames(np.concatenate([before, own, after]), frames * p.hop - start + len(before), p, filters)
                    same = [batch.column(k).take(pa.array([i] * len(frames))) for k in keys]
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(len(frames) + 1) * p.bins, pa.int32()), pa.array(bands.ravel()))
                    yield pa.RecordBatch.from_arrays([*same, pa.array(frames), lists], names=[*keys, "frame", "bands"])

    return haloed.select(*keys, "block", "samples", "before", "after", "last").mapInArrow(run, schema)


def floored(spectrum: DataFrame, keys: list[str], range_db: float = MelPolicy.range_db) -> DataFrame:
    """Bands not more than ``range_db`` below the track's loudest one."""
    loudest = spectrum.groupBy(*keys).agg((F.max(F.array_max("bands")) - range_db).alias("least"))
    return spectrum.join(loudest, keys).withColumn("bands", F.transform("bands", lambda b: F.greatest(b, F.col("least")))).drop("least")


def band_moments(spectrum: DataFrame, keys: list[str]) -> DataFrame:
    """keys, band, n, mean and deviation over the frames of the keys (all frames without keys); sums merge on the map side."""
    rows = spectrum.select(*keys, F.posexplode("bands").alias("band", "x"))
    return rows.groupBy(*keys, "band").agg(F.count("*").alias("n"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("deviation"))


def standardised(spectrum: DataFrame, moments: DataFrame, keys: list[str]) -> DataFrame:
    """Bands less their mean, in deviations; a band that never changes is 0."""
    gathered = moments.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("band", "mean", "deviation"))).alias("m"))  # as many as there are bands
    joined = spectrum.join(gathered, keys) if keys else spectrum.crossJoin(F.broadcast(gathered))  # one row
    scaled = F.zip_with("bands", "m", lambda x, m: F.when(m["deviation"] > 0, (x - m["mean"]) / m["deviation"]).otherwise(0.0))
    return joined.withColumn("bands", scaled).drop("m")


@dataclass(frozen=True)
class SincPolicy:
    """Zero crossings on each side of the filter, and the share of the lower rate's band that it keeps."""

    crossings: int = 6
    kept: float = 0.99


def sinc_weights(source: int, target: int, p: SincPolicy) -> tuple[np.ndarray, int]:
    """Filter for each phase of the target (rows) over the samples -reach .. reach around its floor, and reach.

    A windowed sinc at min(source, target) * kept, its window a squared cosine.
    """
    common = math.gcd(source, target)
    source, target = source // common, target // common
    cut = min(source, target) * p.kept
    reach = math.ceil(p.crossings * source / cut) + 1
    phase = (np.arange(target) * source % target / target)[:, None]
    t = np.clip((np.arange(-reach, reach + 1)[None] - phase) * cut / source, -p.crossings, p.crossings)
    return np.sinc(t) * np.cos(np.pi * t / (2 * p.crossings)) ** 2 * cut / source, reach


def resampled(blocks: DataFrame, keys: list[str], source: int, target: int, p: SincPolicy = SincPolicy(), size: int = BLOCK) -> DataFrame:
    """keys, block, start (of all samples at the new rate) and samples: ceil(length * target / source) a track.

    Each new sample is made by the block that holds its moment; samples beyond the track are silence.
    """
    common = math.gcd(source, target)
    up, down = target // common, source // common
    weights, reach = sinc_weights(source, target, p)
    haloed = with_halo(blocks, keys, reach)
    schema = _keyed(haloed, keys, StructField("block", LongType()), StructField("start", LongType()), StructField("samples", ArrayType(DoubleType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, out = [], []
            for i in range(len(batch)):
                before, own, after = (batch.column(c)[i].values.to_numpy() for c in ("before", "samples", "after"))
                begin = batch.column("block")[i].as_py() * size
                new = np.arange(-(-begin * up // down), -(-(begin + len(own)) * up // down))
                padded = np.concatenate([np.zeros(reach - len(before)), before, own, after, np.zeros(reach - len(after))])
                around = np.lib.stride_tricks.sliding_window_view(padded, 2 * reach + 1)
                floor = new * down // up - begin
                starts.append(int(new[0]) if len(new) else 0)
                out.append(np.concatenate([np.einsum("ij,ij->i", around[floor[k : k + 8192]], weights[new[k : k + 8192] % up]) for k in range(0, len(new), 8192)] or [np.zeros(0)]))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(o) for o in out])]), pa.int32()), pa.array(np.concatenate(out) if out else np.zeros(0)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), batch.column("block"), pa.array(starts, pa.int64()), lists], names=[*keys, "block", "start", "samples"])

    return haloed.select(*keys, "block", "samples", "before", "after").mapInArrow(run, schema)
