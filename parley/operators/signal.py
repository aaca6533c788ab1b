"""Aggregates over sample arrays, in built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .positions import numbered

# The amplitude statistic of speech in noise at -20, -19 .. 100 dB.
SNR_STATISTIC = [
    0.40974774, 0.40986926, 0.40998566, 0.40969089, 0.40986186, 0.40999006, 0.41027138, 0.41052627, 0.41101024, 0.41143264, 0.41231718,
    0.41337272, 0.41526426, 0.4178192, 0.42077252, 0.42452799, 0.42918886, 0.43510373, 0.44234195, 0.45161485, 0.46221153, 0.47491647,
    0.48883809, 0.50509236, 0.52353709, 0.54372088, 0.56532427, 0.58847532, 0.61346212, 0.63954496, 0.66750818, 0.69583724, 0.72454762,
    0.75414799, 0.78323148, 0.81240985, 0.84219775, 0.87166406, 0.90030504, 0.92880418, 0.95655449, 0.9835349, 1.01047155, 1.0362095,
    1.06136425, 1.08579312, 1.1094819, 1.13277995, 1.15472826, 1.17627308, 1.19703503, 1.21671694, 1.23535898, 1.25364313, 1.27103891,
    1.28718029, 1.30302865, 1.31839527, 1.33294817, 1.34700935, 1.3605727, 1.37345513, 1.38577122, 1.39733504, 1.40856397, 1.41959619,
    1.42983624, 1.43958467, 1.44902176, 1.45804831, 1.46669568, 1.47486938, 1.48269965, 1.49034339, 1.49748214, 1.50435106, 1.51076426,
    1.51698915, 1.5229097, 1.528578, 1.53389835, 1.5391211, 1.5439065, 1.54858517, 1.55310776, 1.55744391, 1.56164927, 1.56566348,
    1.56938671, 1.57307767, 1.57654764, 1.57980083, 1.58304129, 1.58602496, 1.58880681, 1.59162477, 1.5941969, 1.59693155, 1.599446,
    1.60185011, 1.60408668, 1.60627134, 1.60826199, 1.61004547, 1.61192472, 1.61369656, 1.61534074, 1.61688905, 1.61838916, 1.61985374,
    1.62135878, 1.62268119, 1.62390423, 1.62513143, 1.62632463, 1.6274027, 1.62842767, 1.62945532, 1.6303307, 1.63128026, 1.63204102,
]
EPSILON = 1e-10


def snr(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Statistic and decibels of each key's samples, one sample a row; silent keys are left out.

    Aggregates need no order, so long recordings are summed on the map side.
    """
    peak = rows.groupBy(*keys).agg(F.max(F.abs(value)).alias("peak")).where("peak > 0")
    x = F.greatest(F.abs(F.col(value)) / F.col("peak"), F.lit(EPSILON))
    sums = rows.join(peak, keys).groupBy(*keys).agg(F.avg(x).alias("m"), F.avg(F.log(x)).alias("l"), F.sum(F.pow(F.col(value) / F.col("peak"), 2)).alias("energy"))
    return decibels(sums, keys)


def decibels(sums: DataFrame, keys: list[str]) -> DataFrame:
    """keys, statistic and snr_db from the mean amplitude (m), the mean of its logarithm (l) and the energy."""
    sums = sums.withColumn("statistic", F.log(F.greatest("m", F.lit(EPSILON))) - F.col("l"))
    table = F.lit(SNR_STATISTIC)
    below = F.array_max(F.filter(F.sequence(F.lit(0), F.lit(120)), lambda i: F.get(table, i) < F.col("statistic")))
    at = sums.withColumn("i", below)
    low, high = F.get(table, F.col("i")), F.get(table, F.col("i") + 1)
    db = F.when(F.col("i").isNull(), F.lit(-20.0)).when(F.col("i") == 120, F.lit(100.0)).otherwise(F.col("i") - 20 + (F.col("statistic") - low) / (high - low))
    factor = F.pow(F.lit(10.0), db / 10)
    value_db = 10 * F.log10((F.col("energy") * factor / (1 + factor)) / (F.col("energy") / (1 + factor) + EPSILON))
    return at.select(*keys, F.round("statistic", 6).alias("statistic"), F.round(value_db, 4).alias("snr_db"))


def rms(samples: Column) -> Column:
    return F.sqrt(F.aggregate(samples, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")) / F.size(samples) + 1e-20)


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def crossfade(a: Column, b: Column, overlap: Column) -> Column:
    """Two sample arrays stitched over ``overlap`` samples with a linear ramp from 0 to 1."""
    n = F.least(overlap, F.size(a), F.size(b))
    ramp = F.when(n > 1, F.transform(F.sequence(F.lit(0), n - 1), lambda i: i / (n - 1))).otherwise(F.array(F.lit(0.0)))
    tail, head = F.slice(a, F.size(a) - n + 1, n), F.slice(b, F.lit(1), n)
    mixed = F.zip_with(F.arrays_zip(tail.alias("x"), head.alias("y")), ramp, lambda p, r: p["x"] * (1 - r) + p["y"] * r)
    joined = F.concat(F.slice(a, F.lit(1), F.size(a) - n), mixed, F.slice(b, n + 1, F.size(b) - n))
    return F.when(n > 0, joined).otherwise(F.concat(a, b))


def peaks(rows: DataFrame, keys: list[str], order: str, value: str, bars: int) -> DataFrame:
    """Bar levels of a waveform: 0.65 peak + 0.35 rms of each bucket, against the loudest, ^0.72.

    Places come from ranges of the cluster, so a track of most rows is spread over all tasks.
    """
    placed = numbered(rows, keys, [order], "place")
    length = rows.groupBy(*keys).agg(F.count("*").alias("len"))
    barred = placed.join(length, keys).withColumn("bar", F.floor(F.col("place") * bars / F.col("len")).cast("long"))
    level = 0.65 * F.max(F.abs(value)) + 0.35 * F.sqrt(F.avg(F.col(value) * F.col(value)))
    levels = barred.groupBy(*keys, "bar").agg(level.alias("level"))
    loudest = F.max("level").over(Window.partitionBy(*keys))  # of no more than ``bars`` rows
    return levels.select(*keys, "bar", F.round(F.pow(F.col("level") / F.greatest(loudest, F.lit(EPSILON)), 0.72), 3).alias("height"))
