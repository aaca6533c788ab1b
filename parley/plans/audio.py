"""Queries over sample tracks: spectra, resampling, signal-to-noise of intervals, and tracks side by side."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blocks, positions, quality, spectrum
from ..policy import QualityPolicy
from ..sources import views as v
from . import oracles as o
from .more import ORACLES, against
from .queries import PART, _music, _speech

__all__ = ["ORACLES"]

TRACK = ["track_id"]
#: Tracks of the tables are short, so that their blocks and frames are, too.
SIZE = 256
MEL = spectrum.MelPolicy(rate=8_000, fft=256, hop=128, bins=16, lowest=50.0, highest=4_000.0)

#: Whole samples of a supplier's track in the order of its order lines.
SAMPLES = """x AS (SELECT l_suppkey AS track_id, CAST(round(l_extendedprice) AS BIGINT) * CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END AS x,
    row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) - 1 AS i, count(*) OVER (PARTITION BY l_suppkey) AS len FROM lineitem)"""


def _tracks(spark, d):
    sign = F.when(F.col("l_linenumber") % 2 == 0, -1).otherwise(1)
    return v.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("track_id"), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", (F.round("l_extendedprice").cast("long") * sign).alias("x"))


_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]


def _blocks(spark, d, size=SIZE):
    return blocks.blocked(_tracks(spark, d), TRACK, _ORDER, "x", size)


def _mel_sql(p: spectrum.MelPolicy) -> str:
    """Mel power by sums of products: frames are summed against every cosine and sine of the transform."""
    mel = lambda x: f"CASE WHEN {x} < 1000 THEN {x} * 3 / 200.0 ELSE 15 + 27 * ln({x} / 1000.0) / ln(6.4) END"
    return f"""{SAMPLES}, f AS (SELECT DISTINCT track_id, unnest(range(0, len // {p.hop} + 1)) AS frame FROM x),
  e AS (SELECT k, CASE WHEN m < 15 THEN m * 200 / 3 ELSE 1000 * exp((m - 15) * ln(6.4) / 27) END AS hz FROM (SELECT k, {mel(f'{p.lowest}')} + k * (({mel(f'{p.highest}')}) - ({mel(f'{p.lowest}')})) / {p.bins + 1} AS m FROM range({p.bins + 2}) r(k))),
  w AS (SELECT a.k AS band, b, greatest(0, least((b * {p.rate} / {p.fft}.0 - a.hz) / (m.hz - a.hz), (z.hz - b * {p.rate} / {p.fft}.0) / (z.hz - m.hz))) * 2 / (z.hz - a.hz) AS w
    FROM e a JOIN e m ON m.k = a.k + 1 JOIN e z ON z.k = a.k + 2 CROSS JOIN range({p.fft // 2 + 1}) r(b)),
  s AS (SELECT f.track_id, frame, i - frame * {p.hop} + {p.fft // 2} AS k, x / 100000.0 * (0.5 - 0.5 * cos(2 * pi() * (i - frame * {p.hop} + {p.fft // 2}) / {p.fft})) AS y
    FROM f JOIN x ON x.track_id = f.track_id AND i >= frame * {p.hop} - {p.fft // 2} AND i < frame * {p.hop} + {p.fft // 2}),
  t AS (SELECT k, b, cos(2 * pi() * (k * b % {p.fft}) / {p.fft}) AS c, sin(2 * pi() * (k * b % {p.fft}) / {p.fft}) AS d FROM range({p.fft}) q(k) CROSS JOIN range({p.fft // 2 + 1}) r(b)),
  p AS (SELECT track_id, frame, b, pow(sum(y * c), 2) + pow(sum(y * d), 2) AS power FROM s JOIN t USING (k) GROUP BY ALL),
  m AS (SELECT track_id, frame, band, 10 * log10(greatest({p.least_power}, sum(power * w))) AS db FROM p JOIN w USING (b) WHERE w > 0 GROUP BY ALL),
  mel AS (SELECT track_id, frame, band, greatest(db, max(db) OVER (PARTITION BY track_id) - {p.range_db}) AS db FROM m)"""


def _mel(spark, d):
    scaled = _blocks(spark, d).withColumn("samples", F.transform("samples", lambda x: x / 100_000.0))
    return spectrum.floored(spectrum.mel_spectrum(scaled, TRACK, MEL, SIZE), TRACK, MEL.range_db)


@against(f"WITH {_mel_sql(MEL)} SELECT track_id, CAST(band AS INTEGER) AS band, count(*) AS n, round(avg(db), 4) AS mean, round(stddev_pop(db), 4) AS deviation FROM mel GROUP BY track_id, band")
def mel_moments(spark, d):
    m = spectrum.band_moments(_mel(spark, d), TRACK)
    return m.select("track_id", "band", "n", F.round("mean", 4).alias("mean"), F.round("deviation", 4).alias("deviation"))


@against(f"""WITH {_mel_sql(MEL)}, g AS (SELECT band, avg(db) AS mean, stddev_pop(db) AS deviation FROM mel GROUP BY band)
  SELECT track_id, frame, round(sum((db - mean) / deviation), 3) AS total, round(max((db - mean) / deviation), 3) AS highest FROM mel JOIN g USING (band) GROUP BY track_id, frame""")
def mel_standardised(spark, d):
    made = _mel(spark, d)
    rows = spectrum.standardised(made, spectrum.band_moments(made, []), [])
    return rows.select("track_id", "frame", F.round(F.aggregate("bands", F.lit(0.0), lambda a, x: a + x), 3).alias("total"), F.round(F.array_max("bands"), 3).alias("highest"))


_CUT = 16_000 * spectrum.SincPolicy().kept


@against(f"""WITH {SAMPLES}, n AS (SELECT DISTINCT track_id, len, unnest(range(0, CAST(ceil(len * 22050 / 16000.0) AS BIGINT))) AS n FROM x),
  y AS (SELECT n.track_id, n, i, x, (i / 16000.0 - n / 22050.0) * {_CUT} AS t FROM n JOIN x ON x.track_id = n.track_id AND i BETWEEN n * 320 // 441 - 7 AND n * 320 // 441 + 8),
  r AS (SELECT track_id, n, sum(CASE WHEN abs(t) < 6 THEN x * CASE WHEN abs(t) < 1e-12 THEN 1 ELSE sin(pi() * t) / (pi() * t) END * pow(cos(pi() * t / 12), 2) * {_CUT / 16_000} ELSE 0 END) AS v FROM y GROUP BY track_id, n)
  SELECT track_id, count(*) AS n, round(sum(abs(v)), 2) AS total, round(max(v), 4) AS highest, round(min(v), 4) AS lowest, max_by(n, (round(v, 4), -n)) AS at FROM r GROUP BY track_id""")
def resampled_tracks(spark, d):
    made = spectrum.resampled(_blocks(spark, d), TRACK, 16_000, 22_050, size=SIZE)
    rows = made.select("track_id", "start", F.posexplode("samples").alias("k", "v"))
    n = F.col("start") + F.col("k")
    return rows.groupBy("track_id").agg(
        F.count("*").alias("n"), F.round(F.sum(F.abs("v")), 2).alias("total"), F.round(F.max("v"), 4).alias("highest"), F.round(F.min("v"), 4).alias("lowest"), F.max_by(n, F.struct(F.round("v", 4), -n)).alias("at")
    )


#: Each turn with 100 seconds around it, as samples of the track of its number; tracks are as long as their recordings.
_ASKED = f"""{o.TURNS}, {SAMPLES}, z AS (SELECT part_id, max(end_ms) AS top FROM turns GROUP BY part_id), l AS (SELECT DISTINCT track_id, len FROM x),
  asked AS (SELECT turn_id, t.part_id, start_ms, end_ms, greatest(0, (start_ms - 100000) * len // top) AS from_sample, least(len, (end_ms + 100000) * len // top + 1) AS to_sample FROM turns t JOIN z USING (part_id) JOIN l ON track_id = part_id)"""


def snr_sql(source: str, keys: str, x: str = "x") -> str:
    return f"""pk AS (SELECT *, max(abs({x})) OVER (PARTITION BY {keys}) AS peak FROM {source}),
  st AS (SELECT {keys}, ln(greatest(avg(greatest(abs({x}) / peak::DOUBLE, 1e-10)), 1e-10)) - avg(ln(greatest(abs({x}) / peak::DOUBLE, 1e-10))) AS st, sum(({x} / peak::DOUBLE) * ({x} / peak::DOUBLE)) AS en FROM pk WHERE peak > 0 GROUP BY {keys}),
  gt AS (SELECT {o._G} AS g), ix AS (SELECT st.*, g, list_max(list_filter(range(1, 122), lambda k: g[k] < st)) AS k FROM st, gt),
  snr AS (SELECT {keys}, round(st, 6) AS statistic, round(10 * log10((en * pow(10, db / 10) / (1 + pow(10, db / 10))) / (en / (1 + pow(10, db / 10)) + 1e-10)), 4) AS snr_db
    FROM (SELECT *, CASE WHEN k IS NULL THEN -20 WHEN k = 121 THEN 100 ELSE k - 21 + (st - g[k]) / (g[k + 1] - g[k]) END AS db FROM ix))"""


def _sampled(spark, d, rows, before: int):
    """Ranges of time of the recordings that have a track, as ranges of its samples."""
    top = v.turns(spark, d).groupBy("part_id").agg(F.max("end_ms").alias("top"))
    length = _tracks(spark, d).groupBy(F.col("track_id").alias("part_id")).agg(F.count("*").alias("len"))
    held = rows.join(top, PART).join(length, PART)
    low = F.greatest(F.lit(0).cast("long"), F.expr(f"(start_ms - {before}) * len div top"))
    high = F.least(F.col("len"), F.expr(f"(end_ms + {before}) * len div top") + 1)
    return held.withColumn("from_sample", F.when(F.col("start_ms") >= before, low).otherwise(0).cast("long")).withColumn("to_sample", high).drop("top", "len")


@against(f"""WITH {_ASKED}, s AS (SELECT turn_id, x FROM asked JOIN x ON track_id = part_id AND i >= from_sample AND i < to_sample), {snr_sql('s', 'turn_id')}
  SELECT turn_id, part_id, from_sample, to_sample, statistic, snr_db FROM asked LEFT JOIN snr USING (turn_id)""")
def interval_snr(spark, d):
    asked = _sampled(spark, d, v.turns(spark, d).select("turn_id", "part_id", "start_ms", "end_ms"), 100_000)
    held = blocks.blocked(_tracks(spark, d).withColumnRenamed("track_id", "part_id"), PART, _ORDER, "x", 16)
    return blocks.interval_snr(held, asked, PART, 16).select("turn_id", "part_id", "from_sample", "to_sample", "statistic", "snr_db")


@against(f"""WITH {o.MUSIC_MS}, {SAMPLES}, z AS (SELECT part_id, max(end_ms) AS top FROM turns GROUP BY part_id), l AS (SELECT DISTINCT track_id, len FROM x),
  asked AS (SELECT c.*, greatest(0, (start_ms - 60000) * len // top) AS from_sample, least(len, (end_ms + 60000) * len // top + 1) AS to_sample FROM covered c JOIN z USING (part_id) JOIN l ON track_id = part_id),
  s AS (SELECT part_id, start_ms, end_ms, x FROM asked JOIN x ON track_id = part_id AND i >= from_sample AND i < to_sample), {snr_sql('s', 'part_id, start_ms, end_ms')}
  SELECT part_id, start_ms, end_ms, music_ms, snr_db, coalesce(snr_db >= 10 AND music_ms::DOUBLE / (end_ms - start_ms) <= 0.3, false) AS is_good FROM asked LEFT JOIN snr USING (part_id, start_ms, end_ms)""")
def speech_quality(spark, d):
    """Quality of every stretch of speech from its own samples: signal-to-noise, and the share that music covers."""
    rows = _sampled(spark, d, quality.music_overlap(_speech(spark, d), _music(spark, d), PART), 60_000)
    held = blocks.blocked(_tracks(spark, d).withColumnRenamed("track_id", "part_id"), PART, _ORDER, "x", 16)
    judged = quality.decide(blocks.interval_snr(held, rows, PART, 16), QualityPolicy())
    return judged.select("part_id", "start_ms", "end_ms", "music_ms", "snr_db", F.coalesce("is_good", F.lit(False)).alias("is_good"))


#: Two tracks of each nation, customers' and suppliers' balances, by key.
_PAIRED = """a AS (SELECT c_nationkey AS k, c_custkey AS key, c_acctbal AS x, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS position FROM customer),
  b AS (SELECT s_nationkey AS k, s_suppkey AS key, s_acctbal AS x, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) - 1 AS position FROM supplier)"""


def _paired(spark, d):
    left = v.table(spark, d, "customer").select(F.col("c_nationkey").alias("k"), F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("x"))
    right = v.table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("x"))
    return left, right


@against(f"WITH {_PAIRED} SELECT coalesce(a.k, b.k) AS k, coalesce(a.position, b.position) AS position, a.key AS key, b.key AS other_key, round(a.x + b.x, 2) AS total FROM a FULL JOIN b ON a.k = b.k AND a.position = b.position")
def zipped_tracks(spark, d):
    left, right = _paired(spark, d)
    z = positions.zipped(left, right, ["k"], ["key"])
    return z.select("k", "position", "key", F.col("other.key").alias("other_key"), F.round(F.col("x") + F.col("other.x"), 2).alias("total"))


@against("""SELECT k, count(*) FILTER (s = 0) AS n_left, count(*) FILTER (s = 1) AS n_right FROM (SELECT c_nationkey AS k, 0 AS s FROM customer UNION ALL SELECT s_nationkey, 1 FROM supplier)
  GROUP BY k HAVING count(*) FILTER (s = 0) <> count(*) FILTER (s = 1)""")
def zip_lengths(spark, d):
    return positions.lengths(*_paired(spark, d), ["k"])
