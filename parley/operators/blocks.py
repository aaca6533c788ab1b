"""Sample tracks as blocks: one row for each stretch of samples, so that no task holds a whole track.

Work on a block sees the edges of its neighbours (a halo), and aggregates over any range come
from an index of blocks in powers of two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import stored
from . import signal
from .positions import numbered

#: Samples of a block, and levels of the index above it.
BLOCK, LEVELS = 4096, 20


def blocked(rows: DataFrame, keys: list[str], order: list[str], value: str, size: int = BLOCK) -> DataFrame:
    """keys, block (from 0) and samples, from one sample a row in the order of ``order``.

    Places come from ranges of the cluster, so one track with most rows is spread over all tasks.
    A null value counts as silence.
    """
    placed = numbered(rows.select(*keys, *(c for c in dict.fromkeys([*order, value]) if c not in keys)), keys, order, "place")
    cut = placed.select(*keys, F.expr(f"place div {size}").alias("block"), F.struct("place", F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("x")).alias("s"))
    gathered = cut.groupBy(*keys, "block").agg(F.array_sort(F.collect_list("s")).alias("s"))  # no more than a block
    return stored(gathered.select(*keys, "block", F.transform("s", lambda s: s["x"]).alias("samples")), "blocks")


def with_halo(blocks: DataFrame, keys: list[str], halo: int) -> DataFrame:
    """Adds ``before`` and ``after``: the ``halo`` samples on either side (fewer at the track's ends), and ``last``.

    ``halo`` is at most a block, and all blocks of a track but its last are whole. Only edges travel
    beside the blocks themselves.
    """
    none = F.lit(None).cast("array<double>")
    own = blocks.select(*keys, "block", "samples", none.alias("before"), none.alias("after"))
    tail = F.slice("samples", F.greatest(F.lit(1), F.size("samples") - halo + 1), F.lit(halo))
    left = blocks.select(*keys, (F.col("block") + 1).alias("block"), none.alias("samples"), tail.alias("before"), none.alias("after"))
    right = blocks.select(*keys, (F.col("block") - 1).alias("block"), none.alias("samples"), none.alias("before"), F.slice("samples", 1, halo).alias("after"))
    met = own.unionByName(left).unionByName(right).groupBy(*keys, "block").agg(*(F.any_value(c, True).alias(c) for c in ("samples", "before", "after")))
    empty = F.array().cast("array<double>")
    return met.where("samples is not null").select(*keys, "block", "samples", F.coalesce("before", empty).alias("before"), F.coalesce("after", empty).alias("after"), F.col("after").isNull().alias("last"))


def _summary(samples: Column) -> Column:
    """What a range of samples adds to its amplitude statistic: n, zeros, sums of |x|, ln|x| and x², and the peak."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("zeros"), *(F.lit(0.0).alias(c) for c in ("total", "logs", "energy", "peak")))

    def add(a: Column, x: Column) -> Column:
        size, silent = F.abs(x), x == 0
        return F.struct(
            (a["n"] + 1).alias("n"),
            (a["zeros"] + silent.cast("long")).alias("zeros"),
            (a["total"] + size).alias("total"),
            (a["logs"] + F.when(silent, 0.0).otherwise(F.log(size))).alias("logs"),
            (a["energy"] + x * x).alias("energy"),
            F.greatest(a["peak"], size).alias("peak"),
        )

    return F.aggregate(samples, start, add)


_MERGED = (*(F.sum, F.sum, F.sum, F.sum, F.sum), F.max)
_FIELDS = ("n", "zeros", "total", "logs", "energy", "peak")


def _merge(prefix: str = "s.") -> list[Column]:
    return [f(f"{prefix}{c}").alias(c) for f, c in zip(_MERGED, _FIELDS)]


def levels_of(blocks: DataFrame) -> int:
    """Levels that the longest track needs, at most LEVELS."""
    return min(LEVELS, (blocks.agg(F.max("block")).first()[0] or 0).bit_length() + 1)


def index(blocks: DataFrame, keys: list[str], levels: int) -> DataFrame:
    """keys, level, node and the summary of the node's 2**level blocks."""
    rows = blocks.select(*keys, "block", _summary(F.col("samples")).alias("s"))
    dealt = rows.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level"), "block", "s")
    return dealt.groupBy(*keys, "level", F.expr("shiftright(block, level)").alias("node")).agg(*_merge())


def _nodes(first: Column, end: Column, levels: int) -> Column:
    """Nodes that hold exactly the blocks first .. end: two a level at most, below the highest level."""
    start = F.struct(first.alias("a"), end.alias("b"), F.array().cast("array<struct<level:int,node:bigint>>").alias("nodes"))

    def step(s: Column, level: Column) -> Column:
        left = (s["a"] < s["b"]) & (s["a"] % 2 == 1)
        a = s["a"] + left.cast("long")
        right = (a < s["b"]) & (s["b"] % 2 == 1)
        b = s["b"] - right.cast("long")
        node = lambda at: F.struct(level.alias("level"), at.alias("node"))
        found = F.concat(s["nodes"], F.filter(F.array(F.when(left, node(s["a"])), F.when(right, node(b))), lambda n: n.isNotNull()))
        return F.struct(F.shiftright(a, 1).alias("a"), F.shiftright(b, 1).alias("b"), found.alias("nodes"))

    done = F.aggregate(F.filter(F.sequence(F.lit(0), F.lit(levels)), lambda k: k < levels - 1), start, step)
    rest = F.when(done["a"] < done["b"], F.transform(F.sequence(done["a"], done["b"] - 1), lambda i: F.struct(F.lit(levels - 1).alias("level"), i.alias("node"))))
    return F.concat(done["nodes"], F.coalesce(rest, F.array().cast("array<struct<level:int,node:bigint>>")))


def interval_sums(blocks: DataFrame, intervals: DataFrame, keys: list[str], size: int = BLOCK) -> DataFrame:
    """keys, from_sample, to_sample and the summary of the samples from the one to before the other, for each that has samples.

    Whole blocks inside an interval come from the index, a few nodes however long it is, and only
    its border blocks' samples are read.
    """
    levels = levels_of(blocks)
    asked = stored(intervals.select(*keys, "from_sample", "to_sample").distinct(), "asked")
    first = F.expr(f"(from_sample + {size - 1}) div {size}")
    end = F.expr(f"to_sample div {size}")
    spans = asked.withColumn("first", first).withColumn("end", end)
    inner = spans.where(F.col("first") < F.col("end")).select(*keys, "from_sample", "to_sample", F.explode(_nodes(F.col("first"), F.col("end"), levels)).alias("at"))
    whole = inner.select(*keys, "from_sample", "to_sample", "at.*").join(index(blocks, keys, levels), [*keys, "level", "node"]).select(*keys, "from_sample", "to_sample", *_FIELDS)

    low, high = F.expr(f"from_sample div {size}"), F.expr(f"(to_sample - 1) div {size}")
    edges = F.array_distinct(F.filter(F.array(F.when(F.col("first") > low, low), F.when(F.col("end") <= high, high)), lambda b: b.isNotNull()))
    border = spans.where("from_sample < to_sample").select(*keys, "from_sample", "to_sample", F.explode(edges).alias("block")).join(blocks, [*keys, "block"])
    a = F.greatest(F.col("from_sample") - F.col("block") * size, F.lit(0)).cast("int")
    b = F.least(F.col("to_sample") - F.col("block") * size, F.lit(size)).cast("int")
    part = border.select(*keys, "from_sample", "to_sample", _summary(F.slice("samples", a + 1, b - a)).alias("s")).select(*keys, "from_sample", "to_sample", "s.*")

    return whole.unionByName(part).groupBy(*keys, "from_sample", "to_sample").agg(*_merge(""))


def interval_snr(blocks: DataFrame, intervals: DataFrame, keys: list[str], size: int = BLOCK) -> DataFrame:
    """Adds statistic and snr_db of the samples from ``from_sample`` to before ``to_sample`` to every interval.

    Each interval is judged against its own peak. Samples are whole numbers, as in PCM, so none but
    silence lies below the statistic's least amplitude. Intervals without samples, and silent
    ones, get nulls; equal intervals are judged once each.
    """
    sums = interval_sums(blocks, intervals, keys, size)
    eps, n = F.lit(signal.EPSILON), F.col("n")
    mean = (F.col("total") / F.col("peak") + F.col("zeros") * eps) / n
    logs = (F.col("logs") - (n - F.col("zeros")) * F.log("peak") + F.col("zeros") * F.log(eps)) / n
    loud = sums.where("peak > 0").select(*keys, "from_sample", "to_sample", mean.alias("m"), logs.alias("l"), (F.col("energy") / (F.col("peak") * F.col("peak"))).alias("energy"))
    return intervals.join(signal.decibels(loud, [*keys, "from_sample", "to_sample"]), [*keys, "from_sample", "to_sample"], "left")


def interval_rms(blocks: DataFrame, intervals: DataFrame, keys: list[str], size: int = BLOCK) -> DataFrame:
    """keys, from_sample, to_sample and rms of the samples between, for each interval that has some."""
    level = F.sqrt(F.col("energy") / F.col("n") + F.lit(1e-20))
    return interval_sums(blocks, intervals, keys, size).select(*keys, "from_sample", "to_sample", level.alias("rms"))
