"""Looking back and counting along a recording, without a task that meets all of it.

Rows lie in buckets of time by their start. Inside a bucket a window does the work; over the
border goes one row for each bucket: its last values, or its sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_MS = 60_000
_BUCKET = "·bucket"


def _bucketed(rows: DataFrame, bucket: int) -> DataFrame:
    return rows.withColumn(_BUCKET, F.expr(f"start_ms div {bucket}"))


def _inside(keys: list[str]) -> Window:
    return Window.partitionBy(*keys, _BUCKET).orderBy("start_ms", "end_ms")


def with_previous(rows: DataFrame, keys: list[str], columns: dict[str, str], bucket: int = BUCKET_MS) -> DataFrame:
    """Adds new name -> column of the row before in (start_ms, end_ms), null for a recording's first row."""
    held, w = F.struct(*(F.col(old).alias(new) for new, old in columns.items())), _inside(keys)
    near = _bucketed(rows, bucket).withColumns({"·held": held, "·near": F.lag(held).over(w), "·first": F.row_number().over(w) == 1})
    last = near.groupBy(*keys, _BUCKET).agg(F.max_by("·held", F.struct("start_ms", "end_ms")).alias("·last"))  # as the window has dealt them
    carried = last.select(*keys, _BUCKET, F.lag("·last").over(Window.partitionBy(*keys).orderBy(_BUCKET)).alias("·before"))
    found = F.when(F.col("·first"), F.col("·before")).otherwise(F.col("·near"))
    return near.join(carried, [*keys, _BUCKET]).select(*rows.columns, found.alias("·found")).select(*rows.columns, *(F.col(f"·found.{new}").alias(new) for new in columns))


def with_running(rows: DataFrame, keys: list[str], value: Column, name: str, bucket: int = BUCKET_MS) -> DataFrame:
    """Adds ``name``: the sum of ``value`` up to the row in (start_ms, end_ms)."""
    w = _inside(keys).rowsBetween(Window.unboundedPreceding, 0)
    near = _bucketed(rows, bucket).withColumn("·value", value.cast("long")).withColumn("·near", F.sum("·value").over(w))
    sums = near.groupBy(*keys, _BUCKET).agg(F.sum("·value").alias("·sum"))
    before = F.sum("·sum").over(Window.partitionBy(*keys).orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1))
    carried = sums.select(*keys, _BUCKET, F.coalesce(before, F.lit(0)).alias("·before"))
    return near.join(carried, [*keys, _BUCKET]).select(*rows.columns, (F.col("·near") + F.col("·before")).alias(name))


def with_runs(rows: DataFrame, keys: list[str], label: str, name: str = "run", bucket: int = BUCKET_MS) -> DataFrame:
    """Adds the number, from 1, of the run of neighbours with one label that the row lies in; null is a label of its own."""
    w, order = _inside(keys), F.struct("start_ms", "end_ms")
    near = _bucketed(rows, bucket).withColumn("·label", F.struct(F.col(label).alias("x"))).withColumn("·flip", F.coalesce((F.lag("·label").over(w) != F.col("·label")).cast("long"), F.lit(0)))
    near = near.withColumn("·near", F.sum("·flip").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    ends = near.groupBy(*keys, _BUCKET).agg(F.min_by("·label", order).alias("·head"), F.max_by("·label", order).alias("·tail"), F.sum("·flip").alias("·flips"))
    buckets = Window.partitionBy(*keys).orderBy(_BUCKET)
    # a bucket opens a run unless the one before it ends with its first label
    ends = ends.withColumn("·opens", 1 - F.coalesce(F.lag("·tail").over(buckets).eqNullSafe(F.col("·head")).cast("long"), F.lit(0)))
    before = F.sum(F.col("·opens") + F.col("·flips")).over(buckets.rowsBetween(Window.unboundedPreceding, 0)) - F.col("·flips")
    return near.join(ends.select(*keys, _BUCKET, before.alias("·before")), [*keys, _BUCKET]).select(*rows.columns, (F.col("·near") + F.col("·before")).alias(name))
