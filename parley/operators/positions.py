"""Places of rows in an order, and joins by place, without a task that meets a whole key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from ..storage import stored


def numbered(rows: DataFrame, keys: list[str], order: list[str], name: str = "position") -> DataFrame:
    """``rows`` with their place, from 0, among the rows of their keys.

    Rows are sorted over the cluster by ranges of (keys, order), so a key with most rows lies in
    many partitions, each of which counts its own. What a partition needs from those before it
    is one number: the rows of its first key that they hold. Rows that tie in the whole order
    share a partition and get places in any order. Null keys are a key of their own.
    """
    run = F.xxhash64(*(F.col(f"`{k}`") for k in keys)) if keys else F.lit(0).cast("long")
    cuts = [F.col(f"`{c}`") for c in (*keys, *order)]
    whole = F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("whole")  # columns of any name travel as one
    placed = rows.repartitionByRange(*cuts).sortWithinPartitions(*cuts).select(whole, run.alias("run"))
    schema = StructType([*placed.schema.fields, StructField("local", LongType()), StructField("first", BooleanType()), StructField("part", IntegerType()), StructField("row", LongType())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, run, local, first = TaskContext.get().partitionId(), 0, None, -1, True
        for batch in batches:
            runs = batch.column("run").to_numpy()
            if not len(runs):
                continue
            fresh = np.concatenate([[row > 0 and runs[0] != run], runs[1:] != runs[:-1]])
            at = np.arange(len(runs), dtype=np.int64)
            begun = np.maximum.accumulate(np.where(fresh, at, -local - 1))  # rows of an open run lie before the batch
            inside = first & ~np.logical_or.accumulate(fresh)
            extra = [pa.array(at - begun), pa.array(inside), pa.array(np.full(len(at), part, np.int32)), pa.array(row + at)]
            row, run, local, first = row + len(at), runs[-1], int(at[-1] - begun[-1]), bool(inside[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=["whole", "run", "local", "first", "part", "row"])

    kept = stored(placed.mapInArrow(counted, schema), "numbered")
    parts = kept.groupBy("part").agg(
        F.max(F.when(F.col("first"), F.col("run"))).alias("head"),
        F.count(F.when(F.col("first"), 1)).alias("n_head"),
        F.max_by("run", "row").alias("tail"),
        (F.max_by("local", "row") + 1).alias("n_tail"),
        F.count("*").alias("n"),
    )
    before, tail, held = [], None, 0
    for p in parts.orderBy("part").collect():  # a row for each partition
        more = held if p["head"] == tail and before else 0
        before.append((p["part"], more))
        tail, held = p["tail"], more + p["n"] if p["n_head"] == p["n"] else p["n_tail"]
    offsets = F.broadcast(kept.sparkSession.createDataFrame(before, "part int, before long"))  # as many rows as partitions
    position = F.col("local") + F.when(F.col("first"), F.col("before")).otherwise(0)
    return kept.join(offsets, "part").select(*(F.col(f"whole.`{c}`") for c in rows.columns if c != name), position.alias(name))


def zipped(left: DataFrame, right: DataFrame, keys: list[str], order: list[str], name: str = "position") -> DataFrame:
    """Rows of both sides that have one place in their keys, the right side's columns in ``other``.

    Sides of different lengths leave rows without a partner: strict callers ask ``lengths`` first.
    The join's key is (keys, place), so one long track spreads over all tasks.
    """
    a = numbered(left, keys, order, name)
    b = numbered(right, keys, order, name)
    b = b.select(*keys, name, F.struct(*(F.col(f"`{c}`") for c in right.columns if c not in keys)).alias("other"))
    return a.join(b, [*keys, name], "full")


def lengths(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose sides differ in length: keys, n_left, n_right. A key that one side lacks has 0 there."""
    both = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))
    return both.groupBy(*keys).agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right")).where("n_left <> n_right")
