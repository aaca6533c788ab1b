"""Streaming control plane: duplicate-safe events and per-entity state, run to the end of input."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..storage import shared


def source(spark: SparkSession, sf_dir: str, table: str = "events") -> DataFrame:
    path = f"{sf_dir}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    folder, name = path.rsplit("/", 1)
    return spark.readStream.schema(schema).option("pathGlobFilter", name if not _is_folder(spark, path) else "*").parquet(path if _is_folder(spark, path) else folder)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def drained(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Run a stream over all input there is into a Parquet folder and return what it wrote."""
    spark = stream.sparkSession
    out, log = shared(spark, name), shared(spark, f"{name}-log")
    stream.writeStream.format("parquet").outputMode(mode).option("path", out).option("checkpointLocation", log).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def deduplicated(events: DataFrame, keys: list[str]) -> DataFrame:
    """Events delivered more than once count once, however late they come: without a watermark no key is forgotten."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).dropDuplicates(keys)


def counted_state(events: DataFrame) -> DataFrame:
    """Running number and value sum of each user's events, from custom state without timeouts."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for pdf in batches:
            n += len(pdf)
            total += float(pdf["value"].sum())
        state.update((n, total))
        yield pd.DataFrame({"user_id": [key[0]], "n_events": [n], "total": [total]})

    return events.groupBy("user_id").applyInPandasWithState(update, "user_id long, n_events long, total double", "n long, total double", "update", GroupStateTimeout.NoTimeout)


def upserted(events: DataFrame, path: str, keys: list[str]) -> None:
    """A foreachBatch sink that doubles neither a redelivered batch nor a key of an earlier one.

    Each batch has its own folder, which a redelivery overwrites, and leaves out the keys of all
    other folders.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark, fresh = batch.sparkSession, batch.dropDuplicates(keys)
        if _exists(spark, path):
            schema = batch.select(*keys).schema.add("batch", "long")
            before = spark.read.schema(schema).parquet(path).where(F.col("batch") != number)
            fresh = fresh.join(before.select(*keys).distinct(), keys, "left_anti")
        fresh.write.mode("overwrite").parquet(f"{path}/batch={number}")

    log = shared(events.sparkSession, "upsert-log")
    events.writeStream.foreachBatch(write).option("checkpointLocation", log).trigger(availableNow=True).start().awaitTermination()
