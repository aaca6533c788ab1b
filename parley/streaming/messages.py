"""Task messages: a closed contract, and delivery at least once that counts once, however late it comes again.

Every message's key is remembered in the state store for as long as the stream's checkpoint
lives, so no watermark or time limit forgets it. Rejected messages go to a table of their own
in the same batch as the accepted ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Task names, each with the one argument that it takes.
TASKS = {
    "split_raw_audio_into_parts": "raw_audio_id",
    "diarize_audio_part": "audio_part_id",
    "quality_filter_audio_part": "audio_part_id",
    "separate_chunk": "chunk_id",
    "transcribe_chunk": "chunk_id",
    "persona_chunk": "chunk_id",
    "reconstruct_chunk": "chunk_id",
    "extend_chunk": "chunk_id",
}
UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
_STATE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def argument_of(task: Column) -> Column:
    return reduce(lambda out, t: F.when(task == t, F.lit(TASKS[t])).otherwise(out), TASKS, F.lit(None).cast("string"))


def judged(messages: DataFrame, task: str = "task", arguments: str = "arguments") -> DataFrame:
    """Adds entity_id and reject: ``task`` (not registered), ``json`` (no object), ``arguments`` (other keys than the task's) or ``uuid``.

    A task takes one argument, the canonical text of a UUID. Null in either column is rejected.
    """
    wanted = argument_of(F.col(task))
    said = F.try_parse_json(F.col(arguments))
    keys = F.when(F.schema_of_variant(said).startswith("OBJECT"), F.json_object_keys(F.col(arguments)))
    value = F.get(F.map_values(F.try_variant_get(said, "$", "map<string,variant>")), 0)
    entity = F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))
    reject = (
        F.when(wanted.isNull(), "task")
        .when(keys.isNull(), "json")
        .when((F.size(keys) != 1) | (F.get(keys, 0) != wanted), "arguments")
        .when(~F.coalesce(entity.rlike(UUID), F.lit(False)), "uuid")
    )
    return messages.withColumn("reject", reject).withColumn("entity_id", F.when(F.col("reject").isNull(), entity))


class _FirstDelivery(StatefulProcessor):
    """Passes on the first message of its key, ever; the state is one flag a key."""

    def __init__(self, columns: list[str], order: list[str]) -> None:
        self.columns, self.order = columns, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "first boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803  names of Spark's interface
        if self.seen.exists():
            for _ in rows:
                pass
            return
        least = None
        for pdf in rows:
            both = pdf if least is None else pd.concat([least, pdf])
            least = both.sort_values(self.order, kind="stable").head(1)
        self.seen.update((True,))
        yield least[self.columns]

    def close(self) -> None:
        pass


def first_deliveries(messages: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first delivery of each key; of several in one batch the smallest by ``order``.

    Needs the RocksDB state store, which keeps keys on disk and their changes in the checkpoint.
    """
    schema = StructType(messages.schema.fields)
    return messages.groupBy(*keys).transformWithStateInPandas(_FirstDelivery(messages.columns, order), schema, "append", "none")


def delivered(stream: DataFrame, keys: list[str], order: list[str], log: str, folder: str) -> None:
    """Run a stream of messages to the end of its input: first good deliveries and rejects, by one write a batch.

    A batch has a folder under its number, which a run of it again replaces, so a failure loses
    and doubles nothing. ``log`` is the checkpoint that later runs go on from.
    """
    spark = stream.sparkSession
    rows = judged(stream).select(*stream.columns, "entity_id", "reject")
    both = first_deliveries(rows.where("reject is null"), keys, order).unionByName(rows.where("reject is not null"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    before = spark.conf.get(_STATE)
    spark.conf.set(_STATE, _ROCKS)
    try:
        both.writeStream.foreachBatch(write).option("checkpointLocation", log).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(_STATE, before)


def tables(spark: SparkSession, folder: str, columns: StructType) -> tuple[DataFrame, DataFrame]:
    """Accepted messages and rejects of all batches so far; ``columns`` are those of the stream."""
    schema = StructType([*columns.fields, StructField("entity_id", StringType()), StructField("reject", StringType()), StructField("batch", LongType())])
    rows = spark.read.schema(schema).parquet(folder)
    return rows.where("reject is null").drop("reject"), rows.where("reject is not null").drop("entity_id")
