"""The domain's relations, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EPOCH_US = 1_704_067_200_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _micros():
    return F.unix_micros(F.col("ts").cast("timestamp"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Speaker turns: part_id, start_ms, end_ms, speaker, turn_id, from events."""
    start = F.floor((_micros() - EPOCH_US) / F.lit(4_000_000.0)).cast("long")
    speaker = F.when(F.col("event_type").isin("click", "view"), 0).when(F.col("event_type").isin("purchase", "signup"), 1).otherwise(2)
    return (
        table(spark, sf_dir, "events")
        .select(F.col("user_id").alias("part_id"), start.alias("start_ms"), F.floor(F.col("value") * 200).cast("long").alias("len"), speaker.alias("speaker"), F.col("event_id").alias("turn_id"))
        .select("part_id", "start_ms", (F.col("start_ms") + 100 + F.col("len")).alias("end_ms"), "speaker", "turn_id")
    )


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words with times: conv_id, turn, idx, word, start_ms, end_ms, confidence, from conversations."""
    from pyspark.sql import Window

    said = F.split(F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " ")), " ")
    w = Window.partitionBy("conv_id", "turn").orderBy("idx")
    return (
        table(spark, sf_dir, "conversations")
        .select("conv_id", "turn", F.posexplode(said).alias("idx", "word"))
        .where(F.length("word") > 0)
        .select("conv_id", "turn", "idx", "word", (60 * F.length("word") + 40).cast("long").alias("dur"), (F.pmod(F.col("idx") * 37, F.lit(11)) * 90).cast("long").alias("gap"))
        .withColumn("end_ms", F.sum(F.col("gap") + F.col("dur")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
        .select("conv_id", "turn", "idx", "word", (F.col("end_ms") - F.col("dur")).alias("start_ms"), "end_ms", (F.pmod(F.col("idx").cast("long") * 7919, F.lit(1000)) / 1000.0).alias("confidence"))
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample arrays: track_id, n and the samples in line order, from lineitem."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("track_id"))
        .agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_extendedprice"))).alias("s"))
        .select("track_id", F.transform("s", lambda x: x["l_extendedprice"]).alias("samples"))
    )


def probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability series: series_id, idx, p, from embeddings."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("series_id"), F.posexplode("embedding").alias("idx", "v")).select("series_id", "idx", F.abs("v").cast("double").alias("p"))
