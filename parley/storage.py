"""Tables kept in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; where the session names none, a temporary one is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="parley-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written there and read again, which cuts its lineage."""
    path = shared(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
