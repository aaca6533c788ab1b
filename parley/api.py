"""What the service offers as functions over tables: ingest, lookup, trigger, planning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import intervals, lineage, planning
from .policy import WindowPolicy
from .sources import media

# Stages in order, the status an entity needs for each besides failed, and the one it has meanwhile.
STAGES = {
    "split": ("pending", "splitting"),
    "diarize": ("pending", "diarizing"),
    "quality_filter": ("diarized", "filtering"),
    "separate": ("pending", "separating"),
    "transcribe": ("separated", "transcribing"),
    "persona": ("transcribed", "persona_generating"),
    "reconstruct": ("persona_generated", "reconstructing"),
    "extend": ("reconstructed", "extending"),
}
# What a stage says of entities that it may not claim.
SAID = {
    "diarize": {"diarizing": "already_processing", "filtering": "already_processing", "diarized": "dispatch_ready", "completed": "completed"},
    "separate": {"separating": "already_processing"},
}
#: Columns that a claim makes null.
CLEARED = {"diarize": ("diarization_uri",)}


def scan_uploads(spark: SparkSession, path: str) -> DataFrame:
    """Files of a folder with digest, size and suffix; empty and oversized ones are left out."""
    files = spark.read.format("binaryFile").load(path).where(media.valid_upload(F.col("length")))
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", F.col("length").alias("size_bytes"), F.sha1("content").alias("content_sha1"), media.upload_suffix(name).alias("suffix"), media.wav_header(F.col("content")).alias("header"))


def ingest(uploads: DataFrame, known: DataFrame) -> DataFrame:
    """New recordings: contents not known yet, one row for each, with an id made from the digest."""
    fresh = uploads.join(known.select("content_sha1"), "content_sha1", "left_anti")
    first = fresh.groupBy("content_sha1").agg(F.min("path").alias("path"), F.min("size_bytes").alias("size_bytes"))
    return first.select(F.sha2(F.concat_ws("/", F.lit("raw"), "content_sha1"), 256).alias("id"), "content_sha1", "path", "size_bytes", F.lit("pending").alias("status"))


def recording(recordings: DataFrame, id_: str) -> DataFrame:
    return recordings.where(F.col("id") == id_)


def trigger(current: DataFrame, ids: DataFrame, stage: str) -> DataFrame:
    """Claims entities for a stage; each id's disposition says whether it was claimed."""
    if stage not in STAGES:
        raise ValueError(f"unknown stage: {stage}")
    needed, meanwhile = STAGES[stage]
    clear = tuple(c for c in CLEARED.get(stage, ()) if c in current.columns)
    return lineage.claim(current, ids, "id", "status", [needed, "failed"], meanwhile, SAID.get(stage), clear)


def windows(turns: DataFrame, limit: DataFrame, keys: list[str], policy: WindowPolicy = WindowPolicy()) -> DataFrame:
    """Conversation windows of recordings: speech, gap groups, gap split, padding, index."""
    speech = intervals.merge(turns, keys)
    groups = intervals.group_by_gap(speech.drop("n"), keys, policy.gap, policy.least)
    fits = groups.where(F.col("end_ms") - F.col("start_ms") <= policy.most).select(*keys, "start_ms", "end_ms")
    large = groups.where(F.col("end_ms") - F.col("start_ms") > policy.most).select(*keys, F.col("start_ms").alias("g_start"), F.col("end_ms").alias("g_end"))
    inside = speech.join(large, keys).where("start_ms >= g_start and end_ms <= g_end").select(*keys, "g_start", "start_ms", "end_ms")
    pieces = fits.unionByName(planning.gap_split(inside, [*keys, "g_start"], policy.most).select(*keys, "start_ms", "end_ms"))
    return intervals.indexed(intervals.pad(pieces.join(limit, keys), "limit", policy.before, policy.after, policy.most).drop("limit"), keys)
