"""The service's functions, track helpers and streaming sinks."""

import hashlib
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from parley import api, storage
from parley.operators import lineage, tracks, validators
from parley.plans.more import QUERIES
from parley.sources import media
from parley.streaming import control


def test_uploads_are_scanned_and_ingested_once(spark, tmp_path):
    wav = media.to_wav(np.arange(100), 16_000)
    for name, data in {"a.WAV": wav, "b.wav": wav, "empty.mp3": b"", "noext": b"x"}.items():
        (tmp_path / name).write_bytes(data)
    found = api.scan_uploads(spark, f"file://{tmp_path}")
    assert {r["path"].rsplit("/", 1)[1]: r["suffix"] for r in found.collect()} == {"a.WAV": ".wav", "b.wav": ".wav", "noext": ".upload"}
    new = api.ingest(found, spark.createDataFrame([(hashlib.sha1(b"x").hexdigest(),)], "content_sha1 string")).collect()
    assert [(r["content_sha1"], r["status"]) for r in new] == [(hashlib.sha1(wav).hexdigest(), "pending")]


def test_trigger_claims_what_may_move(spark):
    now = spark.createDataFrame([("a", "pending"), ("b", "completed"), ("c", "failed")], "id string, status string")
    ids = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("a",)], "id string")
    got = {r["id"]: r["disposition"] for r in api.trigger(now, ids, "split").collect()}
    assert got == {"a": "claimed", "b": "already_completed", "c": "claimed", "d": "missing"}
    with pytest.raises(ValueError):
        api.trigger(now, ids, "nothing")


def test_windows_split_long_groups(spark):
    turns = spark.createDataFrame([(1, 0, 40_000), (1, 50_000, 80_000), (1, 90_000, 130_000)], "k long, start_ms long, end_ms long")
    limit = spark.createDataFrame([(1, 131_000)], "k long, limit long")
    got = api.windows(turns, limit, ["k"], api.WindowPolicy(most=90_000)).collect()
    assert sorted((r["start_ms"], r["end_ms"], r["part_index"]) for r in got) == [(0, 40_250, 0), (49_750, 130_250, 1)]


def test_rendering_replaces_and_normalises(spark):
    row = spark.range(1).select(
        tracks.rendered(F.array(F.lit(1), F.lit(2)), F.array(F.array(*(F.lit(5).cast("smallint"),) * 3), F.array(F.lit(9).cast("smallint"))), F.lit(6)).alias("t"),
        tracks.normalised(F.array(F.array(F.lit(1.0)), F.array(F.lit(-2.0)))).alias("n"),
        tracks.silent(F.array(F.lit(0.0), F.lit(1e-7))).alias("s"),
    ).first()
    assert row["t"] == [0, 5, 9, 5, 0, 0] and row["n"] == [[0.45], [-0.9]] and row["s"]


def test_illegal_transitions_by_level(spark):
    rows = [(1, 0, "pending"), (1, 1, "splitting"), (1, 2, "split_completed"), (1, 3, "splitting"), (2, 0, "failed"), (2, 1, "splitting"), (2, 2, "failed")]
    events = spark.createDataFrame(rows, "id int, seq int, status string")
    got = lineage.illegal_transitions(events, ["id"], "seq", "status", lineage.RAW_TRANSITIONS).collect()
    assert [(r["id"], r["from_status"], r["status"]) for r in got] == [(1, "split_completed", "splitting")]
    for legal in (lineage.RAW_TRANSITIONS, lineage.PART_TRANSITIONS, lineage.CHUNK_TRANSITIONS):
        assert not any(a in ("completed", "rejected") for a, _ in legal)
    every = {*lineage.RAW_TRANSITIONS, *lineage.PART_TRANSITIONS, *lineage.CHUNK_TRANSITIONS}
    assert all({(needed, meanwhile), ("failed", meanwhile)} <= every for needed, meanwhile in api.STAGES.values())


def test_diarize_claims_say_what_stands_and_clear_the_old_result(spark):
    now = spark.createDataFrame([("a", "failed", "old"), ("b", "filtering", "x"), ("c", "diarized", "y"), ("d", "completed", "z")], "id string, status string, diarization_uri string")
    got = {r["id"]: (r["status"], r["diarization_uri"], r["disposition"]) for r in api.trigger(now, now.select("id"), "diarize").collect()}
    assert got == {"a": ("diarizing", None, "claimed"), "b": ("filtering", "x", "already_processing"), "c": ("diarized", "y", "dispatch_ready"), "d": ("completed", "z", "completed")}


def test_window_seeds_are_slices_of_one_digest(spark):
    from parley.operators import tracks

    chunk = uuid.uuid5(uuid.NAMESPACE_URL, "chunk")
    row = spark.createDataFrame([(str(chunk), 3)], "id string, n int").select(tracks.window_seeds("id", "n").alias("s")).first()
    drawn = hashlib.shake_256(chunk.bytes).digest(24)
    assert [int(x) for x in row["s"]] == [int.from_bytes(drawn[i : i + 8], "big") for i in (0, 8, 16)]


def test_keys_of_earlier_batches_are_not_stored_again(spark, tmp_path):
    source, out = tmp_path / "in", storage.shared(spark, "upserts")
    for k, ids in enumerate([[1, 2, 2], [2, 3]]):
        spark.createDataFrame([(i, k) for i in ids], "id long, k int").coalesce(1).write.parquet(f"{source}/{k}")
    stream = spark.readStream.schema("id long, k int").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(source))
    control.upserted(stream, out, ["id"])
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [1, 2, 3]


def test_redelivered_batches_do_not_double(spark, sf_dir):
    out = storage.shared(spark, "upserts")
    for _ in range(2):
        control.upserted(control.source(spark, sf_dir).select("event_id", "user_id"), out, ["event_id"])
    assert spark.read.parquet(out).count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()


@pytest.mark.parametrize("name", ["window_seeds", "rendered_tracks", "conversation_windows"])
def test_queries_without_sql_give_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_schedules_break_no_rule(spark, sf_dir):
    assert validators.schedules(QUERIES["timeline_schedule"](spark, sf_dir), ["part_id"]).count() == 0


def test_entry_points_import_without_the_optional_part(monkeypatch):
    import importlib
    import sys

    import __spark_entry__ as driver

    for name in [n for n in sys.modules if n.startswith("parley.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    import parley

    monkeypatch.delattr(parley, "llm", raising=False)
    monkeypatch.setitem(sys.modules, "parley.llm", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    try:
        importlib.reload(driver)
        assert "speech_union" in driver.queries() and not any(q.startswith("op") or q == "pipeline" for q in driver.queries())
    finally:
        monkeypatch.undo()
        importlib.reload(driver)


def test_wav_files_are_parsed_chunk_by_chunk():
    import io
    import struct
    import wave

    def made(channels, width, n, rate=8_000):
        out = io.BytesIO()
        with wave.open(out, "wb") as w:
            w.setnchannels(channels)
            w.setsampwidth(width)
            w.setframerate(rate)
            w.writeframes(bytes(range(256)) * 2 if n is None else b"\1" * (n * channels * width))
        return out.getvalue()

    for channels, width, n in ((1, 2, 5), (2, 2, 3), (1, 1, 7), (2, 3, 4), (1, 2, 0)):
        raw = made(channels, width, n)
        assert media.parse_wav(raw) == (channels, 8_000, width * 8, n, 44, None)
        assert media.parse_wav(raw[:36] + b"LIST\3\0\0\0abc\0" + raw[36:]) == (channels, 8_000, width * 8, n, 56, None)
        if n:
            assert media.parse_wav(raw[:-1])[5] == "data"
    raw = made(1, 2, 3)
    assert media.to_wav(np.array([257, 257, 257]), 8_000) == raw
    cases = {None: "riff", b"": "riff", b"RIFX" + raw[4:]: "riff", raw[:12]: "fmt", raw[:36]: "data", raw[:12] + raw[36:]: "fmt", raw[:20] + struct.pack("<H", 3) + raw[22:]: "codec", raw[:34] + struct.pack("<H", 12) + raw[36:]: "width"}
    assert {k: media.parse_wav(k)[5] for k in cases} == cases
