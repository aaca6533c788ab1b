"""Messages that come again after any delay count once; rejects land beside them."""

from parley.storage import shared
from parley.streaming import messages

SCHEMA = "message_id long, task string, arguments string"


def _uuid(n):
    return f"{n:08x}-0000-4000-8000-000000000000"


def test_redelivery_counts_once_over_runs_and_rejects_are_kept(spark):
    source, log, folder = (shared(spark, n) for n in ("in", "log", "out"))
    part = lambda n: f'{{"audio_part_id": "{_uuid(n)}"}}'

    def run(*rows):
        spark.createDataFrame(list(rows), SCHEMA).coalesce(1).write.mode("append").parquet(source)
        messages.delivered(spark.readStream.schema(SCHEMA).parquet(source), ["task", "entity_id"], ["message_id"], log, folder)

    run((3, "diarize_audio_part", part(1)), (2, "diarize_audio_part", part(1)), (4, "diarize_audio_part", part(2)), (5, "mix", part(1)), (6, "persona_chunk", part(1)), (7, "persona_chunk", "{"), (8, "persona_chunk", None))
    run((1, "diarize_audio_part", part(1)), (9, "quality_filter_audio_part", part(1)))
    run((10, "diarize_audio_part", part(1)), (11, "diarize_audio_part", part(2)), (12, "persona_chunk", '{"chunk_id": 4}'), (13, None, part(1)), (14, "persona_chunk", '{"chunk_id": "' + _uuid(10).upper() + '"}'))
    good, bad = messages.tables(spark, folder, spark.createDataFrame([], SCHEMA).schema)
    assert sorted((r["message_id"], r["entity_id"], r["batch"]) for r in good.collect()) == [(2, _uuid(1), 0), (4, _uuid(2), 0), (9, _uuid(1), 1)]
    want = {5: "task", 6: "arguments", 7: "json", 8: "json", 12: "uuid", 13: "task", 14: "uuid"}
    assert {r["message_id"]: r["reject"] for r in bad.collect()} == want and bad.count() == len(want)
