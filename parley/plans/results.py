"""Queries of JSON documents: made from the tables, some faulty by their ids' remainders, and judged node by node."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators import documents, validators
from ..sources import views as v
from ..storage import shared, stored
from ..streaming import control, messages
from . import oracles as o
from .more import ORACLES, against
from .queries import PART

__all__ = ["ORACLES"]

KEY = ["o_orderkey"]


def _odd(n: int, k: int) -> Column:
    return F.col("o_orderkey") % n == k


def _orders(spark, d):
    """Orders spread over all tasks while they are small: their documents are made and judged where they lie."""
    few = v.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return few.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_orderkey")


def _sha(*parts: Column | str) -> Column:
    return F.sha2(F.concat_ws("/", *(F.lit(p) if isinstance(p, str) else p for p in parts)), 256)


def _obj(**fields: Column | str | int | None) -> Column:
    """A JSON object; fields that are null in a row are left out of it."""
    return F.struct(*((x if isinstance(x, Column) else F.lit(x)).alias(k) for k, x in fields.items()))


def _faults(rows: dict[str, str], cut: str) -> str:
    """A row for each (path, rule) that holds for an order, but for documents that are no JSON only that."""
    kept = " UNION ALL ".join(f"SELECT o_orderkey, '{k.split(' ')[0]}' AS path, '{k.split(' ')[1]}' AS rule FROM orders WHERE NOT ({cut}) AND {c}" for k, c in rows.items())
    return f"SELECT o_orderkey, '$' AS path, 'json' AS rule FROM orders WHERE {cut} UNION ALL {kept}"


def _judged(rows, doc: Column, check):
    """Documents as they would be found in storage, some without their last character, against what was asked.

    Rows hold both, so that documents are made, parsed and judged as they stream by.
    """
    kept = rows.withColumn("d", doc)
    text = F.when(_odd(59, 7), F.expr("substring(d, 1, length(d) - 1)")).otherwise(F.col("d"))
    kept = kept.withColumn("document", text)
    return check(kept, kept, KEY).select("o_orderkey", "path", "rule")


_THIRD = {f"$.input_speaker_audio[2]{f} unexpected": "o_orderkey % 61 = 8" for f in ("", ".output_slot", ".diarization_speaker_id", ".uri", ".size_bytes", ".sha256")}


@against(_faults({
    "$.backend value": "o_orderkey % 31 = 1", "$.model.revision missing": "o_orderkey % 37 = 2", "$.surplus unexpected": "o_orderkey % 41 = 3", "$.input_speaker_audio[1].size_bytes value": "o_orderkey % 43 = 4",
    "$.artifacts.transcript.sha256 value": "o_orderkey % 47 = 5", "$.schema_version kind": "o_orderkey % 53 = 6", "$.input_speaker_audio value": "o_orderkey % 61 = 8", **_THIRD,
}, "o_orderkey % 59 = 7"))
def transcription_results(spark, d):
    key = F.col("o_orderkey")
    rows = _orders(spark, d)
    for k in (0, 1):
        rows = rows.withColumns({f"speaker_{k}": (F.lit(k) + key % 2) % 2, f"input_uri_{k}": F.concat_ws("/", key, F.lit(f"track-{k}.wav")), f"input_size_{k}": key * 2 + k + 44, f"input_sha_{k}": _sha(key.cast("string"), str(k))})
    for n in ("transcript", "word_alignment"):
        rows = rows.withColumns({f"{n}_uri": F.concat_ws("/", key, F.lit(f"{n}.json")), f"{n}_size": F.col("o_custkey").cast("long") + 7, f"{n}_sha": _sha(key.cast("string"), n)})
    track = lambda k, slot: _obj(output_slot=slot, diarization_speaker_id=F.col(f"speaker_{k}"), uri=F.col(f"input_uri_{k}"), size_bytes=F.col(f"input_size_{k}") + F.when(_odd(43, 4), k).otherwise(0), sha256=F.col(f"input_sha_{k}"))
    two = F.array(track(0, 0), track(1, 1))
    artifact = lambda n, sha: _obj(uri=F.col(f"{n}_uri"), size_bytes=F.col(f"{n}_size"), sha256=sha)
    doc = _obj(
        schema_version=F.when(~_odd(53, 6), F.lit("1")).otherwise('"1"'),
        backend=F.when(_odd(31, 1), "other").otherwise("parakeet_tdt"),
        language="en",
        model=_obj(repo_id="nvidia/parakeet-tdt-0.6b-v3", config_version="parakeet-v1", revision=F.when(~_odd(37, 2), F.sha1(key.cast("string")))),
        input_speaker_audio=F.when(_odd(61, 8), F.concat(two, F.array(track(0, 2)))).otherwise(two),
        artifacts=_obj(transcript=artifact("transcript", F.when(_odd(47, 5), F.upper("transcript_sha")).otherwise(F.col("transcript_sha"))), word_alignment=artifact("word_alignment", F.col("word_alignment_sha"))),
        surplus=F.when(_odd(41, 3), 1),
    )
    # the version is a number in sound documents and a text in others
    said = F.regexp_replace(F.to_json(doc), r'"schema_version":"(\\")?1(\\")?"', F.when(_odd(53, 6), '"schema_version":"1"').otherwise('"schema_version":1'))
    return _judged(rows, said, documents.transcription_results)


def _tracks(length: Column, rate: Column) -> Column:
    return F.array(*(_obj(speaker_id=k, diarization_speaker_id=F.col(f"speaker_{k}"), uri=F.col(f"audio_uri_{k}"), sample_rate_hz=rate if k else F.lit(44_100), duration_ms=length if k else F.col("length"), size_bytes=F.col("length") * 88 + 44, sha256=_sha(F.col("o_orderkey").cast("string"), f"t{k}")) for k in (0, 1)))


def _artifact(uri: str, sha: Column | None = None) -> Column:
    return _obj(uri=F.col(uri), size_bytes=F.col("length") + 3, sha256=_sha(F.col(uri)) if sha is None else sha)


def _claims(spark, d):
    key = F.col("o_orderkey").cast("string")
    rows = _orders(spark, d).select("o_orderkey", "o_custkey", (F.round("o_totalprice").cast("long") + 1000).alias("length"))
    rows = rows.withColumns({n: F.concat_ws("/", key, F.lit(n)) for n in ("manifest_uri", "transcript_uri", "script_uri", "persona_uri", "output_transcript_uri", "audio_uri_0", "audio_uri_1", "reference_uri_0", "reference_uri_1", "separated_uri_0", "separated_uri_1")})
    return rows.withColumns({"speaker_0": F.col("o_orderkey") % 2, "speaker_1": 1 - F.col("o_orderkey") % 2, "duration_ms": F.col("length") * 2})


@against(_faults({
    "$.models.audio_tags model": "o_orderkey % 31 = 1", "$.speaker_mapping[1].diarization_speaker_id value": "o_orderkey % 37 = 2", "$.artifacts.speaker_audio[1].duration_ms track_length": "o_orderkey % 41 = 3",
    "$.artifacts.manifest.uri value": "o_orderkey % 43 = 4", "$.utterance_count positive": "o_orderkey % 47 = 5", "$.artifacts.speaker_audio[1].sample_rate_hz value": "o_orderkey % 53 = 6", "$.source_duration_ms value": "o_orderkey % 61 = 8",
}, "o_orderkey % 59 = 7"))
def reconstruction_results(spark, d):
    rows = _claims(spark, d)
    who = F.array(*(_obj(speaker_id=k, diarization_speaker_id=F.when(_odd(37, 2), 5).otherwise(F.col("speaker_1")) if k else F.col("speaker_0")) for k in (0, 1)))
    doc = _obj(
        schema_version=1, config_version="source-reconstruction-v1", backend="openrouter",
        models=_obj(audio_tags=F.when(_odd(31, 1), "nameless").otherwise("maker/model"), tts="fish-audio/s2.1-pro"), language="en",
        source_duration_ms=F.col("duration_ms") + F.when(_odd(61, 8), 1).otherwise(0), actual_duration_ms=F.col("length"), utterance_count=F.when(_odd(47, 5), 0).otherwise(3), speaker_mapping=who,
        artifacts=_obj(manifest=_obj(uri=F.when(_odd(43, 4), "elsewhere").otherwise(F.col("manifest_uri")), size_bytes=9, sha256=_sha("m")), transcript=_artifact("transcript_uri"),
            speaker_audio=_tracks(F.col("length") + F.when(_odd(41, 3), 1).otherwise(0), F.when(_odd(53, 6), 16_000).otherwise(44_100))),
    )
    return _judged(rows, F.to_json(doc), documents.reconstruction_results)


_REF = "$.inputs.speaker_references"


@against(_faults({
    "$.models.tts.id value": "o_orderkey % 31 = 1", "$.inputs.persona.sha256 value": "o_orderkey % 37 = 2", f"{_REF}[0].reference_audio.duration_ms length": "o_orderkey % 41 = 3", f"{_REF}[0].source_audio source": "o_orderkey % 43 = 4",
    f"{_REF}[1].selection.timebase timebase": "o_orderkey % 47 = 5", f"{_REF}[1].selection.segments[0] pure": "o_orderkey % 53 = 6", f"{_REF}[1].reference_audio.duration_ms length": "o_orderkey % 53 = 6", f"{_REF}[0].selection.segments segments": "o_orderkey % 61 = 8",
    f"{_REF}[0].selection.segments[1].surplus unexpected": "o_orderkey % 67 = 9",
}, "o_orderkey % 59 = 7"))
def extension_results(spark, d):
    key, n = F.col("o_orderkey").cast("string"), F.col("length")
    rows = _claims(spark, d)
    for name in ("transcript", "persona"):
        rows = rows.withColumns({f"{name}_size": n + 3, f"{name}_sha": _sha(F.col(f"{name}_uri"))})
    for k in (0, 1):
        rows = rows.withColumns({f"separated_size_{k}": n + 3, f"separated_sha_{k}": _sha(F.col(f"separated_uri_{k}")), f"pure_start_{k}": F.lit(100), f"pure_end_{k}": 100 + n})
    model = lambda name: _obj(backend="openrouter", id=name, config_version="dialogue-extension-v1")
    segment = lambda a, b, more=F.lit(0), extra=F.lit(None).cast("int"): _obj(start_ms=a, end_ms=b, duration_ms=b - a + more, surplus=extra)
    # a segment's length and the sum of all disagree with the bounds together, so that only the segments are broken
    joined = F.array(segment(F.lit(0), n, F.when(_odd(61, 8), 1).otherwise(0)), segment(n + 200, n + 700, extra=F.when(_odd(67, 9), 1)))
    late = F.when(_odd(53, 6), 5).otherwise(0)
    audio = lambda length, sha: _obj(sample_rate_hz=16_000, duration_ms=length, size_bytes=n + 3, sha256=sha)
    first = _obj(
        speaker_id=0, diarization_speaker_id=F.col("speaker_0"), source="diarization_reference", source_audio=_obj(uri=F.col("reference_uri_0"), size_bytes=n + 3 + F.when(_odd(43, 4), 1).otherwise(0), sha256=_sha(F.col("reference_uri_0"))),
        selection=_obj(timebase="audio_part", segments=joined), reference_audio=audio(n + 1000 + F.when(_odd(61, 8), 1).otherwise(0) + F.when(_odd(41, 3), 2).otherwise(0), _sha(F.col("reference_uri_0"))), reference_text_sha256=_sha(key, "text"),
    )
    second = _obj(
        speaker_id=1, diarization_speaker_id=F.col("speaker_1"), source="separated_track_slice", source_audio=_artifact("separated_uri_1"),
        selection=_obj(timebase=F.when(_odd(47, 5), "audio_part").otherwise("chunk"), segments=F.array(segment(100 + late, 100 + n))), reference_audio=audio(n - late, _sha(key, "slice")), reference_text_sha256=_sha(key, "text"),
    )
    doc = _obj(
        schema_version=1, backend="openrouter", models=_obj(dialogue=model("maker/model"), reference_asr=model("fish-audio/transcribe-1"), tts=model(F.when(_odd(31, 1), "maker/other").otherwise("fish-audio/s2.1-pro"))), language="en",
        target_duration_ms=60_000, actual_duration_ms=n,
        inputs=_obj(transcript=_artifact("transcript_uri"), persona=_artifact("persona_uri", _sha(F.when(_odd(37, 2), "x").otherwise(F.col("persona_uri")))), speaker_reference_manifest=_artifact("manifest_uri"), speaker_references=F.array(first, second)),
        artifacts=_obj(script=_artifact("script_uri"), transcript=_artifact("output_transcript_uri"), speaker_audio=_tracks(n, F.lit(44_100))),
    )
    return _judged(rows, F.to_json(doc), documents.extension_results)


@against(_faults({
    "$.speakers[1].overall_tone tone": "o_orderkey % 31 = 1", "$.speakers[0].laugh kind": "o_orderkey % 37 = 2", "$.usage.total_tokens total": "o_orderkey % 41 = 3", "$.speakers[0].name note": "o_orderkey % 43 = 4",
    "$.scene.description missing": "o_orderkey % 47 = 5", "$.speakers[1].speaker_id value": "o_orderkey % 53 = 6", "$.speakers[1].secondary_emotion second_emotion": "o_orderkey % 61 = 8",
}, "o_orderkey % 59 = 7"))
def persona_documents(spark, d):
    rows = _claims(spark, d).withColumn("model", F.lit("maker/model"))

    def speaker(slot: int) -> Column:
        flag = lambda n: F.when(_odd(37, 2), '"no"').otherwise("true") if n == "laugh" and not slot else F.lit("false")
        name = F.when(_odd(43, 4), " Ann").otherwise("Ann") if not slot else F.lit("Bob")
        id_ = F.lit(str(slot)) if not slot else F.when(_odd(53, 6), "7").otherwise("1")
        said = _obj(speaker_id=id_, name=name, age=F.lit("@null"), ethnicity=F.lit("@null"), gender="none told", evidence=F.lit("@null"), tag="calm voice", alpha="low", primary_emotion="sad",
            secondary_emotion=F.when(_odd(61, 8), "bored").otherwise("@null") if slot else F.lit("happy"), emotion_intensity="high", overall_tone=F.when(_odd(31, 1), "loud").otherwise("warm") if slot else F.lit("cold"))
        flags = F.concat(*(F.concat(F.lit(f',"{n}":'), flag(n)) for n in ("laugh", "cry", "whisper", "shout", "sigh")), F.lit("}"))
        return F.concat(F.regexp_replace(F.regexp_replace(F.to_json(said), '"@null"', "null"), r"\}$", ""), flags)

    usage = _obj(model=F.col("model"), in_tokens=F.col("o_orderkey"), out_tokens=9, total_tokens=F.when(_odd(41, 3), 1).when(_odd(2, 0), 0).otherwise(F.col("o_orderkey") + 9), cost_usd=F.lit(0.25))
    mapping = F.array(*(_obj(output_slot=k, diarization_speaker_id=F.col(f"speaker_{k}")) for k in (0, 1)))
    head = _obj(schema_version=1, backend="openrouter", config_version="persona-v1", language="en", scene=_obj(description=F.when(~_odd(47, 5), "Two people talk."), overall_tone="warm", emotion_intensity="low"), usage=usage, speaker_mapping=mapping)
    doc = F.concat(F.regexp_replace(F.to_json(head), r"\}$", ""), F.lit(',"speakers":['), speaker(0), F.lit(","), speaker(1), F.lit("]}"))
    return _judged(rows, doc, documents.persona_documents)


@against(_faults({
    "$.model.id value": "o_orderkey % 31 = 1", "$.input_audio.size_bytes value": "o_orderkey % 37 = 2", "$.artifact.sha256 missing": "o_orderkey % 41 = 3", "$.note unexpected": "o_orderkey % 43 = 4", "$.input_transcript.uri value": "o_orderkey % 47 = 5",
}, "o_orderkey % 59 = 7"))
def persona_results(spark, d):
    names = ("input_audio", "input_transcript", "artifact")
    key = F.col("o_orderkey").cast("string")
    rows = _claims(spark, d).withColumn("model", F.lit("maker/model"))
    for n in names:
        rows = rows.withColumns({f"{n}_uri": F.concat_ws("/", key, F.lit(n)), f"{n}_size": F.col("length"), f"{n}_sha": _sha(key, n)})
    size = {"input_audio": F.col("length") + F.when(_odd(37, 2), 1).otherwise(0)}
    uri = {"input_transcript": F.when(_odd(47, 5), "elsewhere").otherwise(F.col("input_transcript_uri"))}
    sha = {"artifact": F.when(~_odd(41, 3), F.col("artifact_sha"))}
    parts = {n: _obj(uri=uri.get(n, F.col(f"{n}_uri")), size_bytes=size.get(n, F.col("length")), sha256=sha.get(n, F.col(f"{n}_sha"))) for n in names}
    doc = _obj(schema_version=1, backend="openrouter", language="en", model=_obj(id=F.when(_odd(31, 1), "maker/other").otherwise(F.col("model")), config_version="persona-v1"), note=F.when(_odd(43, 4), "x"), **parts)
    return _judged(rows, F.to_json(doc), documents.persona_results)


#: Recordings' diarization documents: seconds with three digits; some with an odd segment, or no JSON at all.
_TOLD = f"""{o.TURNS}, q AS (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY start_ms, end_ms, speaker, turn_id) - 1 AS pos FROM turns),
  odd AS (SELECT part_id, '$' AS path, 'json' AS rule FROM turns WHERE part_id % 13 = 5 GROUP BY part_id
    UNION ALL SELECT part_id, '$.audio_duration_seconds', 'kind' FROM turns WHERE part_id % 13 <> 5 AND part_id % 11 = 4 GROUP BY part_id
    UNION ALL SELECT part_id, '$.segments[' || pos || '].note', 'unexpected' FROM q WHERE part_id % 13 <> 5 AND turn_id % 97 = 3
    UNION ALL SELECT part_id, '$.segments[' || pos || '].duration', 'milliseconds' FROM q WHERE part_id % 13 <> 5 AND turn_id % 89 = 5
    UNION ALL SELECT part_id, '$.segments[' || pos || '].speaker', 'missing' FROM q WHERE part_id % 13 <> 5 AND turn_id % 83 = 7)"""


def _scan(spark, d):
    seconds = lambda ms: (ms / F.lit(1000)).cast("decimal(18,3)")
    length = F.col("end_ms") - F.col("start_ms")
    odd = lambda n, k: F.col("turn_id") % n == k
    part = F.struct(
        F.when(~odd(83, 7), F.col("speaker")).alias("speaker"), seconds(F.col("start_ms")).alias("start"), seconds(F.col("end_ms")).alias("end"),
        (seconds(length).cast("decimal(18,4)") + F.when(odd(89, 5), F.lit(0.0005).cast("decimal(18,4)")).otherwise(0)).cast("decimal(18,4)").alias("duration"), F.when(odd(97, 3), "?").alias("note"),
    )
    turns = v.turns(spark, d)
    listed = turns.groupBy("part_id").agg(F.array_sort(F.collect_list(F.struct("start_ms", "end_ms", "speaker", "turn_id", part.alias("s")))).alias("t"), F.max("end_ms").alias("top"), F.sum(length).alias("ms"), F.count_distinct("speaker").alias("n"))
    spoken = turns.groupBy("part_id", "speaker").agg(F.sum(length).alias("own")).groupBy("part_id").agg(F.array_sort(F.collect_list(F.struct("speaker", "own"))).alias("k"))
    rows = listed.join(spoken, "part_id")
    told = F.transform("k", lambda k: F.struct(k["speaker"].alias("speaker"), F.round(k["own"].cast("decimal(18,3)") / 1000, 2).alias("total_seconds"), F.round(k["own"].cast("decimal(18,3)") * 100 / F.col("ms"), 1).alias("percentage")))
    doc = F.struct(F.lit(1).alias("schema_version"), F.lit("model").alias("model"), seconds(F.col("top")).alias("audio_duration_seconds"), F.col("n").alias("num_speakers"), seconds(F.col("ms")).alias("total_speech_seconds"), F.transform("t", lambda t: t["s"]).alias("segments"), told.alias("speaker_summary"))
    made = stored(rows.select("part_id", "top", F.to_json(doc).alias("made")), "made")
    text = F.regexp_replace("made", r'"audio_duration_seconds":([0-9.]+)', F.when(F.col("part_id") % 11 == 4, '"audio_duration_seconds":"$1"').otherwise('"audio_duration_seconds":$1'))
    text = F.when(F.col("part_id") % 13 == 5, F.regexp_replace(text, '"model":', '"model":"twice","model":')).otherwise(text)
    return documents.diarization_scan(made.select("part_id", text.alias("document")), PART), rows.select("part_id", F.col("top").alias("expected_ms"))


@against(f"WITH {_TOLD} SELECT part_id, path, rule FROM odd")
def diarization_rejects(spark, d):
    return _scan(spark, d)[0].rejects.select("part_id", "path", "rule")


@against(f"""WITH {_TOLD}, s AS (SELECT part_id, count(*) AS n_segments, sum(end_ms - start_ms)::BIGINT AS speech_ms, min(start_ms) AS first_ms, count(DISTINCT speaker) AS num_speakers, max(speaker) AS top FROM turns GROUP BY part_id)
  SELECT part_id, n_segments, speech_ms, first_ms, num_speakers, CASE WHEN top + 1 <> num_speakers THEN 'speaker_ids,summary_order' ELSE '' END AS violations FROM s WHERE part_id NOT IN (SELECT part_id FROM odd)""")
def scanned_diarizations(spark, d):
    """Documents that the strict scan lets pass, and what their validator says of them."""
    scan, expected = _scan(spark, d)
    documents_ = scan.documents.join(expected, PART)
    broken = validators.diarization_document(scan.segments, scan.summary, documents_, PART).groupBy("part_id").agg(F.array_join(F.array_sort(F.collect_set("rule")), ",").alias("violations"))
    per = scan.segments.groupBy("part_id").agg(F.count("*").alias("n_segments"), F.sum("duration_ms").alias("speech_ms"), F.min("start_ms").alias("first_ms"))
    rows = documents_.select("part_id", "num_speakers").join(per, PART).join(broken, PART, "left")
    return rows.select("part_id", "n_segments", "speech_ms", "first_ms", "num_speakers", F.coalesce("violations", F.lit("")).alias("violations"))


_MESSAGES = """m AS (SELECT event_id AS message_id, user_id, event_id % 9 AS k FROM events), j AS (
  SELECT *, ['split_raw_audio_into_parts', 'diarize_audio_part', 'quality_filter_audio_part', 'separate_chunk', 'transcribe_chunk', 'persona_chunk', 'reconstruct_chunk', 'extend_chunk', 'mix_chunk'][k + 1] AS task,
    CASE WHEN k = 8 THEN 'task' WHEN message_id % 17 = 3 THEN 'json' WHEN message_id % 19 = 4 THEN 'arguments' WHEN message_id % 23 = 5 THEN 'uuid' END AS reject,
    lpad(to_hex(user_id), 8, '0') || '-0000-4000-8000-000000000000' AS entity_id FROM m)"""


@against(f"""WITH {_MESSAGES} SELECT task, lower(entity_id) AS entity_id, CAST(NULL AS VARCHAR) AS reject, min(message_id) AS message_id, 1::BIGINT AS n FROM j WHERE reject IS NULL GROUP BY task, lower(entity_id)
  UNION ALL SELECT task, NULL, reject, message_id, CASE WHEN message_id % 3 = 0 THEN 2 ELSE 1 END::BIGINT FROM j WHERE reject IS NOT NULL""")
def message_delivery(spark, d):
    """Task messages, a third of them delivered twice: each entity's task is accepted once, rejects are kept with their reason."""
    k, i = F.col("event_id") % 9, F.col("event_id")
    task = F.get(F.array(*map(F.lit, [*messages.TASKS, "mix_chunk"])), k.cast("int"))
    uuid = F.concat(F.lower(F.lpad(F.hex("user_id"), 8, "0")), F.lit("-0000-4000-8000-000000000000"))
    said = F.concat(F.lit('{"'), F.coalesce(messages.argument_of(F.col("task")), F.lit("id")), F.lit('":"'), F.when(i % 23 == 5, F.upper(F.concat(F.lit("x"), uuid))).otherwise(uuid), F.lit('"'), F.when(i % 19 == 4, ',"more":1}').otherwise("}"))
    stream = control.source(spark, d).select("event_id", "user_id", task.alias("task"), F.explode(F.sequence(F.lit(1), F.when(i % 3 == 0, 2).otherwise(1))).alias("delivery"))
    stream = stream.select(F.col("event_id").alias("message_id"), "task", F.when(i % 17 == 3, F.concat(F.lit("["), said)).otherwise(said).alias("arguments"))
    log, folder = shared(spark, "messages-log"), shared(spark, "messages")
    messages.delivered(stream, ["task", "entity_id"], ["message_id"], log, folder)
    good, bad = messages.tables(spark, folder, stream.schema)
    kept = good.select("task", "entity_id", F.lit(None).cast("string").alias("reject"), "message_id")
    both = kept.unionByName(bad.select("task", F.lit(None).cast("string").alias("entity_id"), "reject", "message_id"))
    return both.groupBy("task", "entity_id", "reject", "message_id").agg(F.count("*").alias("n"))
