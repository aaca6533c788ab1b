"""Documents that keep their contract give no row; each mutation breaks its own path."""

import copy
import json

import pytest

from parley.operators import documents as D
from parley.operators import validators

SHA = ["%064x" % k for k in range(20)]


def _transcription():
    doc = {
        "schema_version": 1, "backend": "parakeet_tdt", "language": "en",
        "model": {"repo_id": "nvidia/parakeet-tdt-0.6b-v3", "config_version": "parakeet-v1", "revision": "0" * 40},
        "input_speaker_audio": [{"output_slot": k, "diarization_speaker_id": 1 - k, "uri": f"u{k}", "size_bytes": 10 + k, "sha256": SHA[k]} for k in (0, 1)],
        "artifacts": {n: {"uri": n, "size_bytes": 5, "sha256": SHA[5]} for n in ("transcript", "word_alignment")},
    }
    asked = {"speaker_0": 1, "speaker_1": 0, "input_uri_0": "u0", "input_uri_1": "u1", "input_size_0": 10, "input_size_1": 11, "input_sha_0": SHA[0], "input_sha_1": SHA[1]}
    asked |= {f"{n}_{k}": v for n in ("transcript", "word_alignment") for k, v in (("uri", n), ("size", 5), ("sha", SHA[5]))}
    return doc, asked


def _tracks():
    return [{"speaker_id": k, "diarization_speaker_id": 1 - k, "uri": f"a{k}", "sample_rate_hz": 44_100, "duration_ms": 900, "size_bytes": 7, "sha256": SHA[k]} for k in (0, 1)]


def _reconstruction():
    doc = {
        "schema_version": 1, "config_version": "source-reconstruction-v1", "backend": "openrouter", "models": {"audio_tags": "a/b", "tts": "fish-audio/s2.1-pro"}, "language": "en",
        "source_duration_ms": 1000, "actual_duration_ms": 900, "utterance_count": 3, "speaker_mapping": [{"speaker_id": k, "diarization_speaker_id": 1 - k} for k in (0, 1)],
        "artifacts": {"manifest": {"uri": "m", "size_bytes": 3, "sha256": SHA[3]}, "transcript": {"uri": "t", "size_bytes": 4, "sha256": SHA[4]}, "speaker_audio": _tracks()},
    }
    return doc, {"duration_ms": 1000, "speaker_0": 1, "speaker_1": 0, "manifest_uri": "m", "transcript_uri": "t", "audio_uri_0": "a0", "audio_uri_1": "a1"}


def _extension():
    model = lambda name: {"backend": "openrouter", "id": name, "config_version": "dialogue-extension-v1"}
    stored = lambda uri, k: {"uri": uri, "size_bytes": 3 + k, "sha256": SHA[k]}
    joined = {"timebase": "audio_part", "segments": [{"start_ms": 0, "end_ms": 400, "duration_ms": 400}, {"start_ms": 600, "end_ms": 900, "duration_ms": 300}]}
    pure = {"timebase": "chunk", "segments": [{"start_ms": 50, "end_ms": 450, "duration_ms": 400}]}
    references = [
        {"speaker_id": 0, "diarization_speaker_id": 1, "source": "diarization_reference", "source_audio": stored("r0", 6), "selection": joined, "reference_audio": {"sample_rate_hz": 16_000, "duration_ms": 1200, "size_bytes": 9, "sha256": SHA[6]}, "reference_text_sha256": SHA[9]},
        {"speaker_id": 1, "diarization_speaker_id": 0, "source": "separated_track_slice", "source_audio": stored("s1", 7), "selection": pure, "reference_audio": {"sample_rate_hz": 16_000, "duration_ms": 400, "size_bytes": 9, "sha256": SHA[8]}, "reference_text_sha256": SHA[9]},
    ]
    doc = {
        "schema_version": 1, "backend": "openrouter", "models": {"dialogue": model("x/y"), "reference_asr": model("fish-audio/transcribe-1"), "tts": model("fish-audio/s2.1-pro")}, "language": "en",
        "target_duration_ms": 1000, "actual_duration_ms": 900,
        "inputs": {"transcript": stored("t", 1), "persona": stored("p", 2), "speaker_reference_manifest": stored("m", 3), "speaker_references": references},
        "artifacts": {"script": stored("sc", 4), "transcript": stored("ot", 5), "speaker_audio": _tracks()},
    }
    asked = {"transcript_uri": "t", "transcript_size": 4, "transcript_sha": SHA[1], "persona_uri": "p", "persona_size": 5, "persona_sha": SHA[2], "manifest_uri": "m", "script_uri": "sc", "output_transcript_uri": "ot"}
    for k in (0, 1):
        asked |= {f"speaker_{k}": 1 - k, f"audio_uri_{k}": f"a{k}", f"reference_uri_{k}": f"r{k}", f"separated_uri_{k}": f"s{k}", f"separated_size_{k}": 10, f"separated_sha_{k}": SHA[7], f"pure_start_{k}": 50, f"pure_end_{k}": 450}
    return doc, asked


def _persona():
    who = lambda k: {"speaker_id": str(3 + 7 * k), "name": None, "age": "old", "ethnicity": None, "gender": None, "evidence": None, "tag": "t", "alpha": "low", "primary_emotion": "sad", "secondary_emotion": None, "emotion_intensity": "high", "laugh": True, "cry": False, "whisper": False, "shout": False, "sigh": True, "overall_tone": "warm"}
    doc = {
        "schema_version": 1, "backend": "openrouter", "config_version": "persona-v1", "language": "en", "scene": {"description": "d", "overall_tone": "calm", "emotion_intensity": "low"},
        "speakers": [{**who(1), "speaker_id": "10"}, {**who(0), "speaker_id": "3"}], "usage": {"model": "a/b", "in_tokens": 3, "out_tokens": 4, "total_tokens": 7, "cost_usd": 0.5},
        "speaker_mapping": [{"output_slot": 0, "diarization_speaker_id": 3}, {"output_slot": 1, "diarization_speaker_id": 10}],
    }
    return doc, {"model": "a/b", "speaker_0": 3, "speaker_1": 10}


def _persona_result():
    names = ("input_audio", "input_transcript", "artifact")
    doc = {"schema_version": 1, "backend": "openrouter", "language": "en", "model": {"id": "a/b", "config_version": "persona-v1"}} | {n: {"uri": n, "size_bytes": 5, "sha256": SHA[2]} for n in names}
    return doc, {"model": "a/b"} | {f"{n}_{k}": x for n in names for k, x in (("uri", n), ("size", 5), ("sha", SHA[2]))}


def _mutations(doc):
    """(path, changed document): every leaf of another kind or value, every object with a key less or more."""
    out = []

    def at(root, steps):
        for s in steps:
            root = root[s]
        return root

    def walk(node, path, steps):
        if isinstance(node, dict):
            more = copy.deepcopy(doc)
            at(more, steps)["surplus"] = 1
            out.append((f"{path}.surplus", more))
            for k, v in node.items():
                less = copy.deepcopy(doc)
                del at(less, steps)[k]
                out.append((f"{path}.{k}", less))
                walk(v, f"{path}.{k}", [*steps, k])
        elif isinstance(node, list):
            for i, v in enumerate(node):
                walk(v, f"{path}[{i}]", [*steps, i])
        else:
            odd = (None, 1, "x") if isinstance(node, bool) else (None, True, -1, {"x": 1}, "?") if isinstance(node, (int, float)) else (3, "", " x") if node is None or path.endswith(".age") else (None, 3, "", [node])
            for value in odd:
                changed = copy.deepcopy(doc)
                at(changed, steps[:-1])[steps[-1]] = value
                out.append((path, changed))

    walk(doc, "$", [])
    return out


@pytest.mark.parametrize(("made", "check"), [(_transcription, D.transcription_results), (_reconstruction, D.reconstruction_results), (_extension, D.extension_results), (_persona, D.persona_documents), (_persona_result, D.persona_results)])
def test_every_mutation_breaks_its_path(spark, made, check):
    doc, asked = made()
    cases = [("", doc), *_mutations(doc)]
    docs = spark.createDataFrame([(n, json.dumps(d)) for n, (_, d) in enumerate(cases)] + [(-1, '{"schema_version": 1, "schema_version": 1}'), (-2, None), (-3, "{")], "id long, document string").repartition(4)
    what = spark.createDataFrame([(n, *asked.values()) for n in range(-3, len(cases))], "id long, " + ", ".join(f"{k} {'string' if isinstance(v, str) else 'long'}" for k, v in asked.items()))
    got = {}
    for r in check(docs, what, ["id"]).collect():
        got.setdefault(r["id"], []).append((r["path"], r["rule"]))
    assert 0 not in got
    assert [got[k] for k in (-1, -2, -3)] == [[("$", "json")]] * 3
    for n, (path, _) in enumerate(cases):
        assert not n or path in {p for p, _ in got[n]}, (path, got.get(n))


def test_provenance_of_references(spark):
    doc, asked = _extension()
    other = copy.deepcopy(doc)
    other["inputs"]["speaker_references"][0]["reference_audio"]["duration_ms"] = 700
    other["inputs"]["speaker_references"][1]["selection"]["segments"][0] |= {"start_ms": 60, "duration_ms": 390}
    docs = spark.createDataFrame([(0, json.dumps(other))], "id long, document string")
    what = spark.createDataFrame([(0, *asked.values())], "id long, " + ", ".join(f"{k} {'string' if isinstance(v, str) else 'long'}" for k, v in asked.items()))
    got = sorted((r["path"], r["rule"]) for r in D.extension_results(docs, what, ["id"]).collect())
    at = "$.inputs.speaker_references"
    assert got == [(f"{at}[0].reference_audio.duration_ms", "length"), (f"{at}[1].selection.segments[0]", "pure")]


def _diarization():
    return {
        "schema_version": 1, "model": "m", "audio_duration_seconds": 12.5, "num_speakers": 2, "total_speech_seconds": 3.001,
        "segments": [{"speaker": 0, "start": 0.5, "end": 1.501, "duration": 1.001}, {"speaker": 1, "start": 2, "end": 4.0, "duration": 2.000}],
        "speaker_summary": [{"speaker": 0, "total_seconds": 1.0, "percentage": 33.4}, {"speaker": 1, "total_seconds": 2.0, "percentage": 66.6}],
    }


def test_strict_scan_feeds_the_validator_and_rejects_the_rest(spark):
    good = json.dumps(_diarization())
    texts = {
        "good": good,
        "empty": json.dumps(_diarization() | {"segments": [], "speaker_summary": [], "num_speakers": 0, "total_speech_seconds": 0}),
        "nan": good.replace("12.5", "NaN"),
        "twice": good.replace('"model": "m"', '"model": "m", "model": "m"'),
        "fine": good.replace("3.001", "3.0015"),
        "text": good.replace("3.001", '"3.001"'),
        "tail": good + "x",
        "second": good + "," + good,
        "closing": good + "],[1",
        "field": good + "}{",
        "surplus": good.replace('"speaker": 1, "start"', '"note": 1, "speaker": 1, "start"'),
        "less": good.replace('"percentage": 33.4', '"percent": 33.4'),
        "flag": good.replace('"num_speakers": 2', '"num_speakers": true'),
        "list": "[1]",
        "blank": good.replace('"m"', '"  "'),
        "long": good.replace("12.5", "12.50000000000000000000000000"),
        "longer": good.replace("12.5", "12.5000000000000000000000000001"),
    }
    scan = D.diarization_scan(spark.createDataFrame(list(texts.items()), "name string, document string"), ["name"])
    got = {}
    for r in scan.rejects.collect():
        got.setdefault(r["name"], set()).add((r["path"], r["rule"]))
    assert {r["name"] for r in scan.documents.collect()} == {"good", "empty", "long"}
    assert got["fine"] == {("$.total_speech_seconds", "milliseconds")} and got["text"] == {("$.total_speech_seconds", "kind")}
    assert got["surplus"] == {("$.segments[1].note", "unexpected")}
    assert got["less"] == {("$.speaker_summary[0].percent", "unexpected"), ("$.speaker_summary[0].percentage", "missing")}
    assert got["flag"] == {("$.num_speakers", "kind")} and got["blank"] == {("$.model", "filled")}
    assert all(got[k] == {("$", "json")} for k in ("nan", "twice", "tail", "second", "closing", "field")) and ("$", "kind") in got["list"] and ("$.audio_duration_seconds", "milliseconds") in got["longer"]
    assert sorted((r["start_ms"], r["end_ms"], r["duration_ms"]) for r in scan.segments.where("name = 'good'").collect()) == [(500, 1501, 1001), (2000, 4000, 2000)]
    asked = scan.documents.selectExpr("*", "12500 as expected_ms")
    assert validators.diarization_document(scan.segments, scan.summary, asked, ["name"]).collect() == []
