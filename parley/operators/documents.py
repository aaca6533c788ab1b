"""JSON documents against contracts, compared node by node.

A contract is a nested template: objects name all their keys, lists all their items, ``Each``
stands for a list of any length, and leaves are constants, ``Given`` columns of what was asked
for, or named ``Rule``s. Documents are parsed to VARIANT, which keeps decimals exact and
refuses repeated keys, NaN and trailing text. Each node of the contract is looked up in the
document's own row, items of lists of any length become rows first, and only what the contract
doesn't know is walked through level by level: each broken path gives one row, and no node of a
sound document is written or shuffled.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import stored
from .contracts import canonical


# What personas may say of tone, degree and emotion.
TONES = ("aggressive", "warm", "cold", "nervous", "calm", "playful")
LEVELS = ("low", "medium", "high")
EMOTIONS = ("angry", "sad", "happy", "surprised", "neutral")


@dataclass(frozen=True)
class Given:
    """Equal to this column of what was asked for; a text unless ``kind`` says INTEGER."""

    column: str
    kind: str = "TEXT"
    rule: str = ""


@dataclass(frozen=True)
class Rule:
    name: str


@dataclass(frozen=True)
class Each:
    item: object


def _decimal(x: Column) -> Column:
    return x.try_cast("decimal(38,9)")


def _exact(x: Column, unit: int) -> Column:
    """A whole number of parts of which ``unit`` make one, written in no more digits than are kept."""
    return (_decimal(x) * unit % 1 == 0) & ~x.rlike(r"\.\d{9}\d*[1-9]")


#: Kind and condition of each named rule; conditions read the value's text.
RULES: dict[str, tuple[str, object]] = {
    "positive": ("INTEGER", lambda x: x.try_cast("bigint") > 0),
    "natural": ("INTEGER", lambda x: x.try_cast("bigint") >= 0),
    "milliseconds": ("NUMBER", lambda x: _exact(x, 1000)),
    "number": ("NUMBER", lambda x: _decimal(x).isNotNull()),
    "share": ("NUMBER", lambda x: _decimal(x).between(0, 1)),
    "text": ("TEXT", canonical),
    "filled": ("TEXT", lambda x: F.trim(x) != ""),
    "sha256": ("TEXT", lambda x: x.rlike(r"\A[0-9a-f]{64}\z")),
    "revision": ("TEXT", lambda x: x.rlike(r"\A[0-9a-f]{40}\z")),
    "model": ("TEXT", lambda x: x.contains("/") & canonical(x)),
    "origin": ("TEXT", lambda x: x.isin("diarization_reference", "separated_track_slice")),
    "flag": ("BOOLEAN", lambda x: x.isNotNull()),
    "cost": ("NUMBER", lambda x: x.try_cast("double") >= 0),
    "note": ("TEXT or null", lambda x: x.isNull() | canonical(x)),
    "tone": ("TEXT", lambda x: x.isin(*TONES)),
    "level": ("TEXT", lambda x: x.isin(*LEVELS)),
    "emotion": ("TEXT", lambda x: x.isin(*EMOTIONS)),
    "second_emotion": ("TEXT or null", lambda x: x.isNull() | x.isin(*EMOTIONS)),
}


def _kind(value: object) -> str:
    return "BOOLEAN" if isinstance(value, bool) else "INTEGER" if isinstance(value, int) else "TEXT"


def _nodes(template: object, path: str = "$") -> list[tuple[str, str, str, str | Given | None]]:
    """(path, kind, rule, wanted value) of a template's nodes; under ``Each`` the path has [*]."""
    if isinstance(template, dict):
        out = [(path, "OBJECT", "", None)]
        for k, v in template.items():
            out += _nodes(v, f"{path}.{k}")
        return out
    if isinstance(template, list):
        return [(path, "ARRAY", "", str(len(template))), *(n for i, v in enumerate(template) for n in _nodes(v, f"{path}[{i}]"))]
    if isinstance(template, Each):
        return [(path, "ARRAY", "", None), *_nodes(template.item, f"{path}[*]")]
    if isinstance(template, Rule):
        return [(path, RULES[template.name][0], template.name, None)]
    if isinstance(template, Given):
        return [(path, template.kind, template.rule, template)]
    return [(path, _kind(template), "", str(template).lower() if isinstance(template, bool) else str(template))]


def parsed(docs: DataFrame, text: str = "document") -> DataFrame:
    """Adds ``v``: the strictly parsed VARIANT, null where the text is no such JSON.

    The parser stops after a first value, so the text is parsed as the one item of a list, and as
    a field: what follows its value can end one of them at most.
    """
    said = F.col(text).cast("string")
    listed, field = F.try_parse_json(F.concat(F.lit("["), said, F.lit("]"))), F.try_parse_json(F.concat(F.lit('{"d":'), said, F.lit("}")))
    alone = F.when(_list_size("listed") == 1, field.isNotNull())
    return docs.withColumn("listed", listed).withColumn("v", F.when(alone, F.try_variant_get("listed", "$[0]", "variant"))).drop("listed")


#: A broken path, or a node whose children are still to be listed: those not ``named``, or from place ``first`` on, ``left`` levels down.
_FOUND = "struct<path:string,rule:string,found:string,wanted:string,v:variant,named:array<string>,first:int,left:int>"


def _row(path: Column, rule: Column | str | None, found: Column | None = None, wanted: Column | None = None, v: Column | None = None, named: tuple[str, ...] = (), first: int = 0, left: Column | int = 0) -> Column:
    none = F.lit(None)
    text = lambda x: (none if x is None else x if isinstance(x, Column) else F.lit(x)).cast("string")
    names = F.array(*map(F.lit, named)).cast("array<string>")
    return F.struct(path.alias("path"), text(rule).alias("rule"), text(found).alias("found"), text(wanted).alias("wanted"), (none.cast("variant") if v is None else v).alias("v"), names.alias("named"), F.lit(first).alias("first"), (left if isinstance(left, Column) else F.lit(left)).cast("int").alias("left")).cast(_FOUND)


def _list_size(v: Column | str, path: str = "$") -> Column:
    return F.array_size(F.try_variant_get(v, path, "array<struct<>>"))


def _fields(v: Column | str, path: str = "$") -> Column:
    """An object's keys, null for anything else; the cast to structs without fields copies no content."""
    return F.map_keys(F.try_variant_get(v, path, "map<string,struct<>>"))


def _children(b: Column) -> Column:
    """The children of a node that the contract doesn't know, each a row; their own children follow while levels are left."""
    inner = lambda path, x: _row(path, "unexpected", F.coalesce(_list_size(x).cast("string"), F.when(_fields(x).isNull(), F.try_variant_get(x, "$", "string"))), v=F.when(b["left"] > 1, x), left=b["left"] - 1)
    step = lambda k: F.when(k.rlike("^[A-Za-z_][A-Za-z0-9_]*$"), F.concat(F.lit("."), k)).otherwise(F.concat(F.lit('["'), k, F.lit('"]')))
    fields = F.filter(F.map_entries(F.try_variant_get(b["v"], "$", "map<string,variant>")), lambda e: ~F.array_contains(b["named"], e["key"]))
    items = F.transform(F.try_variant_get(b["v"], "$", "array<variant>"), lambda x, i: F.when(i >= b["first"], inner(F.concat(b["path"], F.lit("["), i.cast("string"), F.lit("]")), x)))
    none = F.array().cast(f"array<{_FOUND}>")
    return F.concat(F.coalesce(F.transform(fields, lambda e: inner(F.concat(b["path"], step(e["key"])), e["value"])), none), F.coalesce(items, none))


def _fits(kind: str, schema: Column) -> Column:
    number = (schema == "BIGINT") | schema.startswith("DECIMAL") | schema.isin("DOUBLE", "FLOAT")
    return {"INTEGER": schema == "BIGINT", "NUMBER": number, "TEXT": schema == "STRING", "TEXT or null": schema.isin("STRING", "VOID")}.get(kind, schema == kind)


def _levels(path: str) -> int:
    return len(re.findall(r"\.|\[", path))


def _judged(n: int, base: Column, above: int, contract: list[tuple], depth: int) -> tuple[dict[str, Column], dict[str, Column], list[Column]]:
    """Columns of what stands at each node of ``v{n}``, of leaves' values, and rows of what is broken there or still to be listed."""
    v, seen, values, rows = f"v{n}", {}, {}, []
    for i, (path, kind, rule, wanted) in enumerate(contract):
        at, full = f"${path.removeprefix('$')}", F.concat(base, F.lit(path.removeprefix("$")))
        name = f"n{n}_{i}"
        schema = F.schema_of_variant(F.try_variant_get(v, at, "variant"))
        named = tuple(p[len(path) + 1 :] for p, *_ in contract if p.startswith(f"{path}.") and _levels(p) == _levels(path) + 1)
        left = depth - above - _levels(path)
        if kind in ("OBJECT", "ARRAY"):
            # keys that the contract doesn't name, or a list's length
            seen[name] = F.array_size(F.filter(_fields(v, at), lambda k: ~k.isin(*named))) if kind == "OBJECT" else _list_size(v, at)
            length = int(wanted) if wanted is not None else None
            found, want = F.col(name), F.lit(wanted)
            other = F.col(name).isNull()
            broken = F.when(other, F.when(schema.isNull(), "missing").otherwise("kind"))
            if length is not None:
                broken = broken.when(found != length, "value")
            found = F.coalesce(found.cast("string") if kind == "ARRAY" else F.lit(None), F.when(other, _value(v, at, schema)))
            open_ = F.when(other, schema.startswith("OBJECT") | schema.startswith("ARRAY"))
            open_ = open_.otherwise(F.col(name) > 0 if kind == "OBJECT" else F.lit(False) if length is None else F.col(name) > length)
            first = 0 if kind == "OBJECT" else length or 0
        else:
            given = isinstance(wanted, Given)
            seen[name] = schema
            # other casts of a VARIANT than to its own type are slow
            values[f"{name}_value"] = F.when(F.col(name) == "BIGINT", F.try_variant_get(v, at, "bigint").cast("string")).otherwise(F.try_variant_get(v, at, "string"))
            what, value = F.col(name), F.col(f"{name}_value")
            want = F.col(wanted.column).cast("string") if given else F.lit(wanted).cast("string")
            broken = F.when(what.isNull(), "missing").when(~_fits(kind, what), "kind")
            if wanted is not None:
                broken = broken.when(~F.coalesce(value == want, F.lit(False)), "value")
            if rule:
                broken = broken.when(~F.coalesce(RULES[rule][1](value), F.lit(False)), rule)
            found = F.when(what.startswith("ARRAY"), _list_size(v, at).cast("string")).when(~what.startswith("OBJECT"), value)
            open_, first = what.startswith("OBJECT") | what.startswith("ARRAY"), 0
        rows.append(F.when(broken.isNotNull(), _row(full, broken, found, want)))
        if left > 0:
            rows.append(F.when(open_, _row(full, None, v=F.try_variant_get(v, at, "variant"), named=named, first=first, left=left)))
    return seen, values, rows


def _value(v: str, at: str, schema: Column) -> Column:
    return F.coalesce(_list_size(v, at).cast("string"), F.when(~schema.startswith("OBJECT"), F.try_variant_get(v, at, "string")))


def broken_paths(docs: DataFrame, asked: DataFrame | None, keys: list[str], template: object, text: str = "document", rules: dict[str, tuple[str, Column]] | None = None, read: tuple[str, ...] = ()) -> DataFrame:
    """keys, path, rule, found and wanted: a row for each path of a document that breaks its contract.

    Rules are ``json`` (no such JSON, or null), ``missing``, ``unexpected``, ``kind``, ``value``, or the
    rule's name. ``asked`` has the columns of the template's ``Given`` leaves, a row for each
    document; documents that nothing was asked for are judged with nulls, which break those leaves.
    Where ``asked`` is ``docs`` itself, each row holds both and nothing is joined. Keys are not null.

    ``rules`` look at several places of one document, as ``v``, and at the columns ``read`` of what was
    asked: broken ones by the path that they are about. A rule that meets a missing or wrong kind of
    value is not judged here: that path is broken already.
    """
    contract = _nodes(template)
    depth = max(_levels(n[0]) for n in contract)
    given = sorted({n[3].column for n in contract if isinstance(n[3], Given)} | set(read))
    held = docs.select(*keys, F.col(text).cast("string").alias("said"), *(given if asked is docs else ()))
    if given and asked is not docs:
        held = held.join(asked.select(*keys, *given), keys, "left")
    held = parsed(held, "said")
    parts: dict[tuple, list[str]] = {}
    for anchor in sorted({n[0].split("[*]")[0] for n in contract if "[*]" in n[0]}):
        under = tuple((n[0].removeprefix(f"{anchor}[*]"), *n[1:]) for n in contract if n[0].startswith(f"{anchor}[*]"))
        parts.setdefault((under, _levels(anchor) + 1), []).append(anchor)
    kind = "array<struct<part:int,base:string,v:variant>>"

    def items(n: int, anchor: str) -> Column:
        listed = F.transform(_get(anchor, "array<variant>"), lambda x, i: F.struct(F.lit(n), F.concat(F.lit(f"{anchor}["), i.cast("string"), F.lit("]")), x))
        return F.coalesce(listed.cast(kind), F.array().cast(kind))

    if parts:
        each = [F.array(F.struct(F.lit(0), F.lit("$"), F.col("v"))).cast(kind), *(items(n, anchor) for n, anchors in enumerate(parts.values(), 1) for anchor in anchors)]
        held = held.withColumn("e", F.concat(*each)).select(*keys, *given, F.explode_outer("e").alias("e")).select(*keys, *given, "e.*")
    else:
        held = held.select(*keys, *given, F.lit(0).alias("part"), F.lit("$").alias("base"), "v")
    fixed = tuple(n for n in contract if "[*]" not in n[0])
    seen, values, broken = {}, {}, F.when(F.col("v").isNull(), F.array(_row(F.lit("$"), "json")))
    for n, (nodes, above) in enumerate([(fixed, 0), *parts]):
        held = held.withColumn(f"v{n}", F.when(F.col("part") == n, F.col("v")))
        there, said, rows = _judged(n, F.col("base"), above, nodes, depth)
        seen |= there
        values |= said
        if not n:
            rows += [F.when(~ok, _row(F.lit(path), re.sub(r"_\d$", "", name))) for name, (path, ok) in (rules or {}).items()]
        broken = broken.when(F.col("part") == n, F.array(*rows))
    rows = held.withColumns(seen).withColumns(values).select(*keys, broken.alias("b")).select(*keys, F.explode_outer("b").alias("b")).where("b is not null")
    b = F.col("b")
    more = F.concat(F.array(F.when(b["rule"].isNotNull(), _row(b["path"], b["rule"], b["found"], b["wanted"]))), _children(b))
    for _ in range(depth):
        rows = rows.select(*keys, F.when(b["v"].isNull(), F.array(b)).otherwise(more).alias("b")).select(*keys, F.explode_outer("b").alias("b")).where("b is not null")
    return rows.select(*keys, "b.path", "b.rule", "b.found", "b.wanted")


# The documents' versions, models and back ends.
_STORED = {"size_bytes": Rule("positive"), "sha256": Rule("sha256")}
_SEGMENT = {"start_ms": Rule("natural"), "end_ms": Rule("positive"), "duration_ms": Rule("positive")}

DIARIZATION = {
    "schema_version": 1,
    "model": Rule("filled"),
    "audio_duration_seconds": Rule("milliseconds"),
    "num_speakers": Rule("natural"),
    "total_speech_seconds": Rule("milliseconds"),
    "segments": Each({"speaker": Rule("natural"), "start": Rule("milliseconds"), "end": Rule("milliseconds"), "duration": Rule("milliseconds")}),
    "speaker_summary": Each({"speaker": Rule("natural"), "total_seconds": Rule("number"), "percentage": Rule("number")}),
}

TRANSCRIPTION = {
    "schema_version": 1,
    "backend": "parakeet_tdt",
    "language": "en",
    "model": {"repo_id": "nvidia/parakeet-tdt-0.6b-v3", "config_version": "parakeet-v1", "revision": Rule("revision")},
    "input_speaker_audio": [
        {"output_slot": k, "diarization_speaker_id": Given(f"speaker_{k}", "INTEGER"), "uri": Given(f"input_uri_{k}"), "size_bytes": Given(f"input_size_{k}", "INTEGER", "positive"), "sha256": Given(f"input_sha_{k}", rule="sha256")}
        for k in (0, 1)
    ],
    "artifacts": {n: {"uri": Given(f"{n}_uri"), "size_bytes": Given(f"{n}_size", "INTEGER", "positive"), "sha256": Given(f"{n}_sha", rule="sha256")} for n in ("transcript", "word_alignment")},
}


def _speaker_audio(slot: int) -> dict:
    return {"speaker_id": slot, "diarization_speaker_id": Given(f"speaker_{slot}", "INTEGER"), "uri": Given(f"audio_uri_{slot}"), "sample_rate_hz": 44_100, "duration_ms": Rule("positive")} | _STORED


RECONSTRUCTION = {
    "schema_version": 1,
    "config_version": "source-reconstruction-v1",
    "backend": "openrouter",
    "models": {"audio_tags": Rule("model"), "tts": "fish-audio/s2.1-pro"},
    "language": "en",
    "source_duration_ms": Given("duration_ms", "INTEGER"),
    "actual_duration_ms": Rule("positive"),
    "utterance_count": Rule("positive"),
    "speaker_mapping": [{"speaker_id": k, "diarization_speaker_id": Given(f"speaker_{k}", "INTEGER")} for k in (0, 1)],
    "artifacts": {"manifest": {"uri": Given("manifest_uri")} | _STORED, "transcript": {"uri": Given("transcript_uri")} | _STORED, "speaker_audio": [_speaker_audio(0), _speaker_audio(1)]},
}


def _model(name: object) -> dict:
    return {"backend": "openrouter", "id": name, "config_version": "dialogue-extension-v1"}


EXTENSION = {
    "schema_version": 1,
    "backend": "openrouter",
    "models": {"dialogue": _model(Rule("model")), "reference_asr": _model("fish-audio/transcribe-1"), "tts": _model("fish-audio/s2.1-pro")},
    "language": "en",
    "target_duration_ms": Rule("positive"),
    "actual_duration_ms": Rule("positive"),
    "inputs": {
        **{n: {"uri": Given(f"{n}_uri"), "size_bytes": Given(f"{n}_size", "INTEGER", "positive"), "sha256": Given(f"{n}_sha", rule="sha256")} for n in ("transcript", "persona")},
        "speaker_reference_manifest": {"uri": Given("manifest_uri")} | _STORED,
        "speaker_references": [
            {
                "speaker_id": k,
                "diarization_speaker_id": Given(f"speaker_{k}", "INTEGER"),
                "source": Rule("origin"),
                "source_audio": {"uri": Rule("filled")} | _STORED,
                "selection": {"timebase": Rule("filled"), "segments": Each(_SEGMENT)},
                "reference_audio": {"sample_rate_hz": 16_000, "duration_ms": Rule("positive")} | _STORED,
                "reference_text_sha256": Rule("sha256"),
            }
            for k in (0, 1)
        ],
    },
    "artifacts": {"script": {"uri": Given("script_uri")} | _STORED, "transcript": {"uri": Given("output_transcript_uri")} | _STORED, "speaker_audio": [_speaker_audio(0), _speaker_audio(1)]},
}

def _persona_speaker(slot: int) -> dict:
    notes = {n: Rule("note") for n in ("name", "age", "ethnicity", "gender", "evidence")}
    flags = {n: Rule("flag") for n in ("laugh", "cry", "whisper", "shout", "sigh")}
    said = {"tag": Rule("text"), "alpha": Rule("level"), "primary_emotion": Rule("emotion"), "secondary_emotion": Rule("second_emotion"), "emotion_intensity": Rule("level"), "overall_tone": Rule("tone")}
    return {"speaker_id": Given(f"low_id_{slot}")} | notes | flags | said


PERSONA = {
    "schema_version": 1,
    "backend": "openrouter",
    "config_version": "persona-v1",
    "language": "en",
    "scene": {"description": Rule("text"), "overall_tone": Rule("tone"), "emotion_intensity": Rule("level")},
    "speakers": [_persona_speaker(0), _persona_speaker(1)],
    "usage": {"model": Given("model"), "in_tokens": Rule("natural"), "out_tokens": Rule("natural"), "total_tokens": Rule("natural"), "cost_usd": Rule("cost")},
    "speaker_mapping": [{"output_slot": k, "diarization_speaker_id": Given(f"speaker_{k}", "INTEGER")} for k in (0, 1)],
}

PERSONA_RESULT = {
    "schema_version": 1,
    "backend": "openrouter",
    "language": "en",
    "model": {"id": Given("model", rule="model"), "config_version": "persona-v1"},
    **{n: {"uri": Given(f"{n}_uri"), "size_bytes": Given(f"{n}_size", "INTEGER", "positive"), "sha256": Given(f"{n}_sha", rule="sha256")} for n in ("input_audio", "input_transcript", "artifact")},
}
#: Half a second of silence joins the segments of a reference.
JOINT_MS = 500


def _get(path: str, kind: str = "bigint") -> Column:
    return F.try_variant_get("v", path, kind)


def transcription_results(docs: DataFrame, asked: DataFrame, keys: list[str], text: str = "document") -> DataFrame:
    """Broken paths of transcription results.

    ``asked``: of each track k speaker_k, input_uri_k, input_size_k and input_sha_k; of transcript and
    word_alignment their _uri, _size and _sha.
    """
    return broken_paths(docs, asked, keys, TRANSCRIPTION, text)


def reconstruction_results(docs: DataFrame, asked: DataFrame, keys: list[str], text: str = "document") -> DataFrame:
    """Broken paths of reconstruction results; both tracks are as long as the document says.

    ``asked``: duration_ms, speaker_k, manifest_uri, transcript_uri and audio_uri_k.
    """
    rules = {f"track_length_{k}": (f"$.artifacts.speaker_audio[{k}].duration_ms", _get(f"$.artifacts.speaker_audio[{k}].duration_ms") == _get("$.actual_duration_ms")) for k in (0, 1)}
    return broken_paths(docs, asked, keys, RECONSTRUCTION, text, rules)


def extension_results(docs: DataFrame, asked: DataFrame, keys: list[str], text: str = "document") -> DataFrame:
    """Broken paths of extension results, and broken provenance of their speakers' references.

    ``asked``: transcript_uri/_size/_sha, persona_uri/_size/_sha, manifest_uri, script_uri,
    output_transcript_uri; of each speaker k speaker_k, audio_uri_k, reference_uri_k, the separated
    track's separated_uri_k, separated_size_k and separated_sha_k, and pure_start_k and pure_end_k.
    A reference is joined from segments of the recording, or it is the longest pure stretch of the
    separated track.
    """
    rules: dict[str, tuple[str, Column]] = {}
    for k in (0, 1):
        at = f"$.inputs.speaker_references[{k}]"
        segments = _get(f"{at}.selection.segments", "array<struct<start_ms:bigint,end_ms:bigint,duration_ms:bigint>>")
        total = F.aggregate(segments, F.lit(0).cast("long"), lambda a, s: a + s["duration_ms"])
        source, base, length = _get(f"{at}.source", "string"), _get(f"{at}.selection.timebase", "string"), _get(f"{at}.reference_audio.duration_ms")
        origin = F.struct(*(_get(f"{at}.source_audio.{n}", t) for n, t in (("uri", "string"), ("size_bytes", "bigint"), ("sha256", "string"))))
        own = F.struct(F.col(f"reference_uri_{k}"), _get(f"{at}.reference_audio.size_bytes"), _get(f"{at}.reference_audio.sha256", "string"))
        separated = F.struct(F.col(f"separated_uri_{k}"), F.col(f"separated_size_{k}").cast("bigint"), F.col(f"separated_sha_{k}"))
        start, end = F.col(f"pure_start_{k}").cast("bigint"), F.col(f"pure_end_{k}").cast("bigint")
        joined = source == "diarization_reference"
        rules |= {
            f"segments_{k}": (f"{at}.selection.segments", (F.size(segments) > 0) & F.forall(segments, lambda s: (s["end_ms"] > s["start_ms"]) & (s["duration_ms"] == s["end_ms"] - s["start_ms"]))),
            f"timebase_{k}": (f"{at}.selection.timebase", base == F.when(joined, "audio_part").otherwise("chunk")),
            f"source_{k}": (f"{at}.source_audio", F.when(joined, origin == own).otherwise(origin == separated)),
            f"length_{k}": (f"{at}.reference_audio.duration_ms", length == F.when(joined, total + JOINT_MS * (F.size(segments) - 1)).otherwise(end - start)),
            f"pure_{k}": (f"{at}.selection.segments[0]", joined | (F.size(segments) == 1) & (F.get(segments, 0)["start_ms"] == start) & (F.get(segments, 0)["end_ms"] == end)),
            f"track_length_{k}": (f"$.artifacts.speaker_audio[{k}].duration_ms", _get(f"$.artifacts.speaker_audio[{k}].duration_ms") == _get("$.actual_duration_ms")),
        }
    read = tuple(f"{n}_{k}" for n in ("reference_uri", "separated_uri", "separated_size", "separated_sha", "pure_start", "pure_end") for k in (0, 1))
    return broken_paths(docs, asked, keys, EXTENSION, text, rules, read)


def persona_documents(docs: DataFrame, asked: DataFrame, keys: list[str], text: str = "document") -> DataFrame:
    """Broken paths of persona documents.

    ``asked``: model, and of each track k speaker_k. Speakers come in the order of their ids'
    texts, and a total of tokens is the sum of both kinds, or 0.
    """
    ids = F.array_sort(F.array(F.col("speaker_0").cast("string"), F.col("speaker_1").cast("string")))
    low = asked.withColumns({"low_id_0": ids[0], "low_id_1": ids[1]})
    rules = {"total": ("$.usage.total_tokens", _get("$.usage.total_tokens").isin(F.lit(0), _get("$.usage.in_tokens") + _get("$.usage.out_tokens")))}
    return broken_paths(low if docs is asked else docs, low, keys, PERSONA, text, rules)


def persona_results(docs: DataFrame, asked: DataFrame, keys: list[str], text: str = "document") -> DataFrame:
    """Broken paths of persona results; ``asked``: model, and _uri, _size and _sha of input_audio, input_transcript and artifact."""
    return broken_paths(docs, asked, keys, PERSONA_RESULT, text)


@dataclass(frozen=True)
class Scanned:
    """Documents that keep their contract as tables, and the broken paths of the others."""

    documents: DataFrame
    segments: DataFrame
    summary: DataFrame
    rejects: DataFrame


def diarization_scan(docs: DataFrame, keys: list[str], text: str = "document") -> Scanned:
    """Diarization documents read strictly: closed key sets at every level and decimals to the millisecond.

    ``documents``: model, duration_ms, num_speakers, total_ms. ``segments``: position, speaker,
    start_ms, end_ms, duration_ms. ``summary``: position, speaker, total_seconds, percentage.
    They are what ``validators.diarization_document`` judges.
    """
    rejects = stored(broken_paths(docs, None, keys, DIARIZATION, text), "rejects")
    good = stored(parsed(docs.select(*keys, text), text).where("v is not null").join(rejects.select(*keys).distinct(), keys, "left_anti"), "kept")
    ms = lambda c: (c.cast("decimal(29,9)") * 1000).cast("bigint")
    documents = good.select(*keys, _get("$.model", "string").alias("model"), ms(_get("$.audio_duration_seconds", "decimal(38,9)")).alias("duration_ms"), _get("$.num_speakers").alias("num_speakers"), ms(_get("$.total_speech_seconds", "decimal(38,9)")).alias("total_ms"))
    parts = good.select(*keys, F.posexplode(_get("$.segments", "array<struct<speaker:bigint,start:decimal(38,9),end:decimal(38,9),duration:decimal(38,9)>>")).alias("position", "s"))
    segments = parts.select(*keys, "position", "s.speaker", ms(F.col("s.start")).alias("start_ms"), ms(F.col("s.end")).alias("end_ms"), ms(F.col("s.duration")).alias("duration_ms"))
    said = good.select(*keys, F.posexplode(_get("$.speaker_summary", "array<struct<speaker:bigint,total_seconds:decimal(38,9),percentage:decimal(38,9)>>")).alias("position", "s"))
    return Scanned(documents, segments, said.select(*keys, "position", "s.*"), rejects)
