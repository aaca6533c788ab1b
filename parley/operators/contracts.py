"""Document contracts: builders of canonical JSON and validators that list broken rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timebase import frames_to_ms

# Audio tags, kinds of utterances and their placements.
TAGS = (
    "[angry]",
    "[chuckles]",
    "[clears throat]",
    "[coughs]",
    "[crying]",
    "[curious]",
    "[excited]",
    "[exhales]",
    "[inhales deeply]",
    "[laughs]",
    "[sad]",
    "[shouts]",
    "[sighs]",
    "[surprised]",
    "[thoughtful]",
    "[whispers]",
)
TYPES = ("dialogue", "backchannel", "paralinguistic")
PLACEMENTS = ("sequential", "overlap_previous")


def canonical_json(columns: dict[str, Column]) -> Column:
    """Compact JSON with sorted keys and nulls kept. Text, integers, booleans and their arrays only."""
    return F.to_json(F.struct(*(columns[k].alias(k) for k in sorted(columns))), {"ignoreNullFields": "false"})


def has_exact_keys(json: Column, keys: list[str]) -> Column:
    """The object has these keys and no other."""
    found = F.json_object_keys(json)
    want = F.array(*map(F.lit, sorted(keys)))
    return F.coalesce((F.size(F.array_except(found, want)) == 0) & (F.size(F.array_except(want, found)) == 0), F.lit(False))


def typed(json: Column, path: str, kind: str) -> Column:
    """The value at ``path`` is of a JSON kind: BIGINT, STRING, BOOLEAN, OBJECT, ARRAY."""
    return F.coalesce(F.schema_of_variant(F.try_variant_get(F.try_parse_json(json), path, "variant")).startswith(kind), F.lit(False))


def identity(content: Column) -> Column:
    return F.struct(F.length(content).cast("long").alias("size_bytes"), F.sha2(content, 256).alias("sha256"))


def good_tags(tags: Column) -> Column:
    """At most three tags, each once, all of them known."""
    return (F.size(tags) <= 3) & (F.size(F.array_distinct(tags)) == F.size(tags)) & (F.size(F.array_except(tags, F.lit(list(TAGS)))) == 0)


def canonical(text: Column) -> Column:
    """Neither empty nor with white space at an end."""
    return (text != "") & ~text.rlike(r"^\s|\s$")


def script_rules(script: DataFrame, keys: list[str], least: int = 2, most: int = 200) -> DataFrame:
    """Scripts of two speakers (idx, speaker, type, placement, text, tags) with the rules they break.

    Sounds need a tag and everything else needs words; only what is no ordinary dialogue may overlap.
    """
    w = Window.partitionBy(*keys).orderBy("idx")
    overlaps, sound = F.col("placement") == "overlap_previous", F.col("type") == "paralinguistic"
    rows = script.select("*", F.lag("speaker").over(w).alias("before"))
    broken = {
        "kind": ~(F.col("type").isin(*TYPES) & F.col("placement").isin(*PLACEMENTS)),
        "brackets": F.col("text").rlike(r"[\[\]]"),
        "tags": ~good_tags(F.col("tags")),
        "words": F.when(sound, F.size("tags") == 0).otherwise(F.col("text") == ""),
        "dialogue_overlap": overlaps & (F.col("type") == "dialogue"),
        "self_overlap": overlaps & (F.col("before") == F.col("speaker")),
    }
    any_of = (F.coalesce(F.max(F.coalesce(c, F.lit(True)).cast("int")), F.lit(0)).alias(k) for k, c in broken.items())
    per = rows.withColumn("before", F.coalesce("before", F.lit("") if dict(script.dtypes)["speaker"] == "string" else F.lit(-1)))
    per = per.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct("speaker").alias("speakers"), F.min_by("placement", "idx").alias("opening"), *any_of)
    rules = {"count": ~F.col("n").between(least, most), "speakers": F.col("speakers") != 2, "opening": F.col("opening") != "sequential"} | {k: F.col(k) == 1 for k in broken}
    names = F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items())))
    return per.select(*keys, F.col("n").alias("n_utterances"), F.array_join(names, ",").alias("violations"))


def diarization_rules(turns: DataFrame, keys: list[str]) -> DataFrame:
    """Per recording: are speaker ids contiguous from 0, bounds valid, and turns distinct."""
    per = turns.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct("start_ms", "end_ms", "speaker").alias("d"), F.max("speaker").alias("top"), F.count_distinct("speaker").alias("k"), F.min((F.col("end_ms") > F.col("start_ms")).cast("int")).alias("ok"), F.min("start_ms").alias("first"))
    rules = {"speakers": F.col("top") + 1 != F.col("k"), "bounds": (F.col("ok") == 0) | (F.col("first") < 0), "repeated": F.col("d") < F.col("n")}
    return per.select(*keys, F.array_join(F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in rules.items()))), ",").alias("violations"))


def vad_documents(spans: DataFrame, recordings: DataFrame, keys: list[str], model: str, rate: int = 16_000) -> DataFrame:
    """keys, document and violations: speech segments (start_frame, end_frame) of recordings (n_frames) as stable JSON text.

    Segments are ordered by frame and numbered; times are milliseconds, halves up. Spans that
    overlap (``overlap``), are empty (``empty``) or pass the recording's end (``bounds``) give no
    document but their names. A recording without speech has an empty list.
    """
    if not model.strip():
        raise ValueError("a model has a name")
    w = Window.partitionBy(*keys).orderBy("start_frame", "end_frame")
    rows = spans.join(recordings.select(*keys, "n_frames"), keys).withColumn("before", F.lag("end_frame").over(w)).withColumn("index", F.row_number().over(w) - 1)
    start, end = frames_to_ms(F.col("start_frame"), rate), frames_to_ms(F.col("end_frame"), rate)
    part = F.struct(F.col("index").cast("int").alias("index"), start.alias("start_ms"), end.alias("end_ms"), (end - start).alias("duration_ms"))
    broken = {"overlap": F.col("start_frame") < F.col("before"), "empty": F.col("end_frame") <= F.col("start_frame"), "bounds": (F.col("end_frame") > F.col("n_frames")) | (F.col("start_frame") < 0)}
    per = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(part)).alias("segments"), *(F.max(F.coalesce(c, F.lit(False))).alias(k) for k, c in broken.items()))
    whole = recordings.select(*keys, "n_frames").join(per, keys, "left")
    names = F.array_join(F.array_compact(F.array(*(F.when(F.col(k), F.lit(k)) for k in broken))), ",")
    document = F.struct(F.lit(1).alias("schema_version"), F.lit(model).alias("model"), frames_to_ms(F.col("n_frames"), rate).alias("audio_duration_ms"), F.coalesce("segments", F.array().cast(per.schema["segments"].dataType)).alias("segments"))
    return whole.select(*keys, F.when(names == "", F.concat(F.to_json(document), F.lit("\n"))).alias("document"), names.alias("violations"))
