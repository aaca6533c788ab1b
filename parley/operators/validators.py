"""Contract validators: rows of documents with the rules they break.

A document is a set of rows under its keys. Each validator returns one row for each broken
rule, with the keys and, for rules of single items, the item's place; a sound document gives
none. A null where a value is due breaks the rule that looks at it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .contracts import PLACEMENTS, TYPES, canonical, good_tags
from .lineage import violations

# How a reconstructed utterance relates to what was said before.
RELATIONS = ("leading", "simultaneous", "overlap", "gap")
#: Half a second of silence joins the segments of a reference.
JOINT_MS = 500


def _ordered(keys: list[str], *order: str) -> Window:
    return Window.partitionBy(*keys).orderBy(*order)


def _in_order(w: Window, *columns: str) -> Column:
    """Not before the row before, compared by these columns."""
    before = F.lag(F.struct(*columns)).over(w)
    return before.isNull() | (F.struct(*columns) >= before)


def _per_document(rows: DataFrame, keys: list[str], rules: dict[str, Column]) -> DataFrame:
    """Rules over aggregates of a document's rows."""
    per = rows.groupBy(*keys).agg(*(F.coalesce(c, F.lit(False)).alias(k) for k, c in rules.items()))
    return violations(per, {k: F.col(k) for k in rules}, keys)


def _sha256(column: str) -> Column:
    return F.col(column).rlike(r"\A[0-9a-f]{64}\z")


def chunk_diarization(segments: DataFrame, keys: list[str]) -> DataFrame:
    """Segments (position, speaker, start_ms, end_ms, duration_ms) of chunks of chunk_ms: item rules, and two speakers."""
    w = _ordered(keys, "position")
    rows = segments.withColumn("in_order", _in_order(w, "start_ms", "end_ms", "speaker"))
    rules = {
        "bounds": (F.col("start_ms") >= 0) & (F.col("end_ms") > F.col("start_ms")) & (F.col("end_ms") <= F.col("chunk_ms")),
        "duration": F.col("duration_ms") == F.col("end_ms") - F.col("start_ms"),
        "order": F.col("in_order"),
    }
    items = violations(rows, rules, [*keys, "position"])
    whole = _per_document(segments, keys, {"two_speakers": F.count_distinct("speaker") == 2}).withColumn("position", F.lit(None).cast(segments.schema["position"].dataType))
    return items.unionByName(whole)


def diarization_document(segments: DataFrame, summary: DataFrame, documents: DataFrame, keys: list[str]) -> DataFrame:
    """Diarization documents against their own segments, with every total computed anew, halves rounded up.

    ``segments``: position, speaker, start_ms, end_ms, duration_ms. ``summary``: position, speaker,
    total_seconds, percentage. ``documents``: duration_ms, expected_ms, num_speakers, total_ms.
    """
    w = _ordered(keys, "position")
    rows = segments.join(documents.select(*keys, "expected_ms"), keys).withColumn("in_order", _in_order(w, "start_ms", "end_ms", "speaker"))
    items = {
        "segment_bounds": (F.col("start_ms") >= 0) & (F.col("end_ms") > F.col("start_ms")) & (F.col("end_ms") <= F.col("expected_ms")),
        "segment_duration": F.col("duration_ms") == F.col("end_ms") - F.col("start_ms"),
        "segment_order": F.col("in_order"),
    }
    broken = violations(rows, items, keys).distinct()
    spoken = segments.groupBy(*keys, "speaker").agg(F.sum("duration_ms").alias("ms"))
    totals = spoken.groupBy(*keys).agg(F.sum("ms").alias("all_ms"), F.count("*").alias("speakers"), F.min("speaker").alias("low"), F.max("speaker").alias("high"))
    listed = summary.groupBy(*keys).agg(F.count("*").alias("listed"))
    whole = documents.join(totals, keys, "left").join(listed, keys, "left")
    n = F.coalesce("speakers", F.lit(0))
    rules = {
        "duration": F.col("duration_ms") == F.col("expected_ms"),
        "speaker_ids": (n == 0) | ((F.col("low") == 0) & (F.col("high") == n - 1)),
        "num_speakers": F.col("num_speakers") == n,
        "total": F.col("total_ms") == F.coalesce("all_ms", F.lit(0)),
        "summary_size": F.coalesce("listed", F.lit(0)) == n,
    }
    broken = broken.unionByName(violations(whole, rules, keys))
    decimal = lambda c: F.col(c).cast("decimal(20,6)")
    said = summary.join(spoken, [*keys, "speaker"], "left").join(totals.select(*keys, "all_ms"), keys, "left")
    said = said.withColumn("place", F.row_number().over(_ordered(keys, "position")) - 1)
    each = {
        "summary_order": F.col("speaker") == F.col("place"),
        "speaker_total": decimal("total_seconds") == F.round(decimal("ms") / 1000, 2),
        "speaker_percentage": decimal("percentage") == F.when(F.col("all_ms") > 0, F.round(decimal("ms") * 100 / decimal("all_ms"), 1)).otherwise(0),
    }
    return broken.unionByName(violations(said, each, keys).distinct())


def transcript(items: DataFrame, keys: list[str]) -> DataFrame:
    """Items (slot, position, item_index, start_ms, end_ms, text, confidence) of transcripts or word alignments of chunk_ms."""
    own = [*keys, "slot"]
    w = _ordered(own, "position")
    rows = items.withColumn("place", F.row_number().over(w) - 1).withColumn("in_order", _in_order(w, "start_ms", "end_ms"))
    rules = {
        "index": F.col("item_index") == F.col("place"),
        "bounds": (F.col("start_ms") >= 0) & (F.col("start_ms") < F.col("end_ms")) & (F.col("end_ms") <= F.col("chunk_ms")),
        "order": F.col("in_order"),
        "text": canonical(F.col("text")),
        "confidence": F.col("confidence").between(0, 1) & ~F.isnan("confidence"),
    }
    return violations(rows, rules, [*own, "position"])


def artifact_pairs(transcripts: DataFrame, alignments: DataFrame, keys: list[str], identity: list[str]) -> DataFrame:
    """Documents of either kind without the other, and pairs whose shared identity fields differ."""
    a = transcripts.select(*keys, F.struct(*identity).alias("a"), F.lit(True).alias("in_a"))
    b = alignments.select(*keys, F.struct(*identity).alias("b"), F.lit(True).alias("in_b"))
    both = a.join(b, keys, "full_outer")
    paired = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    rules = {"pair": paired} | {f: ~paired | F.col(f"a.{f}").eqNullSafe(F.col(f"b.{f}")) for f in identity}
    return violations(both, rules, keys)


def separation(results: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Separation results against what was asked for.

    ``results``: speaker_a, speaker_b, uri_a, uri_b, duration_ms, sha256, verdict, reference, relation.
    ``expected``: low, high (the chunk's speakers in order), out_a, out_b, chunk_ms, input_sha256.
    """
    rows = results.join(expected, keys)
    pair = F.array("speaker_a", "speaker_b")
    rules = {
        "input": (F.col("duration_ms") == F.col("chunk_ms")) & (F.col("sha256") == F.col("input_sha256")) & _sha256("sha256"),
        "outputs": (F.col("uri_a") == F.col("out_a")) & (F.col("uri_b") == F.col("out_b")),
        "bijection": F.sort_array(pair) == F.array("low", "high"),
        "audit": (F.col("verdict") == "ok") & (F.col("reference") == F.col("low")) & F.col("relation").isin("direct", "swapped"),
        "mapping": pair == F.when(F.col("relation") == "swapped", F.array("high", "low")).otherwise(F.array("low", "high")),
    }
    return violations(rows, rules, keys)


def reconstruction(utterances: DataFrame, keys: list[str]) -> DataFrame:
    """Reconstructed utterances, and whether the last end is the track's length.

    Columns: utterance_index, speaker, start_ms, end_ms, source_start_ms, source_end_ms, source_ms,
    track_ms, text, confidence, tags, relation, anchor_index.
    """
    w, own = _ordered(keys, "utterance_index"), _ordered([*keys, "speaker"], "utterance_index")
    i, anchor = F.col("utterance_index"), F.col("anchor_index")
    rows = utterances.select("*", (F.row_number().over(w) - 1).alias("place"), F.lag("start_ms").over(w).alias("before"), F.lag("end_ms").over(own).alias("own_end"))
    first = F.col("place") == 0
    rules = {
        "index": i == F.col("place"),
        "speaker": F.col("speaker").isin(0, 1),
        "text": canonical(F.col("text")),
        "confidence": F.col("confidence").between(0, 1) & ~F.isnan("confidence"),
        "tags": good_tags(F.col("tags")),
        "source": (F.col("source_start_ms") >= 0) & (F.col("source_start_ms") < F.col("source_end_ms")) & (F.col("source_end_ms") <= F.col("source_ms")),
        "bounds": (F.col("start_ms") >= 0) & (F.col("start_ms") < F.col("end_ms")) & (F.col("end_ms") <= F.col("track_ms")),
        "chronological": F.col("before").isNull() | (F.col("start_ms") >= F.col("before")),
        "self_overlap": F.col("own_end").isNull() | (F.col("start_ms") >= F.col("own_end")),
        "relation": F.col("relation").isin(*RELATIONS) & (~first | (F.col("relation") == "leading")),
        "anchor": F.when(first, anchor.isNull()).otherwise((anchor >= 0) & (anchor < i)),
    }
    items = violations(rows, rules, [*keys, "utterance_index"])
    whole = _per_document(utterances, keys, {"track_length": F.max("end_ms") == F.max("track_ms")}).withColumn("utterance_index", F.lit(None).cast(utterances.schema["utterance_index"].dataType))
    return items.unionByName(whole)


def extension_transcript(utterances: DataFrame, script: DataFrame, keys: list[str]) -> DataFrame:
    """Timed utterances (idx, speaker, type, placement, text, start_ms, end_ms, track_ms) against their script (idx, speaker, type, placement, text)."""
    said = ["speaker", "type", "placement", "text"]
    w = _ordered(keys, "idx")
    rows = utterances.join(script.select(*keys, "idx", F.struct(*said).alias("scripted"), F.lit(True).alias("known")), [*keys, "idx"], "full_outer")
    rows = rows.select("*", F.lag("start_ms").over(w).alias("before"), F.lag("end_ms").over(w).alias("before_end"), F.row_number().over(w).alias("place"))
    start, end = F.col("start_ms"), F.col("end_ms")
    later = F.col("before").isNotNull()
    rules = {
        "script": reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"scripted.{c}")) for c in said), F.col("known").isNotNull() & start.isNotNull()),
        "kind": F.col("type").isin(*TYPES) & F.col("placement").isin(*PLACEMENTS),
        "bounds": (start >= 0) & (start < end) & (end <= F.col("track_ms")),
        "zero": (F.col("place") > 1) | (start == 0),
        "chronological": ~later | (start >= F.col("before")),
        "sequential": ~later | (F.col("placement") != "sequential") | (start >= F.col("before_end")),
        "overlap": ~later | (F.col("placement") != "overlap_previous") | (start < F.col("before_end")),
    }
    items = violations(rows, rules, [*keys, "idx"])
    whole = _per_document(utterances, keys, {"track_length": F.max("end_ms") == F.max("track_ms")}).withColumn("idx", F.lit(None).cast(utterances.schema["idx"].dataType))
    return items.unionByName(whole)


def reference_manifest(references: DataFrame, segments: DataFrame, keys: list[str], least_effective: int = 0) -> DataFrame:
    """Speakers' references (sample_rate_hz, size_bytes, sha256, effective_ms, total_ms) against their segments (start_ms, end_ms, duration_ms)."""
    good = (F.col("start_ms") >= 0) & (F.col("end_ms") > F.col("start_ms")) & (F.col("duration_ms") == F.col("end_ms") - F.col("start_ms"))
    per = segments.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("duration_ms").alias("ms"), F.min(F.coalesce(good, F.lit(False))).alias("good"))
    rules = {
        "audio": (F.col("sample_rate_hz") == 16_000) & (F.col("size_bytes") > 0) & _sha256("sha256"),
        "segments": F.col("good"),
        "effective": (F.col("effective_ms") == F.col("ms")) & (F.col("effective_ms") >= max(1, least_effective)),
        "total": F.col("total_ms") == F.col("ms") + JOINT_MS * (F.col("n") - 1),
    }
    return violations(references.join(per, keys, "left"), rules, keys)


def reference_of(wanted: DataFrame, references: DataFrame, fallback: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Each wanted speaker's reference, its own pure speech where there is none, and which of them it is."""
    own, other = references.select(*keys, F.col(value).alias("own")), fallback.select(*keys, F.col(value).alias("other"))
    rows = wanted.select(*keys).distinct().join(own, keys, "left").join(other, keys, "left")
    origin = F.when(F.col("own").isNotNull(), "manifest").when(F.col("other").isNotNull(), "pure_interval").otherwise("unavailable")
    return rows.select(*keys, F.coalesce("own", "other").alias(value), origin.alias("origin"))


def planned_pieces(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Planned chunks or parts (piece_index, start_ms, end_ms, duration_ms, uri, lang, parent_ms, parent_lang): contiguous, apart, inside."""
    w = _ordered(keys, "piece_index")
    rows = pieces.select("*", (F.row_number().over(w) - 1).alias("place"), F.max("end_ms").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("taken"))
    rules = {
        "index": F.col("piece_index") == F.col("place"),
        "uri": F.col("uri") != "",
        "lang": (F.col("lang") != "") & (F.col("lang") == F.col("parent_lang")),
        "apart": F.col("taken").isNull() | (F.col("start_ms") >= F.col("taken")),
        "inside": (F.col("start_ms") >= 0) & (F.col("end_ms") <= F.col("parent_ms")),
        "duration": (F.col("duration_ms") > 0) & (F.col("duration_ms") == F.col("end_ms") - F.col("start_ms")),
    }
    return violations(rows, rules, [*keys, "piece_index"])


def personas(speakers: DataFrame, documents: DataFrame, keys: list[str], tones: list[str], levels: list[str], emotions: list[str]) -> DataFrame:
    """Persona speakers (speaker_id, tag, tone, level, emotion, note) and documents (model, in_tokens, out_tokens, total_tokens, cost_usd).

    Speakers are two, in the string order of their ids; a note is null or canonical.
    """
    rules = {
        "tag": canonical(F.col("tag")),
        "enums": F.col("tone").isin(*tones) & F.col("level").isin(*levels) & F.col("emotion").isin(*emotions),
        "note": F.col("note").isNull() | canonical(F.col("note")),
    }
    items = violations(speakers, rules, keys).distinct()
    order = _per_document(speakers, keys, {"speakers": (F.count("*") == 2) & (F.min_by("speaker_id", "position") < F.max_by("speaker_id", "position"))})
    spent = {
        "model": F.col("model").contains("/") & canonical(F.col("model")),
        "tokens": (F.col("in_tokens") >= 0) & (F.col("out_tokens") >= 0) & F.col("total_tokens").isin(F.lit(0), F.col("in_tokens") + F.col("out_tokens")),
        "cost": (F.col("cost_usd") >= 0) & (F.col("cost_usd") < float("inf")),
    }
    return items.unionByName(order).unionByName(violations(documents, spent, keys))


def schedules(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Scheduled utterances (utterance_index, start_ms, end_ms, anchor_index): in order, anchored before themselves, with a length."""
    told = rows.withColumn("·before", F.lag("start_ms").over(_ordered(keys, "utterance_index")))
    rules = {
        "chronological": F.col("·before").isNull() | (F.col("start_ms") >= F.col("·before")),
        "anchor": F.col("anchor_index").isNull() | (F.col("anchor_index") < F.col("utterance_index")),
        "bounds": F.col("end_ms") > F.col("start_ms"),
    }
    return violations(told, rules, [*keys, "utterance_index"])
