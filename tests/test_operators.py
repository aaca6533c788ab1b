"""Literal cases of interval, time, contract and lineage operators."""

import pytest
from pyspark.sql import functions as F

from parley.functions import timebase
from parley import policy
from parley.operators import contracts, intervals, lineage, quality, signal, words
from parley.policy import QualityPolicy
from parley.sources import media


def spans(spark, rows):
    return spark.createDataFrame([(1, a, b) for a, b in rows], "k long, start_ms long, end_ms long")


def pairs(df):
    return sorted((r["start_ms"], r["end_ms"]) for r in df.collect())


def test_union_joins_touching_ranges(spark):
    assert pairs(intervals.merge(spans(spark, [(1000, 2000), (0, 1000), (1500, 3000)]), ["k"])) == [(0, 3000)]


def test_union_crosses_buckets(spark):
    assert pairs(intervals.merge(spans(spark, [(0, 200_000), (59_000, 61_000), (119_000, 130_000), (200_001, 200_005)]), ["k"])) == [(0, 200_000), (200_001, 200_005)]


def test_union_of_nothing(spark):
    assert pairs(intervals.merge(spans(spark, []), ["k"])) == []


def test_gap_equal_to_the_limit_stays(spark):
    got = intervals.group_by_gap(spans(spark, [(0, 10_000), (25_000, 30_000), (45_001, 50_000)]), ["k"], 15_000)
    assert pairs(got) == [(0, 30_000), (45_001, 50_000)]


@pytest.mark.parametrize("span, limit, most, want", [((500, 1400), 2000, 1000, (450, 1450)), ((1000, 10_000), 21_000, 900_000, (750, 10_250)), ((0, 900), 1000, 1000, (0, 1000))])
def test_padding(spark, span, limit, most, want):
    assert pairs(intervals.pad(spans(spark, [span]), F.lit(limit), 250, 250, most)) == [want]


def test_overlap_join_takes_each_pair_once(spark):
    a, b = spans(spark, [(0, 500_000), (10, 20)]), spans(spark, [(15, 300_000), (499_999, 600_000)])
    got = intervals.overlap_join(a, b, ["k"]).collect()
    assert len(got) == 3


def test_probability_runs_fill_gaps(spark):
    def runs(ps):
        df = spark.createDataFrame([(1, i, p) for i, p in enumerate(ps)], "series_id long, idx int, p double")
        return pairs(quality.probability_runs(df, 0.2, 1, 1000, QualityPolicy(music_least=1000)))

    assert runs([1.0] * 1001 + [0.0] * 600 + [1.0] * 1001) == [(0, 2602)]
    assert runs([1.0] * 1001 + [0.0] * 601 + [1.0] * 1001) == [(0, 1001), (1602, 2603)]


def test_rounding_rules(spark):
    row = spark.range(1).select(
        timebase.seconds_to_frames(F.lit(0.00003125)).alias("a"), timebase.seconds_to_ms(F.lit(1.2349)).alias("b"), timebase.half_even(F.lit(2.5)).alias("c"),
        timebase.exact_ms(F.lit(1.0005)).alias("d"), timebase.exact_ms(F.lit(1.25)).alias("e"), timebase.frames_to_ms(F.lit(8)).alias("f"), timebase.ms_to_frames(F.lit(3)).alias("g"),
    ).first()
    assert tuple(row) == (1, 1235, 2, None, 1250, 1, 48)


def test_sentence_ends(spark):
    texts = ["Dr.", "left.", "e.g.", "A.", "12.", "Really?", "no", "a.b."]
    got = spark.createDataFrame([(t,) for t in texts], "w string").select(words.ends_sentence(F.col("w"))).collect()
    assert [r[0] for r in got] == [False, True, False, False, False, True, False, False]


def test_crossfade(spark):
    row = spark.range(1).select(signal.crossfade(F.array(*map(F.lit, [1.0, 1.0, 1.0])), F.array(*map(F.lit, [0.0, 0.0, 5.0])), F.lit(2)).alias("s")).first()
    assert row["s"] == [1.0, 1.0, 0.0, 5.0]


def test_json_keeps_nulls_and_sorts_keys(spark):
    row = spark.range(1).select(contracts.canonical_json({"b": F.lit(None).cast("int"), "a": F.lit(True)}).alias("j")).first()
    assert row["j"] == '{"a":true,"b":null}'


def test_closed_schema_and_types(spark):
    df = spark.createDataFrame([('{"a":1,"b":2}',), ('{"a":true}',), ("oops",), (None,)], "j string")
    got = df.select(contracts.has_exact_keys(F.col("j"), ["a"]), contracts.typed(F.col("j"), "$.a", "BIGINT")).collect()
    assert [tuple(r) for r in got] == [(False, True), (True, False), (False, False), (False, False)]


def test_upsert_treats_nulls_as_equal(spark):
    old = spark.createDataFrame([(1, None), (2, "x"), (4, "z")], "id int, v string")
    new = spark.createDataFrame([(1, None), (2, "y"), (3, "w")], "id int, v string")
    assert {r["id"]: r["outcome"] for r in lineage.upsert(old, new, ["id"], ["v"]).collect()} == {1: "kept", 2: "conflict", 3: "inserted", 4: "untouched"}
    assert {r["id"] for r in lineage.insert_absent(old, new, ["id"]).collect()} == {1, 2, 3, 4}


def test_wav_header_and_cut(spark):
    import numpy as np

    wav = media.to_wav(np.arange(10), 16_000)
    row = spark.createDataFrame([(bytearray(wav),)], "w binary").select(media.wav_header(F.col("w")).alias("h"), media.cut(F.col("w"), F.lit(2), F.lit(4)).alias("c")).first()
    assert tuple(row["h"]) == (1, 16_000, 16, 10, True)
    assert np.frombuffer(bytes(row["c"]), "<i2").tolist() == [2, 3]


def test_table_checks_take_nulls_as_sql_does(spark):
    raw = spark.createDataFrame([(1, "pending", "a"), (2, None, None), (3, "odd", None), (4, "failed", "a")], "id long, status string, content_sha1 string")
    parts = spark.createDataFrame([(1, 1, 0, "pending", 0, 5), (2, 1, 0, "diarized", 5, 5), (3, 9, -1, "pending", 0, None), (4, None, 0, "x", 0, 1)], "id long, raw_audio_id long, part_index long, status string, relative_start_ms long, relative_end_ms long")
    chunks = spark.createDataFrame([(1, 1, 0, 5, 0, 5), (2, 7, -1, 0, -1, -1), (3, 2, None, 4, 1, 4)], "id long, audio_part_id long, chunk_index long, duration_ms long, relative_start_ms long, relative_end_ms long")
    got = {}
    for r in lineage.table_checks(raw, parts, chunks).collect():
        got.setdefault((r["entity"], r["id"]), set()).add(r["rule"])
    assert got == {
        ("raw_audios", 1): {"content_sha1"}, ("raw_audios", 4): {"content_sha1"}, ("raw_audios", 3): {"status"},
        ("audio_parts", 1): {"unique"}, ("audio_parts", 2): {"unique", "span"}, ("audio_parts", 3): {"part_index", "raw_audio_id"}, ("audio_parts", 4): {"status", "raw_audio_id"},
        ("chunks", 2): {"audio_part_id", "chunk_index", "start", "span", "duration"}, ("chunks", 3): {"length"},
    }


@pytest.mark.parametrize(
    "made",
    [lambda: policy.WindowPolicy(most=1), lambda: policy.QualityPolicy(most_music=2), lambda: policy.PlannerPolicy(speaker_turn=9_000), lambda: policy.SlicePolicy(pad=1_500), lambda: policy.SeparationPolicy(crossfade=20_000), lambda: policy.SeparationPolicy(initial=10_000)],
)
def test_policies_refuse_bounds_out_of_order(made):
    with pytest.raises(ValueError):
        made()
