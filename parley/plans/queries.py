"""Registered queries: each runs one operator over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import storage
from ..functions import timebase
from ..operators import contracts, intervals, lineage, planning, quality, signal, speakers, sweep, words
from ..policy import QualityPolicy, WindowPolicy
from ..sources import media
from ..sources import views as v
from ..streaming import control

PART = ["part_id"]
SAID = ["conv_id", "turn"]
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _speech(spark, d):
    return intervals.merge(v.turns(spark, d), PART, count="n_turns")


def _music(spark, d):
    return _speech(spark, d).where("n_turns >= 4").select("part_id", "start_ms", "end_ms")


def _groups(spark, d):
    p = WindowPolicy()
    return intervals.group_by_gap(_speech(spark, d).drop("n_turns"), PART, p.gap, p.least)


def _decisions(spark, d):
    rows = quality.music_overlap(_speech(spark, d), _music(spark, d), PART)
    return quality.decide(rows.withColumn("snr_db", F.pmod(F.col("start_ms") * 37 + F.col("n_turns"), F.lit(21)).cast("double")))


def _buckets(spark, d, ms=60_000):
    b = v.turns(spark, d).select("part_id", F.explode(F.expr(f"sequence(start_ms div {ms}, (end_ms - 1) div {ms})")).alias("b")).distinct()
    return b.select("part_id", (F.col("b") * ms).alias("start_ms"), ((F.col("b") + 1) * ms).alias("end_ms"))


def _said(spark, d):
    return words.utterances(v.words(spark, d), SAID)


def _ints(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*(F.col(c).cast("long").alias(c) if c in cols else F.col(c) for c in df.columns))


@query
def speech_union(spark, d):
    return _speech(spark, d)


@query
def gap_groups(spark, d):
    return _groups(spark, d)


@query
def padded_windows(spark, d):
    p = WindowPolicy()
    limit = v.turns(spark, d).groupBy("part_id").agg((F.max("end_ms") + 100).alias("limit"))
    padded = intervals.pad(_groups(spark, d).join(limit, PART), "limit", p.before, p.after, p.most)
    return intervals.indexed(padded.select("part_id", "start_ms", "end_ms"), PART)


@query
def hard_split_windows(spark, d):
    return intervals.hard_split(_groups(spark, d).select("part_id", "start_ms", "end_ms"), 90_000)


@query
def recursive_gap_split(spark, d):
    g = _groups(spark, d).select("part_id", F.col("start_ms").alias("g_start"), F.col("end_ms").alias("g_end"))
    s = _speech(spark, d).join(g, PART).where("start_ms >= g_start and end_ms <= g_end").select("part_id", "g_start", "start_ms", "end_ms")
    return planning.gap_split(s, ["part_id", "g_start"], 90_000).select("part_id", "start_ms", "end_ms")


@query
def pure_intervals(spark, d):
    return _ints(sweep.pure_intervals(v.turns(spark, d), PART), "speaker")


@query
def longest_pure_per_speaker(spark, d):
    return _ints(sweep.longest_pure(sweep.pure_intervals(v.turns(spark, d), PART), PART), "speaker")


@query
def reference_topk(spark, d):
    return _ints(sweep.reference_topk(sweep.pure_intervals(v.turns(spark, d), PART), PART), "speaker")


@query
def audit_pieces(spark, d):
    return sweep.audit_pieces(v.turns(spark, d), PART)


@query
def music_overlap(spark, d):
    return quality.music_overlap(_speech(spark, d), _music(spark, d), PART)


@query
def quality_decisions(spark, d):
    return _decisions(spark, d).select("part_id", "start_ms", "end_ms", "music_ms", "snr_db", F.round("music_ratio", 6).alias("music_ratio"), "is_good")


@query
def label_runs(spark, d):
    return quality.label_runs(_decisions(spark, d), PART).select("part_id", "run", "is_good", "start_ms", "end_ms", "n")


@query
def absorbed_regions(spark, d):
    return quality.label_runs(quality.absorb(_decisions(spark, d), PART), PART).select("part_id", "is_good", "start_ms", "end_ms", "n")


@query
def good_regions(spark, d):
    return quality.good_regions(_decisions(spark, d), _music(spark, d), PART)


@query
def region_turn_align(spark, d):
    cut = _groups(spark, d).select("part_id", (F.col("start_ms") + 700).alias("start_ms"), (F.col("end_ms") - 700).alias("end_ms"))
    return quality.align_to_turns(cut, v.turns(spark, d), PART)


@query
def prob_runs_smooth(spark, d):
    return quality.probability_runs(v.probabilities(spark, d), 0.1, 512, 1024, QualityPolicy(music_gap=600, music_least=1000))


@query
def speaker_stats_window(spark, d):
    return _ints(speakers.speaker_stats(speakers.in_windows(_buckets(spark, d), v.turns(spark, d), PART), PART), "speaker")


@query
def strict_two_speaker_windows(spark, d):
    pairs = speakers.in_windows(_buckets(spark, d), v.turns(spark, d), PART)
    return speakers.strict_two_speaker(speakers.speaker_stats(pairs, PART), PART)


@query
def airtime_extra_speaker(spark, d):
    pairs = speakers.in_windows(_buckets(spark, d), v.turns(spark, d), PART)
    return _ints(speakers.extra_speaker(speakers.speaker_stats(pairs, PART), PART), "extra_speaker")


@query
def chunk_clip(spark, d):
    return _ints(speakers.clip(_buckets(spark, d), v.turns(spark, d), PART), "speaker")


@query
def diarization_summary(spark, d):
    return _ints(speakers.speech_summary(v.turns(spark, d), PART), "speaker")


@query
def speaker_slices(spark, d):
    limit = F.max("end_ms").over(Window.partitionBy("part_id"))
    return _ints(words.slices(v.turns(spark, d).withColumn("duration_ms", limit), PART), "speaker")


@query
def monologue_runs(spark, d):
    return _ints(planning.monologues(_buckets(spark, d), v.turns(spark, d), PART), "speaker")


@query
def planned_chunks(spark, d):
    return planning.planned_chunks(_groups(spark, d), v.turns(spark, d), PART)


@query
def separation_windows(spark, d):
    two = v.turns(spark, d).withColumn("speaker", F.col("speaker") % 2)
    chunks = speakers.clip(_groups(spark, d), two, PART)
    ends = F.max("end_ms").over(Window.partitionBy("part_id", "chunk_start"))
    return planning.separation(chunks.withColumn("duration_ms", ends), ["part_id", "chunk_start"])


@query
def timeline_schedule(spark, d):
    w = Window.partitionBy("part_id").orderBy("start_ms", "end_ms", "turn_id")
    rows = v.turns(spark, d).withColumn("utterance_index", (F.row_number().over(w) - 1).cast("long")).withColumn("duration_ms", 500 + F.pmod(F.col("turn_id") * 137, F.lit(3000)))
    return planning.timeline(rows, PART)


@query
def dialogue_assembly(spark, d):
    talk = v.table(spark, d, "conversations").where("role <> 'system'")
    who = F.when(F.col("role") == "user", 0).otherwise(1)
    place = F.when(F.pmod(F.col("conv_id") + F.col("turn"), F.lit(5)) == 0, "overlap").otherwise("sequential")
    rows = talk.select("conv_id", F.col("turn").alias("idx"), who.alias("speaker"), place.alias("placement"), (F.length("text").cast("long") * 441 + 22_050).alias("frames"))
    return planning.assembled(rows, ["conv_id"])


@query
def utterances(spark, d):
    return _said(spark, d)


@query
def srt_export(spark, d):
    role = v.table(spark, d, "conversations").select(*SAID, "role")
    return words.srt(_said(spark, d).join(role, SAID), ["conv_id"], F.col("role"))


@query
def caption_lookup(spark, d):
    points = v.words(spark, d).select(*SAID, F.floor((F.col("start_ms") + F.col("end_ms")) / 2).cast("long").alias("t"))
    return words.captions_at(points, _said(spark, d), SAID)


@query
def word_checks(spark, d):
    rows = words.checked_words(v.words(spark, d).withColumn("end_ms", F.col("end_ms") + F.when(F.col("idx") % 13 == 5, 2500).otherwise(0)), SAID)
    return rows.select(*SAID, F.col("idx").cast("long").alias("idx"), "start_ms", "end_ms", F.array_join("violations", ",").alias("violations"))


@query
def wada_snr(spark, d):
    rows = v.table(spark, d, "lineitem").select("l_orderkey", (F.col("l_extendedprice") * F.when(F.col("l_linenumber") % 2 == 0, -1).otherwise(1)).alias("x"))
    return signal.snr(rows, ["l_orderkey"], "x")


@query
def rms_ratio_votes(spark, d):
    e = v.table(spark, d, "embeddings").select("vec_id", F.slice("embedding", 1, 32).alias("a"), F.slice("embedding", 33, 32).alias("b"))
    r = e.select("vec_id", signal.rms(F.col("a")).alias("ra"), signal.rms(F.col("b")).alias("rb"))
    ratio = F.greatest("ra", "rb") / F.greatest(F.least("ra", "rb"), F.lit(1e-12))
    return r.select("vec_id", F.round("ra", 6).alias("rms_a"), F.round("rb", 6).alias("rms_b"), F.when(ratio < 1.05, "none").when(F.col("ra") >= F.col("rb"), "direct").otherwise("swapped").alias("vote"))


@query
def cosine_top2_margin(spark, d):
    """Each vector against the mean of its own label and of the next one: which is nearer, and by how much."""
    e = v.table(spark, d, "embeddings").where("label is not null")
    means = e.select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    refs = means.groupBy(F.col("label").alias("ref")).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda x: x["m"]).alias("r"))  # as many as a vector has components
    asked = e.select("vec_id", "embedding", F.explode(F.array("label", (F.col("label") + 1) % 10)).alias("ref"))
    own = asked.join(refs, "ref").select("vec_id", "ref", F.round(signal.cosine(F.col("embedding"), F.col("r")), 9).alias("c"))
    best = own.groupBy("vec_id").agg(F.max(F.struct("c", (-F.col("ref")).alias("n"))).alias("t"), F.max("c").alias("high"), F.min("c").alias("low"), F.count("*").alias("k"))
    return best.select("vec_id", (-F.col("t.n")).alias("best"), F.round("t.c", 5).alias("cosine"), F.when(F.col("k") > 1, F.round(F.col("high") - F.col("low"), 5)).alias("margin"))


@query
def waveform_peaks(spark, d):
    return signal.peaks(v.table(spark, d, "lineitem").select("l_suppkey", F.struct("l_orderkey", "l_linenumber", "l_extendedprice").alias("o"), F.round("l_extendedprice").cast("long").alias("x")), ["l_suppkey"], "o", "x", 20)


@query
def crossfade_stitch(spark, d):
    e = v.table(spark, d, "embeddings").select("vec_id", F.slice("embedding", 1, 40).cast("array<double>").alias("a"), F.slice("embedding", 41, 24).cast("array<double>").alias("b"))
    s = e.select("vec_id", signal.crossfade(F.col("a"), F.col("b"), F.lit(8)).alias("s"))
    return s.select("vec_id", F.size("s").cast("long").alias("n"), F.round(F.aggregate("s", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


@query
def wav_round_trip(spark, d):
    w = media.with_wav(v.samples(spark, d)).withColumn("h", media.wav_header(F.col("wav")))
    half = F.expr("h.frames div 2")
    read = F.concat(media.samples_of(media.cut(F.col("wav"), F.lit(0), half)), media.samples_of(media.cut(F.col("wav"), half, F.col("h.frames"))))
    w = w.select("track_id", "h.channels", "h.rate", "h.bits", "h.frames", "h.whole", read.alias("s"))
    return w.select("track_id", "channels", "rate", "bits", "frames", "whole", F.size("s").cast("long").alias("read"), F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@query
def address_parts(spark, d):
    return v.table(spark, d, "pages").select("page_id", media.address(F.col("url")).alias("a")).select("page_id", "a.*")


@query
def time_conversions(spark, d):
    s = v.table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), (F.col("l_extendedprice") / 1000).alias("s"))
    return s.select("l_orderkey", "l_linenumber", timebase.seconds_to_frames(F.col("s")).alias("frames"), timebase.seconds_to_ms(F.col("s")).alias("ms"), timebase.frames_to_ms(timebase.seconds_to_frames(F.col("s"))).alias("back_ms"))


@query
def content_dedup(spark, d):
    return lineage.first_by_content(v.table(spark, d, "documents"))


@query
def lineage_counts(spark, d):
    o = v.table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("l_orderkey"))
    chunks = v.table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("k"))
    parts = o.join(chunks, "l_orderkey", "left").groupBy("c_custkey").agg(F.count("*").alias("n_parts"), F.coalesce(F.sum("k"), F.lit(0)).alias("n_chunks"))
    return v.table(spark, d, "customer").select("c_custkey").join(parts, "c_custkey", "left").select("c_custkey", F.coalesce("n_parts", F.lit(0)).alias("n_parts"), F.coalesce("n_chunks", F.lit(0)).alias("n_chunks"))


@query
def cascade_survivors(spark, d):
    kept = v.table(spark, d, "orders").where("o_orderstatus <> 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return lineage.surviving(v.table(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber")), kept, "l_orderkey")


@query
def upsert_conflicts(spark, d):
    o = v.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    old = o.where("o_orderstatus <> 'P'").drop("o_orderstatus")
    new = o.where("o_orderstatus <> 'F'").drop("o_orderstatus").withColumn("o_orderpriority", F.when(F.col("o_orderkey") % 10 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")))
    return lineage.upsert(old, new, ["o_orderkey"], ["o_custkey", "o_orderpriority"])


@query
def state_latest(spark, d):
    e = v.table(spark, d, "events").select("user_id", "event_id", "event_type")
    return lineage.latest(e, ["user_id"], "event_id", "event_type")


@query
def claims(spark, d):
    o = v.table(spark, d, "orders")
    return lineage.claim(o, o.select((F.col("o_orderkey") * 2).alias("o_orderkey")), "o_orderkey", "o_orderstatus", ["O", "P"], "X")


@query
def constraint_violations(spark, d):
    rows = v.table(spark, d, "lineitem")
    rules = {"quantity": F.col("l_quantity") <= 48, "discount": F.col("l_discount").between(0, 0.09), "flag": F.col("l_returnflag").isin("A", "N", "R")}
    return lineage.violations(rows.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_quantity", "l_discount", "l_returnflag"), rules, ["l_orderkey", "l_linenumber"])


@query
def diarization_rules(spark, d):
    return contracts.diarization_rules(v.turns(spark, d), PART)


@query
def canonical_documents(spark, d):
    t = v.table(spark, d, "labels")
    doc = contracts.canonical_json({"toxic": F.col("toxic"), "doc_id": F.col("doc_id"), "quality": F.when(F.col("doc_id") % 7 > 0, F.col("quality")), "ids": F.array("doc_id")})
    rows = t.select("doc_id", doc.alias("json"))
    return rows.select("doc_id", "json", contracts.has_exact_keys(F.col("json"), ["doc_id", "ids", "quality", "toxic"]).alias("exact"), F.sha2(F.col("json").cast("binary"), 256).alias("sha256"))


@query
def stream_dedup(spark, d):
    events = control.source(spark, d).select("event_id", "ts", "user_id", "event_type")
    return control.drained(control.deduplicated(events, ["user_id", "ts"]), "dedup").select("event_id", "user_id", "event_type")


@query
def stream_state(spark, d):
    folder = storage.shared(spark, "state")
    log = storage.shared(spark, "state-log")
    rows = control.counted_state(control.source(spark, d).select("user_id", "value"))

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/n={number}")

    rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", log).trigger(availableNow=True).start().awaitTermination()
    last = spark.read.parquet(folder).groupBy("user_id").agg(F.max_by(F.struct("n_events", "total"), "batch").alias("s"))
    return last.select("user_id", "s.n_events", F.round("s.total", 4).alias("total"))
