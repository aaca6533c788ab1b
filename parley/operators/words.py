"""Word-level operators: utterances, captions, subtitles and word checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..policy import SlicePolicy, UtterancePolicy
from .intervals import merge, overlap_join

# Abbreviations whose point ends no sentence.
ABBREVIATIONS = (
    "mr.", "mrs.", "ms.", "dr.", "jr.", "sr.", "prof.", "rev.", "hon.", "capt.", "sgt.", "lt.", "col.", "gen.",
    "cpl.", "maj.", "sen.", "rep.", "gov.", "pres.", "amb.", "inc.", "ltd.", "co.", "corp.", "llc.", "llp.",
    "plc.", "gmbh.", "e.g.", "i.e.", "etc.", "vs.", "cf.", "viz.", "a.m.", "p.m.", "u.s.", "u.k.", "u.n.", "e.u.",
    "st.", "ave.", "blvd.", "rd.", "ln.", "ct.", "no.", "fig.", "vol.", "pp.", "ch.", "sec.", "art.",
)


def ends_sentence(word: Column) -> Column:
    point = word.endswith(".") & ~F.lower(word).isin(*ABBREVIATIONS) & ~word.rlike(r"\..*\.") & ~word.rlike(r"^\p{L}\.$") & ~word.rlike(r"^[0-9]+\.$")
    return word.endswith("?") | word.endswith("!") | point


def utterances(words: DataFrame, keys: list[str], policy: UtterancePolicy = UtterancePolicy()) -> DataFrame:
    """Words joined to utterances: keys, utterance, start_ms, end_ms, n_words, text, confidence.

    A word opens an utterance depending on how long the one before has run, which depends on
    where that one opened; the fold carries the opening time over each speaker turn's words.
    """
    fields = [F.col(c) for c in ("idx", "start_ms", "end_ms", "word", "confidence")]
    rows = words.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields, ends_sentence(F.col("word")).alias("stop"), F.col("word").endswith(",").alias("comma")))).alias("w"))
    zero = F.struct(F.lit(None).cast("long").alias("opened"), F.lit(None).cast("long").alias("end"), F.lit(False).alias("stop"), F.lit(False).alias("comma"), F.array().cast("array<boolean>").alias("cuts"))

    def step(a: Column, x: Column) -> Column:
        gap, run = x["start_ms"] - a["end"], a["end"] - a["opened"]
        cut = a["end"].isNull() | a["stop"] | (gap > policy.huge_gap) | ((run >= policy.clause) & a["comma"]) | ((run > policy.medium) & (gap > policy.medium_gap)) | ((run > policy.emergency) & (gap >= policy.emergency_gap))
        return F.struct(F.when(cut, x["start_ms"]).otherwise(a["opened"]).alias("opened"), x["end_ms"].alias("end"), x["stop"].alias("stop"), x["comma"].alias("comma"), F.array_append(a["cuts"], F.coalesce(cut, F.lit(True))).alias("cuts"))

    cut = rows.select(*keys, "w", F.aggregate("w", zero, step)["cuts"].alias("cuts")).select(*keys, F.explode(F.arrays_zip("w", "cuts")).alias("z")).select(*keys, "z.w.*", F.col("z.cuts").alias("cut"))
    order = Window.partitionBy(*keys).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    numbered = cut.withColumn("utterance", F.sum(F.col("cut").cast("long")).over(order) - 1)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("idx", "word"))), lambda x: x["word"]), " ")
    return numbered.groupBy(*keys, "utterance").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), F.count("*").alias("n_words"), text.alias("text"), F.round(F.avg("confidence"), 6).alias("confidence"))


def srt_time(ms: Column) -> Column:
    part = lambda n, m: (F.floor(ms / n) % m).cast("int")
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3_600_000).cast("int"), part(60_000, 60), part(1_000, 60), (ms % 1000).cast("int"))


def srt(utterances: DataFrame, keys: list[str], speaker: Column) -> DataFrame:
    """One subtitle document for each key: numbered cues in time order, an empty line after each."""
    w = Window.partitionBy(*keys).orderBy("start_ms", "end_ms", "turn", "utterance")
    cue = F.concat(F.col("n").cast("string"), F.lit("\n"), srt_time(F.col("start_ms")), F.lit(" --> "), srt_time(F.col("end_ms")), F.lit("\n[Speaker "), speaker.cast("string"), F.lit("]: "), F.col("text"), F.lit("\n\n"))
    cues = utterances.withColumn("n", F.row_number().over(w)).select(*keys, F.struct("n", cue.alias("cue")).alias("c"))
    return cues.groupBy(*keys).agg(F.count("*").alias("n_cues"), F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda x: x["cue"]), "").alias("srt"))


def captions_at(points: DataFrame, utterances: DataFrame, keys: list[str]) -> DataFrame:
    """The first utterance whose closed range holds each point of time."""
    at = points.select(*keys, F.col("t").alias("start_ms"), (F.col("t") + 1).alias("end_ms"), "t")
    said = utterances.select(*keys, "start_ms", (F.col("end_ms") + 1).alias("end_ms"), "utterance", "text")
    return overlap_join(at, said, keys).groupBy(*keys, "t").agg(F.min(F.struct("r_start", "utterance", "text")).alias("c")).select(*keys, "t", F.col("c.utterance").alias("utterance"), F.col("c.text").alias("text"))


def caption_words(points: DataFrame, utterances: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    """keys, t, utterance, shown (the words that touch the utterance, in order) and active (the first of them spoken at t).

    Ranges are closed: a word that ends where the utterance starts is shown. Words meet their
    utterances once, not once for every point; points without an utterance give no row.
    """
    closed = lambda df: df.withColumn("end_ms", F.col("end_ms") + 1)
    said = closed(utterances.select(*keys, "start_ms", "end_ms", "utterance"))
    near = overlap_join(said, closed(words.select(*keys, "idx", "word", "start_ms", "end_ms")), keys)
    told = near.groupBy(*keys, "utterance").agg(F.array_sort(F.collect_list(F.struct("idx", "word", F.col("r_start").alias("from"), (F.col("r_end") - 1).alias("to")))).alias("w"))  # as many as an utterance has
    at = captions_at(points, utterances, keys).join(told, [*keys, "utterance"], "left")
    spoken = F.get(F.filter("w", lambda x: (x["from"] <= F.col("t")) & (F.col("t") <= x["to"])), 0)
    return at.select(*keys, "t", "utterance", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("shown"), spoken["idx"].cast("long").alias("active"))


def slices(turns: DataFrame, keys: list[str], duration: str = "duration_ms", policy: SlicePolicy = SlicePolicy()) -> DataFrame:
    """Each speaker's speech merged over short gaps, padded and kept inside the recording."""
    merged = merge(turns, [*keys, "speaker"], policy.gap)
    limits = turns.groupBy(*keys).agg(F.max(duration).alias("limit"))
    rows = merged.join(limits, keys).select(*keys, "speaker", F.greatest(F.lit(0).cast("long"), F.col("start_ms") - policy.pad).alias("start_ms"), F.least(F.col("limit"), F.col("end_ms") + policy.pad).alias("end_ms"))
    return rows.where("end_ms > start_ms")


def checked_words(words: DataFrame, keys: list[str], policy: UtterancePolicy = UtterancePolicy()) -> DataFrame:
    """Words trimmed, overlong ones capped, with the list of rules that each one breaks."""
    end = F.when(F.col("end_ms") - F.col("start_ms") > policy.word_most, F.col("start_ms") + policy.word_capped).otherwise(F.col("end_ms"))
    rows = words.withColumn("end_ms", end).withColumn("word", F.trim("word"))
    w = Window.partitionBy(*keys).orderBy("idx")
    late = F.struct("start_ms", "end_ms") < F.lag(F.struct("start_ms", "end_ms")).over(w)
    rules = {"empty": F.length("word") == 0, "confidence": ~F.col("confidence").between(0, 1) | F.isnan("confidence"), "bounds": (F.col("start_ms") < 0) | (F.col("end_ms") <= F.col("start_ms")), "order": F.coalesce(late, F.lit(False))}
    return rows.withColumn("violations", F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(k)) for k, c in rules.items()))))


def slice_owners(slices: DataFrame, keys: list[str]) -> DataFrame:
    """Slices (slice, core_start, core_end, start_ms, end_ms) with the instants that are theirs: own_from, own_to.

    Padded slices overlap; the border between two of them is the middle of the gap between their
    cores, so every instant has one owner. Cores lie apart and in order.
    """
    w = Window.partitionBy(*keys).orderBy("core_start", "core_end", "slice")  # slices, not words
    before, after = F.lag("core_end").over(w), F.lead("core_start").over(w)
    middle = lambda a, b: F.floor((a + b) / 2).cast("long")
    return slices.select("*", F.when(before.isNull(), -(1 << 62)).otherwise(middle(before, F.col("core_start"))).alias("own_from"), F.when(after.isNull(), 1 << 62).otherwise(middle(F.col("core_end"), after)).alias("own_to"))


def rebased(decoded: DataFrame, slices: DataFrame, keys: list[str], policy: UtterancePolicy = UtterancePolicy()) -> DataFrame:
    """Words of slices (slice, word, start_s, end_s, confidence) on their recording's time, each heard once.

    Seconds from the slice's start become milliseconds, halves to even, then the slice's start is
    added and overlong words are capped. A word that two padded slices hear belongs to the slice
    that owns its middle.
    """
    ms = lambda c: F.bround(F.col(c).cast("decimal(20,6)") * 1000, 0).cast("long")
    rows = decoded.join(slice_owners(slices, keys).select(*keys, "slice", F.col("start_ms").alias("offset"), "own_from", "own_to"), [*keys, "slice"])
    rows = rows.withColumn("start_ms", F.col("offset") + ms("start_s")).withColumn("end_ms", F.col("offset") + ms("end_s"))
    middle = F.floor((F.col("start_ms") + F.col("end_ms")) / 2)
    rows = rows.where((middle >= F.col("own_from")) & (middle < F.col("own_to")))
    end = F.when(F.col("end_ms") - F.col("start_ms") > policy.word_most, F.col("start_ms") + policy.word_capped).otherwise(F.col("end_ms"))
    return rows.withColumn("end_ms", end).select(*keys, "slice", F.trim("word").alias("word"), "start_ms", "end_ms", "confidence")
