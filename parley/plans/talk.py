"""Queries of words and labels on their recordings' time, and of model responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import responses, speakers, words
from ..operators.intervals import overlap_join
from ..sources import views as v
from ..storage import stored
from . import oracles as o
from .more import ORACLES, against
from .queries import PART, SAID

__all__ = ["ORACLES"]


@against(f"""WITH {o.TURNS}, l AS (SELECT user_id AS part_id, event_id AS turn_id, event_type FROM events), f AS (SELECT part_id, event_type AS label, min((start_ms, end_ms, turn_id)) AS first FROM turns JOIN l USING (part_id, turn_id) GROUP BY ALL)
  SELECT part_id, label, row_number() OVER (PARTITION BY part_id ORDER BY first, label) - 1 AS speaker FROM f""")
def first_seen_ids(spark, d):
    label = v.table(spark, d, "events").select(F.col("event_id").alias("turn_id"), F.col("event_type").alias("label"))
    return speakers.first_seen_ids(v.turns(spark, d).join(label, "turn_id"), PART, "label", ["start_ms", "end_ms", "turn_id"])


@against(f"WITH {o.WORDS} SELECT conv_id, turn, idx // 8 AS slice, word, start_ms, end_ms, confidence FROM words")
def word_rebase(spark, d):
    """Words as padded slices of eight hear them, some twice, back on their turns' time."""
    said = v.words(spark, d)
    cores = said.groupBy(*SAID, F.expr("CAST(idx DIV 8 AS BIGINT)").alias("slice")).agg(F.min("start_ms").alias("core_start"), F.max("end_ms").alias("core_end"))
    slices = stored(cores.select("*", F.greatest(F.lit(0).cast("long"), F.col("core_start") - 1500).alias("start_ms"), (F.col("core_end") + 1500).alias("end_ms")), "slices")
    heard = overlap_join(slices.select(*SAID, "slice", "start_ms", "end_ms"), said.select(*SAID, "word", "confidence", "start_ms", "end_ms"), SAID)
    seconds = lambda c: ((F.col(c) - F.col("start_ms")) / F.lit(1000)).cast("decimal(12,4)")
    decoded = heard.select(*SAID, "slice", "word", "confidence", seconds("r_start").alias("start_s"), seconds("r_end").alias("end_s"))
    return words.rebased(decoded, slices, SAID)


@against(f"""WITH RECURSIVE {o.UTTER}, p AS (SELECT conv_id, turn, idx, start_ms + (end_ms - start_ms) // 2 + CASE WHEN idx % 5 = 2 THEN 95 ELSE 0 END AS t FROM words),
  u AS (SELECT conv_id, turn, t, min((s.start_ms, s.utterance)) AS u FROM (SELECT DISTINCT conv_id, turn, t FROM p) p JOIN utt s USING (conv_id, turn) WHERE t >= s.start_ms AND t <= s.end_ms GROUP BY ALL),
  w AS (SELECT u.conv_id, u.turn, u.t, s.utterance, w.idx, w.word, t >= w.start_ms AND t <= w.end_ms AS spoken FROM u JOIN utt s ON s.conv_id = u.conv_id AND s.turn = u.turn AND s.utterance = u.u[2] JOIN words w ON w.conv_id = u.conv_id AND w.turn = u.turn AND w.end_ms >= s.start_ms AND w.start_ms <= s.end_ms)
  SELECT conv_id, turn, t, utterance, string_agg(word, ' ' ORDER BY idx) AS shown, CAST(min(idx) FILTER (spoken) AS BIGINT) AS active FROM w GROUP BY ALL""")
def caption_words(spark, d):
    """What a player shows at the middle of every word, or a little later: the utterance's words, and the one being spoken."""
    said = v.words(spark, d)
    late = F.when(F.col("idx") % 5 == 2, 95).otherwise(0)
    points = said.select(*SAID, (F.col("start_ms") + F.expr("(end_ms - start_ms) div 2") + late).alias("t")).distinct()
    return words.caption_words(points, words.utterances(said, SAID), said, SAID)


#: What an answer looks like, by its conversation and turn.
_SHAPE = "(conv_id * 7 + turn) % 12"


@against(f"""SELECT conv_id, turn, CASE WHEN {_SHAPE} < 5 THEN length(text) END AS n, CASE WHEN {_SHAPE} < 5 THEN text END AS said, CASE WHEN {_SHAPE} < 5 THEN turn + 9 END AS total_tokens,
  CASE {_SHAPE} WHEN 5 THEN 'truncated' WHEN 6 THEN 'refused' WHEN 7 THEN 'choices' WHEN 8 THEN 'missing' WHEN 9 THEN 'not_json' WHEN 10 THEN 'usage' WHEN 11 THEN 'response' END AS error FROM conversations""")
def structured_content(spark, d):
    t = v.table(spark, d, "conversations").withColumn("k", F.expr(_SHAPE).cast("int"))
    fields = F.struct(F.length("text").alias("n"), F.col("text").alias("said"), F.lit('a } in "text"').alias("note"))
    t = stored(t.select("conv_id", "turn", "k", F.to_json(fields, {"ignoreNullFields": "false"}).alias("object")), "answers")
    quoted = lambda c: F.get(F.split(F.to_json(F.struct(c.alias("x"))), r'^\{"x":', 2), 1).substr(F.lit(1), F.length(F.to_json(F.struct(c.alias("x")))) - 6)
    text = F.when(F.col("k") == 2, F.concat(F.lit("```json\n"), F.col("object"), F.lit("\n```"))).when(F.col("k") == 4, F.concat(F.lit("Sure, {see} below: "), F.col("object"), F.lit(" - and no more }"))).when(F.col("k") == 9, "no object { here").otherwise(F.col("object"))
    told = F.regexp_replace(quoted(text), r"\}$", "")
    content = F.when(F.col("k") == 0, F.col("object")).when(F.col("k") == 3, F.concat(F.lit('[{"type":"text","text":'), told, F.lit("}]"))).when(F.col("k") == 8, "17").otherwise(told)
    choice = F.concat(F.lit('{"finish_reason":"'), F.when(F.col("k") == 5, "length").otherwise("stop"), F.lit('","message":{"refusal":'), F.when(F.col("k") == 6, '"no"').otherwise("null"), F.lit(',"content":'), content, F.lit("}}"))
    usage = F.concat(F.lit('{"prompt_tokens":'), F.when(F.col("k") == 10, F.lit("-1")).otherwise("9"), F.lit(',"completion_tokens":'), F.col("turn").cast("string"), F.lit(',"total_tokens":'), (F.col("turn") + 9).cast("string"), F.lit(',"cost":0.5}'))
    response = F.concat(F.lit('{"choices":['), choice, F.when(F.col("k") == 7, F.concat(F.lit(","), choice)).otherwise(""), F.lit('],"usage":'), usage, F.when(F.col("k") == 11, "").otherwise("}"))
    got = responses.unwrapped(stored(t.select("conv_id", "turn", response.alias("response")), "responses"), ["conv_id", "turn"])
    return got.select("conv_id", "turn", F.get_json_object("content", "$.n").cast("long").alias("n"), F.get_json_object("content", "$.said").alias("said"), "total_tokens", "error")
