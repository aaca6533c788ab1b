"""Queries of the contract validators and claims: documents made from the tables, some of them faulty by their ids' remainders."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import lineage, validators
from ..sources import media
from ..sources import views as v
from . import oracles as o
from .more import ORACLES, against
from .queries import PART, QUERIES

__all__ = ["ORACLES"]

#: Turns with their place in their recording and its last end.
PLACED = f"""{o.TURNS}, d AS (SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY start_ms, end_ms, speaker, turn_id) - 1 AS pos, max(end_ms) OVER (PARTITION BY part_id) AS top FROM turns)"""


def _placed(spark, d):
    w = Window.partitionBy("part_id")
    place = (F.row_number().over(w.orderBy("start_ms", "end_ms", "speaker", "turn_id")) - 1).cast("long")
    return v.turns(spark, d).select("*", place.alias("pos"), F.max("end_ms").over(w).alias("top"))


def _odd(n: int, k: int):
    return F.col("turn_id") % n == k


def _rules(source: str, keys: str, rules: dict[str, str]) -> str:
    """One row for each broken rule of a relation's rows; an unknown verdict breaks it."""
    return " UNION ALL ".join(f"SELECT {keys}, '{name}' AS rule FROM {source} WHERE NOT coalesce({ok}, false)" for name, ok in rules.items())


_SEGMENTS = f"""{PLACED}, s AS (SELECT part_id, pos AS position, CAST(speaker AS BIGINT) AS speaker, start_ms, CASE WHEN turn_id % 23 = 4 THEN end_ms + 900000000 WHEN turn_id % 29 = 5 THEN start_ms ELSE end_ms END AS end_ms, end_ms - start_ms + CASE WHEN turn_id % 19 = 3 THEN 1 ELSE 0 END AS duration_ms, top AS chunk_ms FROM d),
  r AS (SELECT *, lag((start_ms, end_ms, speaker)) OVER (PARTITION BY part_id ORDER BY position) AS b FROM s)"""


@against(f"""WITH {_SEGMENTS} SELECT part_id, position, rule FROM ({_rules('r', 'part_id, position', {'bounds': 'start_ms >= 0 AND end_ms > start_ms AND end_ms <= chunk_ms', 'duration': 'duration_ms = end_ms - start_ms', 'order': 'b IS NULL OR (start_ms, end_ms, speaker) >= b'})}
  UNION ALL SELECT part_id, NULL, 'two_speakers' FROM s GROUP BY part_id HAVING count(DISTINCT speaker) <> 2)""")
def chunk_diarization_rules(spark, d):
    end = F.when(_odd(23, 4), F.col("end_ms") + 900_000_000).when(_odd(29, 5), F.col("start_ms")).otherwise(F.col("end_ms"))
    length = F.col("end_ms") - F.col("start_ms") + F.when(_odd(19, 3), 1).otherwise(0)
    rows = _placed(spark, d).select("part_id", F.col("pos").alias("position"), F.col("speaker").cast("long").alias("speaker"), "start_ms", end.alias("end_ms"), length.alias("duration_ms"), F.col("top").alias("chunk_ms"))
    return validators.chunk_diarization(rows, PART)


@against(f"""WITH {PLACED}, k AS (SELECT part_id, speaker, sum(end_ms - start_ms) AS ms, row_number() OVER (PARTITION BY part_id ORDER BY speaker) - 1 AS place FROM d GROUP BY part_id, speaker),
  t AS (SELECT part_id, sum(ms) AS all_ms, count(*) AS n, min(speaker) AS low, max(speaker) AS high FROM k GROUP BY part_id)
  SELECT part_id, 'duration' AS rule FROM t WHERE part_id % 7 = 1 UNION ALL SELECT part_id, 'speaker_ids' FROM t WHERE low <> 0 OR high <> n - 1 UNION ALL SELECT part_id, 'num_speakers' FROM t WHERE part_id % 5 = 2
  UNION ALL SELECT part_id, 'total' FROM t WHERE part_id % 3 = 1 UNION ALL SELECT part_id, 'summary_size' FROM t WHERE part_id % 17 = 9 AND n > 1
  UNION ALL SELECT DISTINCT part_id, 'summary_order' FROM k JOIN t USING (part_id) WHERE (part_id % 17 <> 9 OR place < n - 1 OR n = 1) AND speaker <> place
  UNION ALL SELECT DISTINCT part_id, 'speaker_total' FROM k JOIN t USING (part_id) WHERE (part_id % 17 <> 9 OR place < n - 1 OR n = 1) AND (part_id + speaker) % 13 = 6
  UNION ALL SELECT DISTINCT part_id, 'speaker_percentage' FROM k JOIN t USING (part_id) WHERE (part_id % 17 <> 9 OR place < n - 1 OR n = 1) AND (part_id + speaker) % 11 = 5
  UNION ALL SELECT DISTINCT part_id, 'segment_duration' FROM d WHERE turn_id % 41 = 3""")
def diarization_document_rules(spark, d):
    rows = _placed(spark, d)
    w = Window.partitionBy("part_id")
    spoken = rows.groupBy("part_id", "speaker").agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("ms"))
    spoken = spoken.select("*", F.sum("ms").over(w).alias("all_ms"), F.count("*").over(w).alias("n"), (F.row_number().over(w.orderBy("speaker")) - 1).alias("position"))
    part = F.col("part_id")
    documents = spoken.groupBy("part_id").agg(F.max("all_ms").alias("all_ms"), F.max("n").alias("n")).join(rows.groupBy("part_id").agg(F.max("top").alias("expected_ms")), "part_id")
    documents = documents.select("part_id", "expected_ms", (F.col("expected_ms") + (part % 7 == 1).cast("int")).alias("duration_ms"), (F.col("n") + (part % 5 == 2).cast("int")).alias("num_speakers"), (F.col("all_ms") - (part % 3 == 1).cast("int")).alias("total_ms"))
    exact = lambda c: F.col(c).cast("decimal(20,6)")
    seconds = F.round(exact("ms") / 1000, 2) + F.when((part + F.col("speaker")) % 13 == 6, 1).otherwise(0)
    share = F.round(exact("ms") * 100 / exact("all_ms"), 1) + F.when((part + F.col("speaker")) % 11 == 5, 1).otherwise(0)
    summary = spoken.where((part % 17 != 9) | (F.col("position") < F.col("n") - 1) | (F.col("n") == 1)).select("part_id", "position", "speaker", seconds.alias("total_seconds"), share.alias("percentage"))
    faulty = F.when(_odd(41, 3), F.col("end_ms") + 1).otherwise(F.col("end_ms"))
    segments = rows.select("part_id", F.col("pos").alias("position"), "speaker", "start_ms", "end_ms", (F.col("end_ms") - F.col("start_ms")).alias("duration_ms"), "turn_id")
    broken = validators.diarization_document(segments, summary, documents, PART)
    # a second reading, whose segments have other ends than their lengths say; only that rule may differ
    other = validators.diarization_document(segments.withColumn("end_ms", faulty), summary, documents.withColumn("expected_ms", F.col("expected_ms") + 1), PART)
    return broken.unionByName(other.where("rule = 'segment_duration'"))


_ITEMS = f"""{PLACED}, i AS (SELECT part_id, speaker AS slot, turn_id, start_ms, CASE WHEN turn_id % 23 = 5 THEN start_ms ELSE end_ms END AS end_ms, row_number() OVER (PARTITION BY part_id, speaker ORDER BY pos) - 1 AS position, top - CASE WHEN part_id % 5 = 0 THEN 1 ELSE 0 END AS chunk_ms FROM d),
  r AS (SELECT *, lag((start_ms, end_ms)) OVER (PARTITION BY part_id, slot ORDER BY position) AS b FROM i)"""


@against(f"WITH {_ITEMS} " + _rules("r", "part_id, slot, position", {"index": "turn_id % 17 <> 3", "bounds": "0 <= start_ms AND start_ms < end_ms AND end_ms <= chunk_ms", "order": "b IS NULL OR (start_ms, end_ms) >= b", "text": "turn_id % 31 NOT IN (11, 12, 13)", "confidence": "turn_id % 29 <> 7 AND turn_id % 37 <> 8"}))
def transcript_rules(spark, d):
    place = (F.row_number().over(Window.partitionBy("part_id", "speaker").orderBy("pos")) - 1).cast("long")
    rows = _placed(spark, d).select("*", place.alias("position")).select(
        "part_id",
        F.col("speaker").cast("long").alias("slot"),
        "position",
        (F.col("position") + F.when(_odd(17, 3), 1).otherwise(0)).alias("item_index"),
        "start_ms",
        F.when(_odd(23, 5), F.col("start_ms")).otherwise(F.col("end_ms")).alias("end_ms"),
        (F.col("top") - F.when(F.col("part_id") % 5 == 0, 1).otherwise(0)).alias("chunk_ms"),
        F.when(_odd(31, 11), " word").when(_odd(31, 12), "").when(_odd(31, 13), F.lit(None)).otherwise("two words").alias("text"),
        F.when(_odd(29, 7), 1.5).when(_odd(37, 8), float("nan")).otherwise((F.col("turn_id") % 101) / 100).alias("confidence"),
    )
    return validators.transcript(rows, PART)


@against("""SELECT o_custkey, rule FROM (SELECT DISTINCT o_custkey, CASE WHEN a IS NULL OR b IS NULL THEN 'pair' WHEN o_custkey % 7 = 3 THEN 'model' END AS rule FROM (
  SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS a, max(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS b FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY o_custkey)) WHERE rule IS NOT NULL""")
def artifact_pair_rules(spark, d):
    """Finished orders stand for transcripts, open ones for alignments; a seventh of the customers has two models."""
    orders = v.table(spark, d, "orders")
    side = lambda status: orders.where(F.col("o_orderstatus") == status).select("o_custkey").distinct()
    a = side("F").select("o_custkey", F.lit(1).alias("schema_version"), F.lit("m1").alias("model"))
    b = side("O").select("o_custkey", F.lit(1).alias("schema_version"), F.when(F.col("o_custkey") % 7 == 3, "m2").otherwise("m1").alias("model"))
    return validators.artifact_pairs(a, b, ["o_custkey"], ["schema_version", "model"])


@against("""WITH r AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders)
  SELECT k AS o_orderkey, 'input' AS rule FROM r WHERE k % 11 = 4 OR k % 13 = 5 UNION ALL SELECT k, 'outputs' FROM r WHERE k % 17 = 6 UNION ALL SELECT k, 'bijection' FROM r WHERE k % 19 = 7
  UNION ALL SELECT k, 'audit' FROM r WHERE s NOT IN ('O', 'F') OR k % 23 = 8 UNION ALL SELECT k, 'mapping' FROM r WHERE k % 19 = 7 OR (s = 'F') <> (k % 3 = 0)""")
def separation_rules(spark, d):
    k = F.col("o_orderkey")
    orders = v.table(spark, d, "orders").select(k, F.col("o_orderstatus").alias("s"))
    low, high = k % 4, k % 4 + 1
    digest = F.sha2(k.cast("string").cast("binary"), 256)
    expected = orders.select("o_orderkey", low.alias("low"), high.alias("high"), F.concat(F.lit("a/"), k.cast("string")).alias("out_a"), F.concat(F.lit("b/"), k.cast("string")).alias("out_b"), F.lit(20_000).alias("chunk_ms"), F.when(k % 13 == 5, F.upper(digest)).otherwise(digest).alias("input_sha256"))
    swapped = k % 3 == 0
    results = orders.select(
        "o_orderkey",
        F.when(swapped, high).otherwise(low).alias("speaker_a"),
        (F.when(swapped, low).otherwise(high) + F.when(k % 19 == 7, 2).otherwise(0)).alias("speaker_b"),
        F.concat(F.lit("a/"), k.cast("string")).alias("uri_a"),
        F.concat(F.when(k % 17 == 6, "c/").otherwise("b/"), k.cast("string")).alias("uri_b"),
        F.when(k % 11 == 4, 19_999).otherwise(20_000).alias("duration_ms"),
        F.when(k % 13 == 5, F.upper(digest)).otherwise(digest).alias("sha256"),
        F.when(F.col("s") == "P", "inconclusive").otherwise("ok").alias("verdict"),
        F.when(k % 23 == 8, high).otherwise(low).alias("reference"),
        F.when(F.col("s") == "F", "swapped").otherwise("direct").alias("relation"),
    )
    return validators.separation(results, expected, ["o_orderkey"])


_RECON = f"""{PLACED}, r AS (SELECT *, lag(start_ms) OVER (PARTITION BY part_id ORDER BY pos) AS b, lag(end_ms) OVER (PARTITION BY part_id, speaker ORDER BY pos) AS own, top - CASE WHEN part_id % 5 = 0 THEN 1 ELSE 0 END AS track FROM d)"""


@against(f"""WITH {_RECON} """ + _rules("r", "part_id, pos AS utterance_index", {
    "speaker": "speaker < 2", "text": "turn_id % 31 <> 11", "confidence": "turn_id % 29 <> 7", "tags": "turn_id % 6 < 4", "source": "turn_id % 37 <> 9", "bounds": "end_ms <= track", "chronological": "b IS NULL OR start_ms >= b", "self_overlap": "own IS NULL OR start_ms >= own",
    "relation": "turn_id % 43 <> 3 AND (pos > 0 OR turn_id % 2 = 0)", "anchor": "CASE WHEN pos = 0 THEN true ELSE turn_id % 13 <> 5 END"}) + " UNION ALL SELECT part_id, NULL, 'track_length' FROM r GROUP BY part_id, track HAVING max(end_ms) <> track")
def reconstruction_rules(spark, d):
    tags = F.slice(F.array(F.lit("[sad]"), F.lit("[laughs]"), F.lit("[whispers]"), F.lit("[hums]"), F.lit("[sad]")), F.lit(1), (F.col("turn_id") % 6).cast("int"))
    relation = F.when(_odd(43, 3), "later").when((F.col("pos") == 0) & (F.col("turn_id") % 2 == 0), "leading").otherwise("gap")
    anchor = F.when(F.col("pos") > 0, F.when(_odd(13, 5), F.col("pos")).otherwise(F.col("pos") - 1))
    rows = _placed(spark, d).select(
        "part_id", F.col("pos").alias("utterance_index"), "speaker", "start_ms", "end_ms", F.col("start_ms").alias("source_start_ms"),
        F.when(_odd(37, 9), F.col("start_ms")).otherwise(F.col("end_ms")).alias("source_end_ms"), F.col("top").alias("source_ms"), (F.col("top") - F.when(F.col("part_id") % 5 == 0, 1).otherwise(0)).alias("track_ms"),
        F.when(_odd(31, 11), "word ").otherwise("word").alias("text"), F.when(_odd(29, 7), -0.5).otherwise(0.5).alias("confidence"), tags.alias("tags"), relation.alias("relation"), anchor.alias("anchor_index"),
    )
    return validators.reconstruction(rows, PART)


_EXT = f"""{PLACED}, t AS (SELECT part_id, pos AS idx, turn_id, start_ms - min(start_ms) OVER (PARTITION BY part_id) + CASE WHEN part_id % 9 = 4 THEN 5 ELSE 0 END AS s, end_ms - min(start_ms) OVER (PARTITION BY part_id) + CASE WHEN part_id % 9 = 4 THEN 5 ELSE 0 END AS e, CASE WHEN turn_id % 3 = 0 THEN 'overlap_previous' ELSE 'sequential' END AS p FROM d),
  r AS (SELECT *, lag(s) OVER w AS b, lag(e) OVER w AS be, max(e) OVER (PARTITION BY part_id) AS track FROM t WINDOW w AS (PARTITION BY part_id ORDER BY idx))"""


@against(f"WITH {_EXT} SELECT part_id, idx, rule FROM (" + _rules("r", "part_id, idx", {"script": "turn_id % 31 <> 11", "zero": "idx > 0 OR s = 0", "chronological": "b IS NULL OR s >= b", "sequential": "b IS NULL OR p <> 'sequential' OR s >= be", "overlap": "b IS NULL OR p <> 'overlap_previous' OR s < be"}) + ")")
def extension_transcript_rules(spark, d):
    w = Window.partitionBy("part_id")
    shift = F.min("start_ms").over(w) - F.when(F.col("part_id") % 9 == 4, 5).otherwise(0)
    place = F.when(F.col("turn_id") % 3 == 0, "overlap_previous").otherwise("sequential")
    rows = _placed(spark, d).select("part_id", F.col("pos").alias("idx"), "turn_id", "speaker", F.lit("backchannel").alias("type"), place.alias("placement"), F.lit("well").alias("text"), (F.col("start_ms") - shift).alias("start_ms"), (F.col("end_ms") - shift).alias("end_ms"), (F.col("top") - shift).alias("track_ms"))
    script = rows.select("part_id", "idx", "speaker", "type", "placement", F.when(_odd(31, 11), "so").otherwise("well").alias("text"))
    return validators.extension_transcript(rows.drop("turn_id"), script, PART)


@against("""WITH s AS (SELECT l_orderkey, l_linenumber * 10000 AS a, l_linenumber * 10000 + CAST(l_quantity AS BIGINT) * 100 AS b FROM lineitem), r AS (SELECT l_orderkey, sum(b - a) AS ms, count(*) AS n FROM s GROUP BY l_orderkey)
  SELECT l_orderkey, 'audio' AS rule FROM r WHERE l_orderkey % 11 = 3 UNION ALL SELECT l_orderkey, 'segments' FROM r WHERE l_orderkey % 13 = 4 UNION ALL SELECT l_orderkey, 'effective' FROM r WHERE l_orderkey % 17 = 5 OR ms < 4000 OR l_orderkey % 13 = 4 UNION ALL SELECT l_orderkey, 'total' FROM r WHERE l_orderkey % 19 = 6 OR l_orderkey % 13 = 4""")
def reference_manifest_rules(spark, d):
    """Each order is a speaker's reference and each line a segment of it."""
    k, a = F.col("l_orderkey"), F.col("l_linenumber").cast("long") * 10_000
    length = F.col("l_quantity").cast("long") * 100
    lines = v.table(spark, d, "lineitem").select(k, a.alias("start_ms"), (a + length).alias("end_ms"), length.alias("ms"))
    segments = lines.select(k, "start_ms", "end_ms", (F.col("ms") + F.when(k % 13 == 4, 1).otherwise(0)).alias("duration_ms"))
    references = lines.groupBy(k).agg(F.sum("ms").alias("ms"), F.count("*").alias("n")).select(
        k, F.when(k % 11 == 3, 8_000).otherwise(16_000).alias("sample_rate_hz"), F.lit(44).alias("size_bytes"), F.sha2(k.cast("string").cast("binary"), 256).alias("sha256"),
        (F.col("ms") + F.when(k % 17 == 5, 70).otherwise(0)).alias("effective_ms"), (F.col("ms") + 500 * (F.col("n") - 1) + F.when(k % 19 == 6, 500).otherwise(0)).alias("total_ms"),
    )
    return validators.reference_manifest(references, segments, ["l_orderkey"], 4_000)


@against("""WITH w AS (SELECT DISTINCT l_suppkey, l_linenumber FROM lineitem), m AS (SELECT l_suppkey, l_linenumber, max(l_orderkey) AS x FROM lineitem WHERE l_returnflag = 'A' GROUP BY ALL), f AS (SELECT l_suppkey, l_linenumber, max(l_orderkey) AS y FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber < 5 GROUP BY ALL)
  SELECT l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, coalesce(x, y) AS ref, CASE WHEN x IS NOT NULL THEN 'manifest' WHEN y IS NOT NULL THEN 'pure_interval' ELSE 'unavailable' END AS origin FROM w LEFT JOIN m USING (l_suppkey, l_linenumber) LEFT JOIN f USING (l_suppkey, l_linenumber)""")
def reference_lookup(spark, d):
    """References with a fallback: returned lines stand for the manifest's, others for own pure speech."""
    keys = ["l_suppkey", "l_linenumber"]
    lines = v.table(spark, d, "lineitem").select("l_suppkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_orderkey", "l_returnflag")
    last = lambda rows: rows.groupBy(*keys).agg(F.max("l_orderkey").alias("ref"))
    return validators.reference_of(lines, last(lines.where("l_returnflag = 'A'")), last(lines.where("l_returnflag = 'R' and l_linenumber < 5")), keys, "ref")


_PIECES = f"""{o.GROUPS}, p AS (SELECT part_id, start_ms, row_number() OVER (PARTITION BY part_id ORDER BY start_ms) - 1 AS i, end_ms + CASE WHEN start_ms % 7 = 3 THEN 40000 ELSE 0 END AS end_ms, max(end_ms) OVER (PARTITION BY part_id) AS top FROM groups),
  r AS (SELECT *, max(end_ms) OVER (PARTITION BY part_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS taken FROM p)"""


@against(f"WITH {_PIECES} " + _rules("r", "part_id, i AS piece_index", {"uri": "start_ms % 11 <> 4", "lang": "part_id % 13 <> 5", "apart": "taken IS NULL OR start_ms >= taken", "inside": "end_ms <= top", "duration": "start_ms % 17 <> 6"}))
def planned_piece_rules(spark, d):
    w = Window.partitionBy("part_id")
    end = F.col("end_ms") + F.when(F.col("start_ms") % 7 == 3, 40_000).otherwise(0)
    rows = QUERIES["gap_groups"](spark, d).select(
        "part_id", (F.row_number().over(w.orderBy("start_ms")) - 1).cast("long").alias("piece_index"), "start_ms", end.alias("end_ms"),
        (end - F.col("start_ms") - F.when(F.col("start_ms") % 17 == 6, 1).otherwise(0)).alias("duration_ms"), F.when(F.col("start_ms") % 11 == 4, "").otherwise("s3://parts").alias("uri"),
        F.lit("en").alias("lang"), F.when(F.col("part_id") % 13 == 5, "fr").otherwise("en").alias("parent_lang"), F.max("end_ms").over(w).alias("parent_ms"),
    )
    return validators.planned_pieces(rows, PART)


@against("""WITH s AS (SELECT c_custkey AS k FROM customer)
  SELECT k AS c_custkey, 'tag' AS rule FROM s WHERE k % 7 = 2 UNION ALL SELECT k, 'enums' FROM s WHERE k % 11 = 3 UNION ALL SELECT k, 'note' FROM s WHERE k % 13 = 4 UNION ALL SELECT k, 'speakers' FROM s WHERE CAST(k AS VARCHAR) >= CAST(k + 1 AS VARCHAR)
  UNION ALL SELECT k, 'model' FROM s WHERE k % 17 = 5 UNION ALL SELECT k, 'tokens' FROM s WHERE k % 19 = 6 UNION ALL SELECT k, 'cost' FROM s WHERE k % 23 = 7""")
def persona_rules(spark, d):
    """A persona document for each customer, whose two speakers have its number and the next one."""
    k = F.col("c_custkey")
    customers = v.table(spark, d, "customer").select("c_custkey")
    speakers = customers.select("c_custkey", F.explode(F.array(F.lit(0), F.lit(1))).alias("position")).select(
        "c_custkey", "position", (k + F.col("position")).cast("string").alias("speaker_id"), F.when((k % 7 == 2) & (F.col("position") == 1), " calm").otherwise("calm").alias("tag"), F.lit("warm").alias("tone"),
        F.when(k % 11 == 3, "extreme").otherwise("low").alias("level"), F.lit("joy").alias("emotion"), F.when(k % 13 == 4, "").when(k % 2 == 0, F.lit(None)).otherwise("a note").alias("note"),
    )
    total = F.when(k % 19 == 6, 11).when(k % 2 == 0, 0).otherwise(12)
    documents = customers.select("c_custkey", F.when(k % 17 == 5, "model").otherwise("maker/model").alias("model"), F.lit(5).alias("in_tokens"), F.lit(7).alias("out_tokens"), total.alias("total_tokens"), F.when(k % 23 == 7, -0.5).otherwise(0.5).alias("cost_usd"))
    return validators.personas(speakers, documents, ["c_custkey"], ["warm", "cold"], ["low", "high"], ["joy", "fear"])


@against("""SELECT o_orderkey, CASE WHEN ok THEN 'separated' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderstatus IS NULL THEN 'missing' WHEN ok THEN 'completed' ELSE 'conflict' END AS outcome FROM (
  SELECT i.k AS o_orderkey, o.o_orderstatus, coalesce(o.o_orderstatus = 'O' AND i.k % 10 <> 0, false) AS ok FROM (SELECT DISTINCT l_orderkey * 2 AS k FROM lineitem) i LEFT JOIN orders o ON o.o_orderkey = i.k)""")
def completion_conflicts(spark, d):
    """Claims on open orders; every tenth order has changed its customer since it was claimed."""
    orders = v.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_custkey", F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderpriority")).alias("lang"))
    ids = v.table(spark, d, "lineitem").select((F.col("l_orderkey") * 2).alias("o_orderkey")).distinct()
    claims = ids.join(orders.drop("o_orderstatus"), "o_orderkey", "left").withColumn("o_custkey", F.col("o_custkey") + (F.col("o_orderkey") % 10 == 0).cast("int"))
    return lineage.complete(orders, claims, "o_orderkey", "o_orderstatus", "O", "separated", ["o_custkey", "lang"])


@against("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN '["persona","separation"]' ELSE '["separation"]' END AS names FROM orders""")
def namespace_merge(spark, d):
    """The separation result joins what an order holds; it must not replace another one."""
    held = F.when(F.col("o_orderstatus") == "F", F.create_map(F.lit("separation"), F.when(F.col("o_orderkey") % 3 == 0, "old").otherwise("new"))).when(F.col("o_orderstatus") == "P", F.create_map(F.lit("persona"), F.lit("p")))
    merged = lineage.merged_namespace(held, "separation", F.lit("new"))
    return v.table(spark, d, "orders").select("o_orderkey", F.to_json(F.sort_array(F.map_keys(merged))).alias("names"))


@against("""WITH f AS (SELECT l_orderkey AS k, count(*) * (8 + l_orderkey % 3 * 8) AS n FROM lineitem GROUP BY l_orderkey), e AS (SELECT k, n, n // 16 + CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS ms FROM f)
  SELECT k AS track_id, CAST((n * 1000 + 8000) // 16000 = ms AS BOOLEAN) AS strict, n = ms * 16 AS exact, n = ms * 16 AS chunk, n = ms * 16 AS track,
    CASE WHEN CAST(round_even((k % 4 + 1) * 11.025, 0) AS BIGINT) <= n THEN 2 * (CAST(round_even((k % 4 + 1) * 11.025, 0) AS BIGINT) - CAST(round_even(k % 4 * 11.025, 0) AS BIGINT)) END AS range_bytes FROM e""")
def wav_reads(spark, d):
    """Which readers take a track, and the bytes of one of its milliseconds at 11,025 frames a second."""
    longer = F.flatten(F.transform("samples", lambda x: F.array_repeat(x, (8 + F.col("track_id") % 3 * 8).cast("int"))))
    w = media.with_wav(v.samples(spark, d).withColumn("samples", longer)).withColumn("h", media.wav_header(F.col("wav")))
    ms = F.expr("h.frames div 16") + F.when(F.col("track_id") % 5 == 0, 1).otherwise(0)
    at = F.col("track_id") % 4
    part = media.range_of(F.col("wav"), F.col("h.frames"), at, at + 1, 11_025)
    return w.select("track_id", media.readings(F.col("h"), F.length("wav"), ms).alias("r"), F.length(part).cast("long").alias("range_bytes")).select("track_id", "r.*", "range_bytes")


@against("""SELECT o_orderkey, 'raw_audios/' || k || '/audio.wav' AS audio, 'raw_audios/' || k || '/vad_segments.json' AS segments, CASE WHEN p >= 0 THEN 'raw_audios/' || k || '/audio_parts/' || p || '/audio.wav' END AS part,
  CASE WHEN p >= 0 THEN 'raw_audios/' || k || '/audio_parts/' || p || '/results/transcript.json' ELSE 'results/transcript.json' END AS transcript FROM (SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS k, o_orderkey % 5 - 1 AS p FROM orders)""")
def storage_keys(spark, d):
    k = F.md5(F.col("o_orderkey").cast("string").cast("binary"))
    rows = v.table(spark, d, "orders").select("o_orderkey", media.raw_keys(k, F.col("o_orderkey") % 5 - 1).alias("k")).select("o_orderkey", "k.*")
    return rows.withColumn("transcript", media.beside(F.col("part"), "results", "transcript.json"))


@against("""SELECT label, '{"schema_version":1,"model":"d\\u00e9j\\u00e0","audio_duration_ms":' || n || ',"segments":[{"start_ms":0,"end_ms":' || n || '}]}' || chr(10) AS compact,
  '{' || chr(10) || '  "schema_version": 1,' || chr(10) || '  "segments": [' || chr(10) || '    ' || n || chr(10) || '  ]' || chr(10) || '}' || chr(10) AS pretty FROM (SELECT label, count(*) AS n FROM embeddings GROUP BY label)""")
def json_sinks(spark, d):
    n = v.table(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("n"))
    segment = F.struct(F.lit(0).alias("start_ms"), F.col("n").alias("end_ms"))
    compact = F.to_json(F.struct(F.lit(1).alias("schema_version"), F.lit("déjà").alias("model"), F.col("n").alias("audio_duration_ms"), F.array(segment).alias("segments")))
    pretty = F.to_json(F.struct(F.lit(1).alias("schema_version"), F.array("n").alias("segments")))
    return n.select("label", media.compact_json(compact).alias("compact"), media.pretty_json(pretty).alias("pretty"))
