"""Further registered queries, with their DuckDB SQL beside them."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import api
from ..functions import timebase
from ..operators import contracts, lineage, speakers, sweep, tracks, validators
from ..policy import WindowPolicy
from ..sources import views as v
from . import oracles as o
from .queries import PART, QUERIES, _buckets, query

ORACLES: dict[str, str] = {}


def against(sql: str):
    def register(f):
        ORACLES[f.__name__] = sql
        return query(f)

    return register


@against(f"""WITH e AS (SELECT vec_id, embedding[1:32] AS a, embedding[33:64] AS b, embedding[5:36] AS r FROM embeddings), c AS (
  SELECT vec_id, {o._rms('a')} AS ra, {o._rms('b')} AS rb, {o._cos('a', 'r')} AS ca, {o._cos('b', 'r')} AS cb FROM e)
  SELECT vec_id, CASE WHEN ra < 0.13 AND rb < 0.13 THEN 'reject' WHEN rb < 0.13 THEN 'a' WHEN ra < 0.13 THEN 'b' WHEN greatest(ca, cb) < 0.05 OR abs(ca - cb) < 0.01 THEN 'reject' WHEN ca > cb THEN 'a' ELSE 'b' END AS track FROM c""")
def track_alignment(spark, d):
    e = v.table(spark, d, "embeddings")
    part = lambda i: F.slice("embedding", i, 32)
    return e.select("vec_id", tracks.aligned_track(part(1), part(33), part(5), voiced=0.13, least=0.05).alias("track"))


@against(f"""WITH {o.AUDIT}, q AS (
  SELECT *, (start_ms * 31 + 7) % 97 + 1 AS r0, (start_ms * 17 + 3) % 89 + 1 AS r1 FROM audit WHERE speaker < 2), v AS (
  SELECT part_id, speaker, CASE WHEN (r1 > r0) = (speaker = 1) THEN 1 ELSE 0 END AS direct FROM q WHERE end_ms - start_ms > 3000 AND greatest(r0, r1)::DOUBLE / least(r0, r1) >= 1.05), w AS (
  SELECT part_id, count(*) AS n, sum(direct) AS k, count(DISTINCT speaker) AS s FROM v GROUP BY part_id)
  SELECT part_id, coalesce(n, 0) AS n_votes, CASE WHEN coalesce(n, 0) = 0 OR s < 2 THEN 'inconclusive' WHEN k = n THEN 'direct' WHEN k = 0 THEN 'swapped' ELSE 'inconsistent' END AS verdict FROM (SELECT DISTINCT part_id FROM q) LEFT JOIN w USING (part_id)""")
def audit_votes(spark, d):
    p = sweep.audit_pieces(v.turns(spark, d), PART).where("speaker < 2")
    p = p.withColumn("rms0", (F.col("start_ms") * 31 + 7) % 97 + 1).withColumn("rms1", (F.col("start_ms") * 17 + 3) % 89 + 1).withColumn("slot", F.col("speaker"))
    return tracks.audit(p, PART)


@against(f"""WITH {o.TURNS}, x AS (SELECT part_id, start_ms, (turn_id * 7919 % 1000) / 1000.0 AS x, max(start_ms) OVER (PARTITION BY part_id) AS top FROM turns), b AS (
  SELECT part_id, CAST(floor(start_ms * 420 / (top + 1)) AS BIGINT) AS bar, max(CASE WHEN start_ms <= top * 0.75 THEN abs(x) ELSE 0 END) AS level FROM x GROUP BY 1, 2)
  SELECT part_id, bar, round(level / greatest(max(level) OVER (PARTITION BY part_id), 1e-10), 3) AS height FROM b""")
def peaks_with_cutoff(spark, d):
    rows = v.turns(spark, d).select("part_id", "start_ms", ((F.col("turn_id") * 7919 % 1000) / 1000.0).alias("x"))
    return tracks.timed_peaks(rows, PART, "start_ms", "x", 0.75, 420)


@against("""SELECT vec_id, round(list_sum([0.65 * list_max(l[i * 4 + 1 : i * 4 + 4]) + 0.35 * list_sum(l[i * 4 + 1 : i * 4 + 4]) / 4 FOR i IN range(0, 16)]), 6) AS total,
  round(list_sum([CASE WHEN i < 16 THEN 0 ELSE l[CAST(floor((i - 16) * 64 / 48) AS BIGINT) + 1] END FOR i IN range(0, 64)]), 6) AS moved
  FROM (SELECT vec_id, list_transform(embedding, lambda x: abs(x::DOUBLE)) AS l FROM embeddings)""")
def peak_arrays(spark, d):
    level = F.transform("embedding", lambda x: F.abs(x.cast("double")))
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda s, x: s + x), 6)
    rows = v.table(spark, d, "embeddings").select("vec_id", level.alias("l"))
    return rows.select("vec_id", total(tracks.downsampled(F.col("l"), 16)).alias("total"), total(tracks.shifted(F.col("l"), F.lit(0.25))).alias("moved"))


@query
def window_seeds(spark, d):
    """Each recording has a UUID from its id's digest, and a window for each of its turns."""
    hexed = F.md5(F.col("part_id").cast("string").cast("binary"))
    rows = v.turns(spark, d).groupBy("part_id").agg(F.count("*").alias("n"))
    seeds = rows.select("part_id", F.posexplode(tracks.window_seeds(hexed, F.col("n"))).alias("window_index", "seed"))
    return seeds.select("part_id", "window_index", F.col("seed").cast("string").alias("seed"))


_PATHS = {
    "recording": (lineage.RAW_TRANSITIONS, ("pending", "splitting", "split_completed", "failed")),
    "part": (lineage.PART_TRANSITIONS, ("pending", "diarizing", "diarized", "failed", "filtering")),
    "chunk": (lineage.CHUNK_TRANSITIONS, ("separating", "separated", "transcribing", "failed", "rejected")),
}


def _illegal_sql() -> str:
    parts = []
    for level, (legal, names) in _PATHS.items():
        pick = "CASE " + " ".join(f"WHEN k = {i} THEN '{n}'" for i, n in enumerate(names)) + " END"
        parts.append(f"""SELECT '{level}' AS level, user_id, event_id, from_status, status FROM (
          SELECT user_id, event_id, status, lag(status) OVER (PARTITION BY user_id ORDER BY event_id) AS from_status FROM (
            SELECT user_id, event_id, {pick} AS status FROM (SELECT user_id, event_id, (length(event_type) + event_id) % {len(names)} AS k FROM events)))
        WHERE from_status IS NOT NULL AND (from_status, status) NOT IN ({", ".join(f"('{a}', '{b}')" for a, b in legal)})""")
    return " UNION ALL ".join(parts)


@against(_illegal_sql())
def illegal_transitions(spark, d):
    """Every user's events read as statuses of a recording, a part and a chunk: the changes that no table allows."""
    n = F.length("event_type") + F.col("event_id")
    read = F.explode(F.array(*(F.struct(F.lit(level).alias("level"), F.element_at(F.lit(list(names)), (n % len(names) + 1).cast("int")).alias("status")) for level, (_, names) in _PATHS.items())))
    rows = v.table(spark, d, "events").select("user_id", "event_id", read.alias("r")).select("user_id", "event_id", "r.level", "r.status")
    legal = [(level, *pair) for level, (pairs, _) in _PATHS.items() for pair in pairs]
    return lineage.illegal_transitions(rows, ["level", "user_id"], "event_id", "status", legal, ("level",)).select("level", "user_id", "event_id", "from_status", "status")


@against(r"""WITH s AS (SELECT conv_id, turn AS idx, role AS speaker, text, turn % 5 AS k, CASE WHEN turn % 11 = 7 THEN 'paralinguistic' WHEN (conv_id + turn) % 3 = 0 THEN 'backchannel' ELSE 'dialogue' END AS type,
    CASE WHEN (conv_id + turn) % 6 = 0 OR (conv_id + turn) % 37 = 0 THEN 'overlap_previous' ELSE 'sequential' END AS placement FROM conversations), r AS (
  SELECT *, coalesce(lag(speaker) OVER (PARTITION BY conv_id ORDER BY idx), '') AS b FROM s)
  SELECT conv_id, count(*) AS n_utterances, concat_ws(',', CASE WHEN NOT count(*) BETWEEN 2 AND 200 THEN 'count' END, CASE WHEN count(DISTINCT speaker) <> 2 THEN 'speakers' END, CASE WHEN arg_min(placement, idx) <> 'sequential' THEN 'opening' END,
    CASE WHEN bool_or(coalesce(regexp_matches(text, '[\[\]]'), true)) THEN 'brackets' END, CASE WHEN bool_or(k > 3) THEN 'tags' END, CASE WHEN bool_or(CASE WHEN type = 'paralinguistic' THEN k = 0 ELSE coalesce(text = '', true) END) THEN 'words' END,
    CASE WHEN bool_or(placement = 'overlap_previous' AND type = 'dialogue') THEN 'dialogue_overlap' END, CASE WHEN bool_or(placement = 'overlap_previous' AND b = speaker) THEN 'self_overlap' END) AS violations FROM r GROUP BY conv_id""")
def script_rules(spark, d):
    talk = v.table(spark, d, "conversations")
    tags = F.slice(F.array(F.lit("[laughs]"), F.lit("[clears throat]"), F.lit("[sad]"), F.lit("[sad]")), F.lit(1), (F.col("turn") % 5).cast("int"))
    n = F.col("conv_id") + F.col("turn")
    kind = F.when(F.col("turn") % 11 == 7, "paralinguistic").when(n % 3 == 0, "backchannel").otherwise("dialogue")
    place = F.when((n % 6 == 0) | (n % 37 == 0), "overlap_previous").otherwise("sequential")
    return contracts.script_rules(talk.select("conv_id", F.col("turn").alias("idx"), F.col("role").alias("speaker"), kind.alias("type"), place.alias("placement"), "text", tags.alias("tags")), ["conv_id"])


@query
def rendered_tracks(spark, d):
    """Sample arrays laid one after the other with a gap, then described."""
    rows = v.samples(spark, d).select("track_id", F.transform("samples", lambda x: (x / 10).cast("smallint")).alias("s"))
    at = F.array(F.lit(3), F.lit(5) + F.size("s"))
    made = rows.select("track_id", F.size("s").alias("k"), tracks.rendered(at, F.array("s", "s"), F.size("s") * 2 + 10).alias("t"))
    return made.select("track_id", F.size("t").cast("long").alias("frames"), F.aggregate(F.transform("t", lambda x: x.cast("long")), F.lit(0).cast("long"), lambda a, x: a + x).alias("total"))


@against(f"""WITH {o.BUCKETS}, t AS (SELECT part_id, start_ms, end_ms, sum(clipped) AS c FROM inwin GROUP BY ALL)
  SELECT part_id, start_ms, end_ms, CAST(c AS BIGINT) AS speech_ms, round(c / (end_ms - start_ms)::DOUBLE, 6) AS ratio FROM t""")
def overlap_ratio(spark, d):
    pairs = speakers.in_windows(_buckets(spark, d), v.turns(spark, d), PART)
    return pairs.groupBy("part_id", "start_ms", "end_ms").agg(F.sum("clipped").alias("speech_ms")).withColumn("ratio", F.round(F.col("speech_ms") / (F.col("end_ms") - F.col("start_ms")), 6))


@against("""WITH s AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, (l_extendedprice - 1000) / 1000 AS a, (l_extendedprice - 1000) / 1000 + l_quantity / 100 AS b FROM lineitem), f AS (
  SELECT l_orderkey, l_linenumber, greatest(0, CAST(sign(a) * floor(abs(CAST(CAST(a AS VARCHAR) AS DECIMAL(28, 12))) * 16000 + 0.5) AS BIGINT)) AS start_frame, least(800000, CAST(sign(b) * floor(abs(CAST(CAST(b AS VARCHAR) AS DECIMAL(28, 12))) * 16000 + 0.5) AS BIGINT)) AS end_frame, a, b FROM s)
  SELECT l_orderkey, l_linenumber, start_frame, end_frame FROM f WHERE b > a AND end_frame > start_frame""")
def detected_spans(spark, d):
    a = (F.col("l_extendedprice") - 1000) / 1000
    b = a + F.col("l_quantity") / 100
    lo, hi, ok = timebase.normal_spans(a, b, 800_000)
    return v.table(spark, d, "lineitem").where(ok).select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), lo.alias("start_frame"), hi.alias("end_frame"))


@against("SELECT id, content_sha1, path, size_bytes, 'pending' AS status FROM (SELECT sha256('raw/' || h) AS id, h AS content_sha1, min(url) AS path, min(n) AS size_bytes FROM (SELECT url, sha1(html) AS h, strlen(html) AS n FROM pages) WHERE h NOT IN (SELECT sha1(html) FROM pages WHERE page_id % 4 = 0) GROUP BY h)")
def ingest_new(spark, d):
    p = v.table(spark, d, "pages").select("page_id", F.col("url").alias("path"), F.sha1(F.col("html").cast("binary")).alias("content_sha1"), F.octet_length("html").cast("long").alias("size_bytes"))
    return api.ingest(p, p.where("page_id % 4 = 0"))


@against("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN NULL WHEN o_orderkey % 2 = 1 THEN 'separate' WHEN o_orderkey % 3 > 0 THEN 'transcribe' WHEN o_orderkey % 5 > 0 THEN 'persona' ELSE 'reconstruct' END AS retry FROM orders")
def retry_stage(spark, d):
    """The stage at which a failed entity resumes: the first whose result is missing."""
    rows = v.table(spark, d, "orders").select("o_orderkey", "o_orderstatus", *(F.when(F.col("o_orderkey") % k == 0, F.lit("{}")).alias(n) for k, n in ((2, "separate"), (3, "transcribe"), (5, "persona"))))
    missing = F.coalesce(*(F.when(F.col(n).isNull(), F.lit(n)) for n in ("separate", "transcribe", "persona")), F.lit("reconstruct"))
    return rows.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", missing).alias("retry"))


@against("SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS publish_index FROM orders WHERE o_orderstatus = 'O' AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1)")
def dispatch_recovery(spark, d):
    """Pending parts without an event, in the order in which they are published again."""
    sent = v.table(spark, d, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    left = v.table(spark, d, "orders").where("o_orderstatus = 'O'").join(sent, "o_orderkey", "left_anti")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    return left.select("o_orderkey", "o_custkey", (F.row_number().over(w) - 1).cast("long").alias("publish_index"))


@against("SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY CAST(o_orderkey AS VARCHAR)) AS ids FROM orders GROUP BY o_custkey")
def string_ordered_ids(spark, d):
    return v.table(spark, d, "orders").groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_list(F.col("o_orderkey").cast("string"))), ",").alias("ids"))


@against(f"""WITH {o.PURE}, c AS (SELECT part_id, speaker, end_ms - start_ms - 1000 AS len, start_ms + 500 AS s FROM pure WHERE end_ms - start_ms - 1000 > 4000), k AS (
  SELECT *, coalesce(sum(len) OVER (PARTITION BY part_id, speaker ORDER BY len DESC, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM c), t AS (SELECT part_id, speaker, least(len, 30000 - spent) AS take FROM k WHERE spent < 30000)
  SELECT part_id, speaker, count(*) AS n_segments, CAST(sum(take) AS BIGINT) AS effective_ms, CAST(sum(take) + 500 * (count(*) - 1) AS BIGINT) AS total_ms FROM t GROUP BY ALL HAVING sum(take) >= 4000""")
def reference_manifest(spark, d):
    """Reference audio of each speaker: segments, speech and length with half-second joints."""
    top = QUERIES["reference_topk"](spark, d)
    per = top.groupBy("part_id", "speaker").agg(F.count("*").alias("n_segments"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("effective_ms"))
    return per.withColumn("total_ms", F.col("effective_ms") + 500 * (F.col("n_segments") - 1))


@query
def timeline_rules(spark, d):
    """Rules that scheduled utterances break: a right schedule breaks none, so some starts, ends and anchors are moved."""
    i, rows = F.col("utterance_index"), QUERIES["timeline_schedule"](spark, d)
    rows = rows.withColumn("end_ms", F.when(i % 17 == 6, F.col("start_ms")).otherwise(F.col("end_ms"))).withColumn("start_ms", F.when(i % 13 == 5, F.col("start_ms") - 1_000_000).otherwise(F.col("start_ms")))
    return validators.schedules(rows.withColumn("anchor_index", F.when(i % 11 == 3, i).otherwise(F.col("anchor_index"))), PART)


@query
def conversation_windows(spark, d):
    """The whole way from turns to indexed windows, at most 90 s long."""
    t = v.turns(spark, d)
    return api.windows(t, t.groupBy("part_id").agg((F.max("end_ms") + 100).alias("limit")), PART, WindowPolicy(most=90_000))
