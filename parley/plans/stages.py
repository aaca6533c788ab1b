"""Queries of the stages' steps: completion with parents, failures, speech documents, audits of tracks, small texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import texts, timebase
from ..operators import blocks, contracts, intervals, lineage, sweep, tracks
from ..sources import media
from ..sources import views as v
from . import oracles as o
from .audio import _ORDER, SAMPLES
from .more import ORACLES, against
from .queries import PART, _speech

__all__ = ["ORACLES"]


@against("""WITH k AS (SELECT o_orderkey, o_orderstatus AS status, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price, CASE WHEN o_orderkey % 5 = 0 THEN 'moved' ELSE c_mktsegment END AS segment, o_totalprice, c_mktsegment
    FROM orders JOIN customer ON c_custkey = o_custkey)
  SELECT o_orderkey, CASE WHEN ok THEN 'D' ELSE status END AS o_orderstatus, CASE WHEN ok THEN 'completed' ELSE 'conflict' END AS outcome FROM (SELECT *, status = 'O' AND price = o_totalprice AND segment = c_mktsegment AS ok FROM k)
  UNION ALL SELECT o_orderkey + 100000000, NULL, 'missing' FROM orders WHERE o_orderkey % 11 = 3""")
def parent_completions(spark, d):
    """Orders completed under their customers, unless either has changed since the claim."""
    orders = v.table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    customers = v.table(spark, d, "customer")
    held = orders.join(customers.select("c_custkey", "c_mktsegment"), "c_custkey").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 5 == 0, "moved").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    lost = orders.where("o_orderkey % 11 = 3").select((F.col("o_orderkey") + 100_000_000).alias("o_orderkey"), "o_totalprice", F.lit("x").alias("c_mktsegment"))
    return lineage.complete_with_parent(orders, customers, held.unionByName(lost), "o_orderkey", "c_custkey", "o_orderstatus", "O", "D", ["o_totalprice"], ["c_mktsegment"])


@against("""SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'failed' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN CASE WHEN o_orderkey % 4 = 1 THEN 'processing_failed' ELSE left(repeat('late_' || o_orderkey || '_', 90), 512) END END AS error,
    CASE WHEN o_orderstatus = 'O' THEN 'failed' ELSE 'ignored' END AS outcome FROM orders
  UNION ALL SELECT o_orderkey + 100000000, NULL, NULL, 'missing' FROM orders WHERE o_orderkey % 13 = 2""")
def stage_failures(spark, d):
    """Failures of claimed orders, some reported twice, some with what an exception said instead of a code."""
    orders = v.table(spark, d, "orders")
    code = F.when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit("Error: key "), F.col("o_orderkey").cast("string"))).otherwise(F.repeat(F.concat(F.lit("late_"), F.col("o_orderkey").cast("string"), F.lit("_")), 90))
    told = orders.select("o_orderkey", code.alias("code"))
    again = orders.where("o_orderkey % 3 = 0 and o_orderkey % 4 <> 1").select("o_orderkey", F.lit("z").alias("code"))
    lost = orders.where("o_orderkey % 13 = 2").select((F.col("o_orderkey") + 100_000_000).alias("o_orderkey"), F.lit("gone").alias("code"))
    return lineage.fail(orders, told.unionByName(again).unionByName(lost), "o_orderkey", "o_orderstatus", "O", "code")


@against(f"""WITH {o.SPEECH}, r AS (SELECT part_id, max(end_ms) * 16 + part_id % 3 - 1 AS n FROM turns GROUP BY part_id),
  s AS (SELECT part_id, start_ms * 16 + 5 AS a, end_ms * 16 + CASE WHEN start_ms % 97 = 3 THEN 40000 ELSE 0 END AS b FROM speech),
  f AS (SELECT *, lag(b) OVER (PARTITION BY part_id ORDER BY a, b) AS before, row_number() OVER (PARTITION BY part_id ORDER BY a, b) - 1 AS i FROM s),
  j AS (SELECT part_id, string_agg('{{"index":' || i || ',"start_ms":' || (a * 1000 + 8000) // 16000 || ',"end_ms":' || (b * 1000 + 8000) // 16000 || ',"duration_ms":' || ((b * 1000 + 8000) // 16000 - (a * 1000 + 8000) // 16000) || '}}', ',' ORDER BY i) AS segments,
    max(coalesce(a < before, false)) AS overlap, max(b > n OR a < 0) AS bounds FROM f JOIN r USING (part_id) GROUP BY part_id)
  SELECT part_id, CASE WHEN NOT overlap AND NOT bounds THEN sha256('{{"schema_version":1,"model":"energy","audio_duration_ms":' || (n * 1000 + 8000) // 16000 || ',"segments":[' || segments || ']}}' || chr(10)) END AS sha256,
    CASE WHEN overlap AND bounds THEN 'overlap,bounds' WHEN overlap THEN 'overlap' WHEN bounds THEN 'bounds' ELSE '' END AS violations FROM j JOIN r USING (part_id)""")
def vad_documents(spark, d):
    recordings = v.turns(spark, d).groupBy("part_id").agg((F.max("end_ms") * 16).alias("n")).select("part_id", (F.col("n") + F.col("part_id") % 3 - 1).alias("n_frames"))
    spans = _speech(spark, d).select("part_id", (F.col("start_ms") * 16 + 5).alias("start_frame"), (F.col("end_ms") * 16 + F.when(F.col("start_ms") % 97 == 3, 40_000).otherwise(0)).alias("end_frame"))
    made = contracts.vad_documents(spans, recordings, PART, "energy")
    return made.select("part_id", F.sha2("document", 256).alias("sha256"), "violations")


_TWO = o.AUDIT.replace("THEN 1 ELSE 2 END", "THEN 1 ELSE 1 END")
_SECOND = SAMPLES.replace("x AS (SELECT", "y AS (SELECT", 1).replace("round(l_extendedprice)", "round(l_quantity * 1000)")


@against(f"""WITH {_TWO}, {SAMPLES}, {_SECOND}, z AS (SELECT part_id, max(end_ms) AS top FROM turns GROUP BY part_id), tl AS (SELECT DISTINCT track_id, len FROM x),
  pq AS (SELECT a.part_id, speaker, start_ms, end_ms, (start_ms + 1000) * len // top AS f, (end_ms - 1000) * len // top + 1 AS t FROM audit a JOIN z USING (part_id) JOIN tl ON track_id = part_id WHERE end_ms - start_ms > 3000),
  q AS (SELECT pq.part_id, speaker, start_ms, end_ms, sqrt(sum(x.x::DOUBLE * x.x) / count(*) + 1e-20) AS r0, sqrt(sum(y.x::DOUBLE * y.x) / count(*) + 1e-20) AS r1
    FROM pq JOIN x ON x.track_id = pq.part_id AND x.i >= f AND x.i < t JOIN y ON y.track_id = x.track_id AND y.i = x.i GROUP BY ALL),
  v AS (SELECT part_id, speaker, CASE WHEN (r1 > r0) = (speaker = 1) THEN 1 ELSE 0 END AS direct FROM q WHERE greatest(r0, r1) / greatest(least(r0, r1), 1e-12) >= 1.05),
  w AS (SELECT part_id, count(*) AS n, sum(direct) AS k, count(DISTINCT speaker) AS s FROM v GROUP BY part_id)
  SELECT part_id, coalesce(n, 0) AS n_votes, CASE WHEN coalesce(n, 0) = 0 OR s < 2 THEN 'inconclusive' WHEN k = n THEN 'direct' WHEN k = 0 THEN 'swapped' ELSE 'inconsistent' END AS verdict FROM (SELECT DISTINCT part_id FROM q) LEFT JOIN w USING (part_id)""")
def track_audit(spark, d):
    """Two tracks of each recording against who speaks alone: the first speaker, or any other one."""
    turns = v.turns(spark, d).withColumn("speaker", F.when(F.col("speaker") == 0, 0).otherwise(1))
    pieces = sweep.audit_pieces(turns, PART).where("end_ms - start_ms > 3000")
    sign = F.when(F.col("l_linenumber") % 2 == 0, -1).otherwise(1)
    lines = v.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("part_id"), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", (F.round("l_extendedprice").cast("long") * sign).alias("a"), (F.round(F.col("l_quantity") * 1000).cast("long") * sign).alias("b"))
    one, two = (blocks.blocked(lines, PART, _ORDER, c, 64) for c in "ab")
    held = pieces.join(turns.groupBy("part_id").agg(F.max("end_ms").alias("top")), PART).join(lines.groupBy("part_id").agg(F.count("*").alias("len")), PART)
    held = held.withColumn("from_sample", F.expr("(start_ms + 1000) * len div top")).withColumn("to_sample", F.expr("(end_ms - 1000) * len div top + 1"))
    return tracks.audit(tracks.with_levels(held, one, two, PART, 64).withColumn("slot", F.col("speaker")), PART)


@against("""SELECT conv_id, turn, trim(CASE role WHEN 'user' THEN '[sighs] [sad] ' WHEN 'assistant' THEN '[curious] ' ELSE '' END || coalesce(text, ''), ' ') AS spoken,
    printf('%02d:%02d:%02d.%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS clock
  FROM (SELECT *, CAST(round_even((length(text) * 90001 + turn)::BIGINT * 1000 / 16000.0, 0) AS BIGINT) AS ms FROM conversations)""")
def stage_texts(spark, d):
    tags = F.when(F.col("role") == "user", F.array(F.lit("[sighs]"), F.lit("[sad]"))).when(F.col("role") == "assistant", F.array(F.lit("[curious]"))).otherwise(F.array().cast("array<string>"))
    frames = F.length("text").cast("long") * 90_001 + F.col("turn")
    return v.table(spark, d, "conversations").select("conv_id", "turn", texts.spoken(tags, F.col("text")).alias("spoken"), texts.clock(frames).alias("clock"))


@against("""WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e, 20 + vec_id % 30 AS n FROM embeddings), t AS (
  SELECT vec_id, n, [e[i] FOR i IN range(1, least(n, 40) + 1)] AS a, [e[i] FOR i IN range(41, least(n, 24) + 41)] AS b FROM e)
  SELECT vec_id, n AS length, round(CASE WHEN vec_id % 2 = 1 THEN list_sum(b) ELSE list_sum(a) END, 6) AS first, round(CASE WHEN vec_id % 2 = 1 THEN list_sum(a) ELSE list_sum(b) END, 6) AS second FROM t""")
def fitted_tracks(spark, d):
    """Two tracks of each vector, cut or filled to one length and exchanged for every other."""
    n = 20 + F.col("vec_id") % 30
    pair = F.array(tracks.fitted(F.slice("embedding", 1, 40), n), tracks.fitted(F.slice("embedding", 41, 24), n))
    t = v.table(spark, d, "embeddings").select("vec_id", tracks.in_order(pair, F.col("vec_id") % 2 == 1).alias("t"))
    total = lambda x: F.round(F.aggregate(x, F.lit(0.0), lambda a, y: a + y), 6)
    return t.select("vec_id", F.size(F.col("t")[0]).cast("long").alias("length"), total(F.col("t")[0]).alias("first"), total(F.col("t")[1]).alias("second"))


@against("""WITH raw AS (SELECT c_custkey AS id, CASE c_mktsegment WHEN 'BUILDING' THEN 'lost' ELSE 'pending' END AS status, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE c_custkey // 2 END AS content FROM customer),
  parts AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 17 = 3 THEN o_custkey + 100000000 ELSE o_custkey END AS raw_id, o_orderkey % 5 - CASE WHEN o_orderkey % 29 = 0 THEN 5 ELSE 0 END AS k, CASE o_orderstatus WHEN 'P' THEN 'separating' ELSE 'diarized' END AS status,
    o_orderkey AS a, CASE WHEN o_orderkey % 13 = 1 THEN o_orderkey ELSE o_orderkey + 5 END AS b FROM orders),
  chunks AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey + CASE WHEN l_orderkey % 19 = 2 THEN 100000000 ELSE 0 END AS part_id, l_linenumber AS k, l_linenumber * 100 - CASE WHEN l_orderkey % 23 = 4 THEN 1000 ELSE 0 END AS a, l_linenumber * 100 + CAST(l_quantity AS BIGINT) AS b, CAST(l_quantity AS BIGINT) AS n FROM lineitem)
  SELECT 'raw_audios' AS entity, id, 'status' AS rule FROM raw WHERE status = 'lost'
  UNION ALL SELECT 'raw_audios', id, 'content_sha1' FROM raw WHERE content IN (SELECT content FROM raw GROUP BY content HAVING count(*) > 1)
  UNION ALL SELECT 'audio_parts', id, 'status' FROM parts WHERE status = 'separating' UNION ALL SELECT 'audio_parts', id, 'part_index' FROM parts WHERE k < 0 UNION ALL SELECT 'audio_parts', id, 'span' FROM parts WHERE b <= a
  UNION ALL SELECT 'audio_parts', id, 'unique' FROM (SELECT id, count(*) OVER (PARTITION BY raw_id, k) AS n FROM parts) WHERE n > 1 UNION ALL SELECT 'audio_parts', id, 'raw_audio_id' FROM parts WHERE raw_id NOT IN (SELECT id FROM raw)
  UNION ALL SELECT 'chunks', id, 'start' FROM chunks WHERE a < 0 UNION ALL SELECT 'chunks', id, 'span' FROM chunks WHERE b <= a UNION ALL SELECT 'chunks', id, 'duration' FROM chunks WHERE n <= 0 UNION ALL SELECT 'chunks', id, 'length' FROM chunks WHERE n <> b - a
  UNION ALL SELECT 'chunks', id, 'unique' FROM (SELECT id, count(*) OVER (PARTITION BY part_id, k) AS n FROM chunks) WHERE n > 1 UNION ALL SELECT 'chunks', id, 'audio_part_id' FROM chunks WHERE part_id NOT IN (SELECT id FROM parts)""")
def table_checks(spark, d):
    """Customers, orders and order lines as recordings, parts and chunks, some of them against the tables' checks, keys and references."""
    c, i, k = F.col("c_custkey"), F.col("o_orderkey"), F.col("l_linenumber").cast("long")
    raw = v.table(spark, d, "customer").select(c.alias("id"), F.when(F.col("c_mktsegment") == "BUILDING", "lost").otherwise("pending").alias("status"), F.when(c % 9 != 0, F.floor(c / 2)).alias("content_sha1"))
    parts = v.table(spark, d, "orders").select(
        i.alias("id"), (F.col("o_custkey") + F.when(i % 17 == 3, 100_000_000).otherwise(0)).alias("raw_audio_id"), (i % 5 - F.when(i % 29 == 0, 5).otherwise(0)).alias("part_index"),
        F.when(F.col("o_orderstatus") == "P", "separating").otherwise("diarized").alias("status"), i.alias("relative_start_ms"), (i + F.when(i % 13 == 1, 0).otherwise(5)).alias("relative_end_ms"),
    )
    line, n = F.col("l_orderkey"), F.col("l_quantity").cast("long")
    chunks = v.table(spark, d, "lineitem").select(
        (line * 10 + k).alias("id"), (line + F.when(line % 19 == 2, 100_000_000).otherwise(0)).alias("audio_part_id"), k.alias("chunk_index"), n.alias("duration_ms"),
        (k * 100 - F.when(line % 23 == 4, 1000).otherwise(0)).alias("relative_start_ms"), (k * 100 + n).alias("relative_end_ms"),
    )
    return lineage.table_checks(raw, parts, chunks)


@against("""WITH s AS (SELECT l_orderkey AS track_id, count(*) AS n FROM lineitem GROUP BY l_orderkey)
  SELECT track_id, CASE WHEN track_id % 7 <> 2 AND track_id % 11 = 3 THEN 'riff' WHEN track_id % 13 = 4 THEN 'codec' WHEN track_id % 7 = 2 THEN 'data' END AS error, CASE WHEN track_id % 7 = 2 OR track_id % 11 = 3 OR track_id % 13 = 4 THEN NULL ELSE n END AS frames,
    CASE WHEN track_id % 7 = 2 OR track_id % 11 = 3 OR track_id % 13 = 4 THEN NULL ELSE n // 2 * 2 END AS half_bytes FROM s""")
def wav_chunks(spark, d):
    """WAV files with chunks of other kinds before their data, some cut off, renamed or of another codec."""
    made = media.with_wav(v.samples(spark, d)).withColumn("n", F.length("wav"))
    i = F.col("track_id")
    extra = F.unhex(F.lit("4C49535403000000414243" + "00"))  # LIST, three bytes, padded
    head, tail = F.expr("substring(wav, 1, 36)"), F.expr("substring(wav, 37, n)")
    codec = F.concat(F.expr("substring(wav, 1, 20)"), F.unhex(F.lit("0300")), F.expr("substring(wav, 23, 14)"))
    whole = F.concat(F.when(i % 13 == 4, codec).otherwise(head), F.when(i % 3 == 0, extra).otherwise(F.lit(b"")), tail)
    content = F.when(i % 7 == 2, F.expr("substring(w, 1, length(w) - 1)")).when(i % 11 == 3, F.concat(F.lit(b"RIFX"), F.expr("substring(w, 5, length(w))"))).otherwise(F.col("w"))
    rows = made.withColumn("w", whole).withColumn("content", content).withColumn("p", media.wav_chunks("content"))
    half = F.floor(F.col("p.frames") / 2)
    first = media.payload_of(F.col("content"), F.col("p"), F.lit(0), half)
    return rows.select("track_id", F.col("p.error").alias("error"), F.col("p.frames").alias("frames"), F.length(first).cast("long").alias("half_bytes"))


@against(f"""WITH s AS (SELECT l_orderkey, (l_extendedprice - 1000) / 1000 AS a, (l_extendedprice - 1000) / 1000 + l_quantity / 100 AS b FROM lineitem), f AS (
  SELECT l_orderkey, greatest(0, CAST(sign(a) * floor(abs(CAST(CAST(a AS VARCHAR) AS DECIMAL(28, 12))) * 16000 + 0.5) AS BIGINT)) AS start_ms, least(800000, CAST(sign(b) * floor(abs(CAST(CAST(b AS VARCHAR) AS DECIMAL(28, 12))) * 16000 + 0.5) AS BIGINT)) AS end_ms, a, b FROM s),
  spans AS (SELECT l_orderkey, start_ms, end_ms FROM f WHERE b > a AND end_ms > start_ms), {o.islands('joined', 'spans', 'l_orderkey')} SELECT l_orderkey, start_ms AS start_frame, end_ms AS end_frame, n AS n_spans FROM joined""")
def normal_speech(spark, d):
    """Detected speech in seconds as frames inside its recording, overlapping and touching ranges joined."""
    a = (F.col("l_extendedprice") - 1000) / 1000
    lo, hi, ok = timebase.normal_spans(a, a + F.col("l_quantity") / 100, 800_000)
    spans = v.table(spark, d, "lineitem").where(ok).select("l_orderkey", lo.alias("start_ms"), hi.alias("end_ms"))
    return intervals.merge(spans, ["l_orderkey"], count="n_spans").withColumnsRenamed({"start_ms": "start_frame", "end_ms": "end_frame"})


@against("""SELECT o_orderkey, CASE WHEN ok THEN 'taken' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN ok THEN c_mktsegment END AS c_mktsegment, CASE WHEN ok THEN o_totalprice END AS o_totalprice, disposition FROM (
    SELECT *, disposition = 'claimed' AS ok FROM (SELECT o_orderkey, o_orderstatus, o_totalprice, c_mktsegment, CASE WHEN o_orderstatus = 'F' THEN 'already_F' WHEN c_custkey IS NULL THEN 'orphan' WHEN o_orderkey % 9 = 4 THEN 'invalid' ELSE 'claimed' END AS disposition
      FROM orders LEFT JOIN customer ON c_custkey = CASE WHEN o_orderkey % 8 = 1 THEN o_custkey + 100000000 ELSE o_custkey END))
  UNION ALL SELECT o_orderkey + 100000000, NULL, NULL, NULL, 'missing' FROM orders WHERE o_orderkey % 11 = 3""")
def parent_claims(spark, d):
    """Orders claimed with their customers' segment; some customers are gone, some orders lack a date."""
    i = F.col("o_orderkey")
    orders = v.table(spark, d, "orders").select(i, "o_orderstatus", "o_totalprice", F.when(i % 9 != 4, F.col("o_orderdate")).alias("o_orderdate"), (F.col("o_custkey") + F.when(i % 8 == 1, 100_000_000).otherwise(0)).alias("c_custkey"))
    ids = orders.select("o_orderkey").unionByName(orders.where("o_orderkey % 11 = 3").select((i + 100_000_000).alias("o_orderkey")))
    return lineage.claim_with_parent(orders, v.table(spark, d, "customer"), ids, "o_orderkey", "c_custkey", "o_orderstatus", ["O", "P"], "taken", ["o_orderdate"], ["c_mktsegment", "o_totalprice"])
