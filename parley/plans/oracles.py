"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations

from ..operators.signal import SNR_STATISTIC
from ..operators.words import ABBREVIATIONS

TURNS = """turns AS (
  SELECT part_id, start_ms, start_ms + 100 + len AS end_ms, speaker, turn_id FROM (
    SELECT user_id AS part_id, CAST(floor((epoch_us(ts) - 1704067200000000) / 4000000.0) AS BIGINT) AS start_ms,
      CAST(floor(value * 200) AS BIGINT) AS len, event_id AS turn_id,
      CAST(CASE WHEN event_type IN ('click', 'view') THEN 0 WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 2 END AS BIGINT) AS speaker
    FROM events))"""


def islands(name: str, source: str, keys: str, gap: int = 0, count: str = "count(*)", alias: str = "n", having: str = "") -> str:
    return f"""{name} AS (
  SELECT {keys}, min(start_ms) AS start_ms, max(end_ms) AS end_ms, CAST({count} AS BIGINT) AS {alias} FROM (
    SELECT *, sum(fresh) OVER (PARTITION BY {keys} ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS island FROM (
      SELECT *, CASE WHEN start_ms - max(end_ms) OVER (PARTITION BY {keys} ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) <= {gap} THEN 0 ELSE 1 END AS fresh
      FROM {source})) GROUP BY {keys}, island {having})"""


SPEECH = f"{TURNS}, {islands('speech', 'turns', 'part_id', alias='n_turns')}"
MUSIC = f"{SPEECH}, music AS (SELECT part_id, start_ms, end_ms FROM speech WHERE n_turns >= 4)"
GROUPS = f"{SPEECH}, {islands('groups', 'speech', 'part_id', 15000, alias='n_islands', having='HAVING max(end_ms) - min(start_ms) >= 20000')}"
MUSIC_MS = f"""{MUSIC}, covered AS (
  SELECT s.part_id, s.start_ms, s.end_ms, s.n_turns, CAST(sum(CASE WHEN m.part_id IS NULL THEN 0 ELSE least(s.end_ms, m.end_ms) - greatest(s.start_ms, m.start_ms) END) AS BIGINT) AS music_ms
  FROM speech s LEFT JOIN music m ON s.part_id = m.part_id AND m.end_ms > s.start_ms AND m.start_ms < s.end_ms GROUP BY ALL)"""
DECISIONS = f"""{MUSIC_MS}, decided AS (
  SELECT *, music_ms::DOUBLE / (end_ms - start_ms) AS music_ratio, snr_db >= 10 AND music_ms::DOUBLE / (end_ms - start_ms) <= 0.3 AS is_good
  FROM (SELECT *, CAST((start_ms * 37 + n_turns) % 21 AS DOUBLE) AS snr_db FROM covered)), tagged AS (
  SELECT *, sum(f) OVER (PARTITION BY part_id ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING)::BIGINT AS run FROM (
    SELECT *, CASE WHEN lag(is_good) OVER (PARTITION BY part_id ORDER BY start_ms, end_ms) IS NOT DISTINCT FROM is_good THEN 0 ELSE 1 END AS f FROM decided))"""
ABSORBED = f"""{DECISIONS}, runs AS (
  SELECT part_id, run, is_good, min(start_ms) AS a, max(end_ms) AS b, max(run) OVER (PARTITION BY part_id) AS top FROM tagged GROUP BY part_id, run, is_good), absorbed AS (
  SELECT t.part_id, t.start_ms, t.end_ms, t.is_good OR (r.run > 1 AND r.run < r.top AND r.b - r.a < 3000) AS is_good FROM tagged t JOIN runs r USING (part_id, run)), again AS (
  SELECT *, sum(f) OVER (PARTITION BY part_id ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS run FROM (
    SELECT *, lag(end_ms) OVER w AS p_end, lag(is_good) OVER w AS p_good, CASE WHEN lag(is_good) OVER w IS NOT DISTINCT FROM is_good THEN 0 ELSE 1 END AS f FROM absorbed WINDOW w AS (PARTITION BY part_id ORDER BY start_ms, end_ms)))"""
BOUNDS = f"""{TURNS}, {islands('spoken', 'turns', 'part_id, speaker')}, edges AS (
  SELECT part_id, start_ms AS t, 1 AS d, speaker FROM spoken UNION ALL SELECT part_id, end_ms, -1, speaker FROM spoken), at_ AS (
  SELECT part_id, t, sum(d) AS d, sum(d * speaker) AS ds FROM edges GROUP BY part_id, t), pieces AS (
  SELECT part_id, CAST(sp AS BIGINT) AS speaker, t AS start_ms, nt AS end_ms FROM (
    SELECT part_id, t, lead(t) OVER w AS nt, sum(d) OVER w AS live, sum(ds) OVER w AS sp FROM at_ WINDOW w AS (PARTITION BY part_id ORDER BY t)) WHERE live = 1 AND nt > t)"""
PURE = f"{BOUNDS}, {islands('pure', 'pieces', 'part_id, speaker')}"
AUDIT = f"""{TURNS}, e AS (SELECT part_id, start_ms AS t, 1 AS d, speaker FROM turns UNION ALL SELECT part_id, end_ms, -1, speaker FROM turns), p AS (
      SELECT part_id, t, speaker, sum(d) AS d FROM e GROUP BY ALL), g AS (SELECT DISTINCT part_id, t FROM p), sp AS (SELECT DISTINCT part_id, speaker FROM turns), l AS (
      SELECT g.part_id, g.t, sp.speaker, sum(coalesce(p.d, 0)) OVER (PARTITION BY g.part_id, sp.speaker ORDER BY g.t ROWS UNBOUNDED PRECEDING) AS live
      FROM g JOIN sp USING (part_id) LEFT JOIN p ON p.part_id = g.part_id AND p.t = g.t AND p.speaker = sp.speaker), a AS (
      SELECT part_id, t, count(*) FILTER (live > 0) AS n, max(speaker) FILTER (live > 0) AS speaker FROM l GROUP BY part_id, t), audit AS (
      SELECT part_id, speaker, t AS start_ms, nt AS end_ms FROM (SELECT *, lead(t) OVER (PARTITION BY part_id ORDER BY t) AS nt FROM a) WHERE n = 1 AND nt IS NOT NULL)"""
BUCKETS = f"""{TURNS}, buckets AS (
  SELECT DISTINCT part_id, b * 60000 AS start_ms, (b + 1) * 60000 AS end_ms FROM (SELECT part_id, unnest(range(start_ms // 60000, (end_ms - 1) // 60000 + 1)) AS b FROM turns)), inwin AS (
  SELECT b.part_id, b.start_ms, b.end_ms, t.start_ms AS r_start, t.end_ms AS r_end, t.speaker, t.turn_id, least(t.end_ms, b.end_ms) - greatest(t.start_ms, b.start_ms) AS clipped,
    CASE WHEN t.start_ms >= b.start_ms AND t.end_ms <= b.end_ms THEN t.end_ms - t.start_ms ELSE 0 END AS own
  FROM buckets b JOIN turns t ON b.part_id = t.part_id AND t.end_ms > b.start_ms AND t.start_ms < b.end_ms), stats AS (
  SELECT part_id, start_ms, end_ms, speaker, max(own) AS longest_ms, CAST(sum(own) AS BIGINT) AS total_ms, CAST(sum(clipped) AS BIGINT) AS airtime_ms, max(clipped) AS longest_clipped_ms FROM inwin GROUP BY ALL)"""
WORDS = r"""w0 AS (
  SELECT conv_id, turn, trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g')) AS s FROM conversations), w1 AS (
  SELECT conv_id, turn, unnest(string_split(s, ' ')) AS word, unnest(range(0, len(string_split(s, ' ')))) AS idx FROM w0), words AS (
  SELECT conv_id, turn, idx, word, end_ms - dur AS start_ms, end_ms, conf AS confidence FROM (
    SELECT *, CAST(sum(gap + dur) OVER (PARTITION BY conv_id, turn ORDER BY idx ROWS UNBOUNDED PRECEDING) AS BIGINT) AS end_ms FROM (
      SELECT *, 60 * length(word) + 40 AS dur, ((idx * 37) % 11) * 90 AS gap, ((idx * 7919) % 1000) / 1000.0 AS conf FROM w1 WHERE length(word) > 0)))"""
_ABBR = ", ".join(f"'{a}'" for a in ABBREVIATIONS)
UTTER = rf"""{WORDS}, n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY idx) AS rn, ends_with(word, ',') AS comma,
    ends_with(word, '?') OR ends_with(word, '!') OR (ends_with(word, '.') AND lower(word) NOT IN ({_ABBR}) AND NOT regexp_matches(word, '\..*\.') AND NOT regexp_matches(word, '^\p{{L}}\.$') AND NOT regexp_matches(word, '^[0-9]+\.$')) AS stop
  FROM words), fold AS (
  SELECT conv_id, turn, rn, start_ms AS opened, end_ms, stop, comma, 0 AS u FROM n WHERE rn = 1
  UNION ALL
  SELECT n.conv_id, n.turn, n.rn, CASE WHEN cut THEN n.start_ms ELSE f.opened END, n.end_ms, n.stop, n.comma, CASE WHEN cut THEN f.u + 1 ELSE f.u END
  FROM (SELECT f.*, f.stop OR n.start_ms - f.end_ms > 2000 OR (f.end_ms - f.opened >= 2000 AND f.comma) OR (f.end_ms - f.opened > 10000 AND n.start_ms - f.end_ms > 600) OR (f.end_ms - f.opened > 20000 AND n.start_ms - f.end_ms >= 80) AS cut
        FROM fold f JOIN n ON f.conv_id = n.conv_id AND f.turn = n.turn AND n.rn = f.rn + 1) f JOIN n ON f.conv_id = n.conv_id AND f.turn = n.turn AND n.rn = f.rn + 1), utt AS (
  SELECT conv_id, turn, CAST(u AS BIGINT) AS utterance, min(n.start_ms) AS start_ms, max(n.end_ms) AS end_ms, count(*) AS n_words, string_agg(word, ' ' ORDER BY idx) AS text, round(avg(confidence), 6) AS confidence
  FROM fold JOIN n USING (conv_id, turn, rn) GROUP BY conv_id, turn, u)"""
_MS = "lpad(CAST({0} // 3600000 AS VARCHAR), 2, '0') || ':' || lpad(CAST({0} // 60000 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST({0} // 1000 % 60 AS VARCHAR), 2, '0') || ',' || lpad(CAST({0} % 1000 AS VARCHAR), 3, '0')"
_G = "[" + ", ".join(f"{g}::DOUBLE" for g in SNR_STATISTIC) + "]"


def _rms(part: str) -> str:
    return f"sqrt(list_sum(list_transform({part}, lambda x: x::DOUBLE * x::DOUBLE)) / len({part}) + 1e-20)"


def _cos(a: str, b: str) -> str:
    dot = "list_sum(list_transform(list_zip({0}, {1}), lambda z: z[1]::DOUBLE * z[2]::DOUBLE))"
    return f"{dot.format(a, b)} / (sqrt({dot.format(a, a)}) * sqrt({dot.format(b, b)}))"


ORACLES: dict[str, str] = {
    "speech_union": f"WITH {SPEECH} SELECT * FROM speech",
    "gap_groups": f"WITH {GROUPS} SELECT * FROM groups",
    "padded_windows": f"""WITH {GROUPS}, lim AS (SELECT part_id, max(end_ms) + 100 AS lim FROM turns GROUP BY part_id), p AS (
      SELECT part_id, start_ms, end_ms, 900000 - (end_ms - start_ms) AS room, least(start_ms, 250) AS f, least(lim - end_ms, 250) AS a FROM groups JOIN lim USING (part_id)), h AS (
      SELECT *, least(f, (room + 1) // 2) AS hf, least(a, room // 2) AS ha FROM p), g AS (SELECT *, hf + least(f - hf, room - hf - ha) AS gf FROM h)
      SELECT part_id, start_ms - gf AS start_ms, end_ms + ha + least(a - ha, room - gf - ha) AS end_ms, row_number() OVER (PARTITION BY part_id ORDER BY start_ms - gf) - 1 AS part_index FROM g""",
    "hard_split_windows": f"""WITH {GROUPS} SELECT part_id, start_ms + piece * 90000 AS start_ms, least(end_ms, start_ms + (piece + 1) * 90000) AS end_ms, piece
      FROM (SELECT part_id, start_ms, end_ms, unnest(range(0, greatest(1, (end_ms - start_ms + 89999) // 90000))) AS piece FROM groups)""",
    "pure_intervals": f"WITH {PURE} SELECT part_id, speaker, start_ms, end_ms FROM pure",
    "longest_pure_per_speaker": f"""WITH {PURE} SELECT part_id, speaker, start_ms + 500 AS start_ms, least(end_ms - 500, start_ms + 30500) AS end_ms FROM (
      SELECT *, row_number() OVER (PARTITION BY part_id, speaker ORDER BY end_ms - start_ms DESC, start_ms) AS r FROM pure WHERE end_ms - start_ms > 1000) WHERE r = 1""",
    "reference_topk": f"""WITH {PURE}, c AS (SELECT part_id, speaker, start_ms + 500 AS start_ms, end_ms - 500 AS end_ms, end_ms - start_ms - 1000 AS len FROM pure WHERE end_ms - start_ms - 1000 > 4000), k AS (
      SELECT *, coalesce(sum(len) OVER (PARTITION BY part_id, speaker ORDER BY len DESC, start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent, row_number() OVER (PARTITION BY part_id, speaker ORDER BY len DESC, start_ms, end_ms) AS rank FROM c), t AS (
      SELECT *, least(len, 30000 - spent) AS take FROM k WHERE spent < 30000), s AS (SELECT *, sum(take) OVER (PARTITION BY part_id, speaker) AS total_ms FROM t)
      SELECT part_id, speaker, rank, start_ms, CAST(start_ms + take AS BIGINT) AS end_ms, CAST(total_ms AS BIGINT) AS total_ms FROM s WHERE total_ms >= 4000""",
    "audit_pieces": f"WITH {AUDIT} SELECT * FROM audit",
    "music_overlap": f"WITH {MUSIC_MS} SELECT * FROM covered",
    "quality_decisions": f"WITH {DECISIONS} SELECT part_id, start_ms, end_ms, music_ms, snr_db, round(music_ratio, 6) AS music_ratio, is_good FROM decided",
    "label_runs": f"WITH {DECISIONS} SELECT part_id, run, is_good, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n FROM tagged GROUP BY part_id, run, is_good",
    "absorbed_regions": f"WITH {ABSORBED} SELECT part_id, is_good, min(start_ms) AS start_ms, max(end_ms) AS end_ms, count(*) AS n FROM again GROUP BY part_id, run, is_good",
    "good_regions": f"""WITH {ABSORBED}, cut AS (
      SELECT *, CASE WHEN p_good IS DISTINCT FROM is_good OR EXISTS (SELECT 1 FROM music m WHERE m.part_id = a.part_id AND a.p_end < a.start_ms AND m.end_ms > a.p_end AND m.start_ms < a.start_ms) THEN 1 ELSE 0 END AS c FROM again a), reg AS (
      SELECT *, sum(c) OVER (PARTITION BY part_id ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS region FROM cut)
      SELECT part_id, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM reg WHERE is_good GROUP BY part_id, region HAVING max(end_ms) - min(start_ms) >= 20000""",
    "region_turn_align": f"""WITH {GROUPS}, r AS (SELECT part_id, start_ms + 700 AS region_start, end_ms - 700 AS region_end FROM groups)
      SELECT r.part_id, region_start, region_end, min(t.start_ms) AS start_ms, max(t.end_ms) AS end_ms FROM r JOIN turns t ON r.part_id = t.part_id AND t.end_ms > region_start AND t.start_ms < region_end GROUP BY ALL""",
    "prob_runs_smooth": f"""WITH s AS (SELECT vec_id AS series_id, unnest(range(0, len(embedding))) AS idx, abs(unnest(embedding))::DOUBLE AS p FROM embeddings), l AS (
      SELECT *, idx - row_number() OVER (PARTITION BY series_id ORDER BY idx) AS g FROM s WHERE p >= 0.1), rn AS (
      SELECT series_id, (2 * min(idx) * 512000 + 1024) // 2048 AS start_ms, (2 * (max(idx) + 1) * 512000 + 1024) // 2048 AS end_ms FROM l GROUP BY series_id, g), {islands('m', 'rn', 'series_id', 600)}
      SELECT series_id, start_ms, end_ms FROM m WHERE end_ms - start_ms > 1000""",
    "speaker_stats_window": f"WITH {BUCKETS} SELECT * FROM stats",
    "strict_two_speaker_windows": f"WITH {BUCKETS} SELECT part_id, start_ms, end_ms FROM stats GROUP BY ALL HAVING count(*) = 2 AND min(longest_ms) >= 4000 AND min(total_ms) >= 8000",
    "airtime_extra_speaker": f"""WITH {BUCKETS} SELECT part_id, start_ms, end_ms, count(*) AS n_speakers, arg_min(speaker, airtime_ms * 10 + speaker) AS extra_speaker, min(airtime_ms) AS airtime_ms
      FROM stats WHERE airtime_ms > 0 GROUP BY part_id, start_ms, end_ms HAVING count(*) > 2""",
    "chunk_clip": f"WITH {BUCKETS} SELECT part_id, start_ms AS chunk_start, greatest(r_start, start_ms) - start_ms AS start_ms, least(r_end, end_ms) - start_ms AS end_ms, speaker, turn_id FROM inwin",
    "diarization_summary": f"""WITH {TURNS}, p AS (SELECT part_id, speaker, count(*) AS n_turns, CAST(sum(end_ms - start_ms) AS BIGINT) AS total_ms FROM turns GROUP BY ALL)
      SELECT part_id, speaker, n_turns, total_ms, CAST((total_ms + 5) // 10 AS DOUBLE) / 100 AS total_seconds, CAST((2000 * total_ms + t) // (2 * t) AS DOUBLE) / 10 AS percentage
      FROM (SELECT *, CAST(sum(total_ms) OVER (PARTITION BY part_id) AS BIGINT) AS t FROM p)""",
    "speaker_slices": f"""WITH {TURNS}, {islands('m', 'turns', 'part_id, speaker', 2000)}, l AS (SELECT part_id, max(end_ms) AS lim FROM turns GROUP BY part_id)
      SELECT part_id, speaker, greatest(0, start_ms - 500) AS start_ms, least(lim, end_ms + 500) AS end_ms FROM m JOIN l USING (part_id) WHERE least(lim, end_ms + 500) > greatest(0, start_ms - 500)""",
    "dialogue_assembly": """WITH RECURSIVE s AS (SELECT conv_id, turn AS idx, CASE WHEN role = 'user' THEN 0 ELSE 1 END AS sp, (conv_id + turn) % 5 = 0 AS over, length(text) * 441 + 22050 AS fr,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS k FROM conversations WHERE role <> 'system'), f AS (
      SELECT conv_id, idx, k, CAST(0 AS BIGINT) AS st, CAST(fr AS BIGINT) AS en, CAST(fr AS BIGINT) AS ge, CAST(CASE WHEN sp = 0 THEN fr ELSE 0 END AS BIGINT) AS e0, CAST(CASE WHEN sp = 1 THEN fr ELSE 0 END AS BIGINT) AS e1, true AS ok FROM s WHERE k = 1
      UNION ALL
      SELECT conv_id, idx, k, st, st + fr, greatest(ge, st + fr), CASE WHEN sp = 0 THEN st + fr ELSE e0 END, CASE WHEN sp = 1 THEN st + fr ELSE e1 END, ok AND (NOT over OR st < pen) FROM (
        SELECT s.conv_id, s.idx, s.k, s.sp, s.over, s.fr, f.ge, f.e0, f.e1, f.ok, f.en AS pen,
          CASE WHEN NOT s.over THEN f.ge + 11025 ELSE greatest(f.st, f.en - 17640, CASE WHEN s.sp = 0 THEN f.e0 ELSE f.e1 END + 3528) END AS st
        FROM f JOIN s ON s.conv_id = f.conv_id AND s.k = f.k + 1))
      SELECT conv_id, idx, st AS start_frame, en AS end_frame FROM f WHERE conv_id NOT IN (SELECT conv_id FROM f WHERE NOT ok)""",
    "utterances": f"WITH RECURSIVE {UTTER} SELECT * FROM utt",
    "srt_export": f"""WITH RECURSIVE {UTTER}, c AS (SELECT u.*, role, row_number() OVER (PARTITION BY u.conv_id ORDER BY start_ms, end_ms, u.turn, utterance) AS n FROM utt u JOIN conversations v ON u.conv_id = v.conv_id AND u.turn = v.turn)
      SELECT conv_id, count(*) AS n_cues, string_agg(n || chr(10) || {_MS.format('start_ms')} || ' --> ' || {_MS.format('end_ms')} || chr(10) || '[Speaker ' || role || ']: ' || text || chr(10) || chr(10), '' ORDER BY n) AS srt FROM c GROUP BY conv_id""",
    "caption_lookup": f"""WITH RECURSIVE {UTTER}, p AS (SELECT conv_id, turn, (start_ms + end_ms) // 2 AS t FROM words)
      SELECT p.conv_id, p.turn, p.t, arg_min(u.utterance, u.start_ms) AS utterance, arg_min(u.text, u.start_ms) AS text FROM p JOIN utt u ON p.conv_id = u.conv_id AND p.turn = u.turn AND u.start_ms <= p.t AND p.t <= u.end_ms GROUP BY ALL""",
    "word_checks": f"""WITH {WORDS}, x AS (SELECT conv_id, turn, idx, word, start_ms, end_ms + CASE WHEN idx % 13 = 5 THEN 2500 ELSE 0 END AS e, confidence FROM words), y AS (
      SELECT *, CASE WHEN e - start_ms > 2000 THEN start_ms + 300 ELSE e END AS end_ms FROM x), z AS (SELECT *, lag(start_ms) OVER w AS ps, lag(end_ms) OVER w AS pe FROM y WINDOW w AS (PARTITION BY conv_id, turn ORDER BY idx))
      SELECT conv_id, turn, CAST(idx AS BIGINT) AS idx, start_ms, end_ms, concat_ws(',', CASE WHEN start_ms < 0 OR end_ms <= start_ms THEN 'bounds' END, CASE WHEN start_ms < ps OR (start_ms = ps AND end_ms < pe) THEN 'order' END) AS violations FROM z""",
    "wada_snr": f"""WITH x AS (SELECT l_orderkey, l_extendedprice * CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END AS x FROM lineitem), p AS (SELECT l_orderkey, max(abs(x)) AS peak FROM x GROUP BY ALL HAVING max(abs(x)) > 0), s AS (
      SELECT l_orderkey, ln(greatest(avg(greatest(abs(x) / peak, 1e-10)), 1e-10)) - avg(ln(greatest(abs(x) / peak, 1e-10))) AS st, sum((x / peak) * (x / peak)) AS en FROM x JOIN p USING (l_orderkey) GROUP BY l_orderkey), g AS (SELECT {_G} AS g), i AS (
      SELECT s.*, g, list_max(list_filter(range(1, 122), lambda k: g[k] < st)) AS k FROM s, g), d AS (
      SELECT *, CASE WHEN k IS NULL THEN -20 WHEN k = 121 THEN 100 ELSE k - 21 + (st - g[k]) / (g[k + 1] - g[k]) END AS db FROM i)
      SELECT l_orderkey, round(st, 6) AS statistic, round(10 * log10((en * pow(10, db / 10) / (1 + pow(10, db / 10))) / (en / (1 + pow(10, db / 10)) + 1e-10)), 4) AS snr_db FROM d""",
    "rms_ratio_votes": f"""WITH r AS (SELECT vec_id, {_rms('embedding[1:32]')} AS ra, {_rms('embedding[33:64]')} AS rb FROM embeddings)
      SELECT vec_id, round(ra, 6) AS rms_a, round(rb, 6) AS rms_b, CASE WHEN greatest(ra, rb) / greatest(least(ra, rb), 1e-12) < 1.05 THEN 'none' WHEN ra >= rb THEN 'direct' ELSE 'swapped' END AS vote FROM r""",
    "cosine_top2_margin": f"""WITH e AS (SELECT vec_id, embedding, label FROM embeddings WHERE label IS NOT NULL), x AS (SELECT label, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS i FROM e), m AS (
      SELECT label AS ref, list(m ORDER BY i) AS r FROM (SELECT label, i, avg(x) AS m FROM x GROUP BY label, i) GROUP BY label), a AS (SELECT vec_id, embedding, unnest([label, (label + 1) % 10]) AS ref FROM e), c AS (
      SELECT a.vec_id, a.ref, round({_cos('a.embedding', 'm.r')}, 9) AS c FROM a JOIN m ON a.ref = m.ref), k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY c DESC, ref) AS n FROM c)
      SELECT vec_id, max(ref) FILTER (n = 1) AS best, round(max(c) FILTER (n = 1), 5) AS cosine, CASE WHEN count(*) > 1 THEN round(max(c) - min(c), 5) END AS margin FROM k GROUP BY vec_id""",
    "waveform_peaks": """WITH x AS (SELECT l_suppkey, CAST(round(l_extendedprice) AS BIGINT) AS x, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_extendedprice) - 1 AS i, count(*) OVER (PARTITION BY l_suppkey) AS len FROM lineitem), b AS (
      SELECT l_suppkey, CAST(floor(i * 20 / len) AS BIGINT) AS bar, 0.65 * max(abs(x)) + 0.35 * sqrt(avg(x * x)) AS level FROM x GROUP BY 1, 2)
      SELECT l_suppkey, bar, round(pow(level / greatest(max(level) OVER (PARTITION BY l_suppkey), 1e-10), 0.72), 3) AS height FROM b""",
    "crossfade_stitch": """WITH e AS (SELECT vec_id, embedding[1:40]::DOUBLE[] AS a, embedding[41:64]::DOUBLE[] AS b FROM embeddings)
      SELECT vec_id, CAST(56 AS BIGINT) AS n, round(list_sum(a[1:32]) + list_sum([a[33 + i] * (1 - i / 7.0) + b[1 + i] * (i / 7.0) FOR i IN range(0, 8)]) + list_sum(b[9:24]), 6) AS total FROM e""",
    "wav_round_trip": """SELECT l_orderkey AS track_id, CAST(1 AS BIGINT) AS channels, CAST(16000 AS BIGINT) AS rate, CAST(16 AS BIGINT) AS bits, count(*) AS frames, true AS whole, count(*) AS read, CAST(sum(round_even(l_extendedprice / top * 32767 * 0.9, 0)) AS BIGINT) AS total
      FROM (SELECT l_orderkey, l_extendedprice, greatest(1e-9, max(abs(l_extendedprice)) OVER (PARTITION BY l_orderkey)) AS top FROM lineitem) GROUP BY l_orderkey""",
    "address_parts": r"""SELECT page_id, regexp_extract(url, '^([^:/?#]+):', 1) AS scheme, regexp_extract(url, '^[^:/?#]+://([^/?#:]*)', 1) AS host, regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1) AS path,
      NOT (regexp_matches(url, '[%\\\s?#]') OR regexp_matches(url, '(^|/)\.\.?(/|$)') OR regexp_matches(url, '[^:]//')) AND regexp_matches(url, '^[a-z][a-z0-9]*://[^/]+/.+') AS canonical FROM pages""",
    "time_conversions": """WITH s AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(CAST(l_extendedprice / 1000 AS VARCHAR) AS DECIMAL(28, 12)) AS s FROM lineitem), f AS (
      SELECT *, CAST(floor(s * 16000 + 0.5) AS BIGINT) AS frames FROM s) SELECT l_orderkey, l_linenumber, frames, CAST(floor(s * 1000 + 0.5) AS BIGINT) AS ms, (frames * 1000 + 8000) // 16000 AS back_ms FROM f""",
    "content_dedup": "SELECT sha1(coalesce(text, '')) AS content_sha1, min(doc_id) AS doc_id, count(*) AS n_rows FROM documents GROUP BY 1",
    "lineage_counts": """WITH k AS (SELECT l_orderkey, count(*) AS k FROM lineitem GROUP BY 1), p AS (SELECT o_custkey, count(*) AS n, sum(k) AS c FROM orders LEFT JOIN k ON o_orderkey = l_orderkey GROUP BY 1)
      SELECT c_custkey, coalesce(n, 0) AS n_parts, CAST(coalesce(c, 0) AS BIGINT) AS n_chunks FROM customer LEFT JOIN p ON c_custkey = o_custkey""",
    "cascade_survivors": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')",
    "upsert_conflicts": """WITH a AS (SELECT * FROM orders WHERE o_orderstatus <> 'P'), b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderpriority END AS p FROM orders WHERE o_orderstatus <> 'F')
      SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN b.o_orderkey IS NULL THEN 'untouched' WHEN a.o_orderkey IS NULL THEN 'inserted' WHEN a.o_custkey IS NOT DISTINCT FROM b.o_custkey AND a.o_orderpriority IS NOT DISTINCT FROM b.p THEN 'kept' ELSE 'conflict' END AS outcome
      FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey""",
    "state_latest": "SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id, count(*) AS n_events FROM events GROUP BY user_id",
    "claims": """WITH i AS (SELECT DISTINCT o_orderkey * 2 AS o_orderkey FROM orders) SELECT i.o_orderkey, CASE WHEN o_orderstatus IN ('O', 'P') THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
      CASE WHEN o_orderstatus IS NULL THEN 'missing' WHEN o_orderstatus IN ('O', 'P') THEN 'claimed' ELSE 'already_' || o_orderstatus END AS disposition FROM i LEFT JOIN orders o ON i.o_orderkey = o.o_orderkey""",
    "constraint_violations": """WITH l AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, l_discount, l_returnflag FROM lineitem)
      SELECT l_orderkey, l_linenumber, 'quantity' AS rule FROM l WHERE NOT coalesce(l_quantity <= 48, false) UNION ALL SELECT l_orderkey, l_linenumber, 'discount' FROM l WHERE NOT coalesce(l_discount BETWEEN 0 AND 0.09, false)
      UNION ALL SELECT l_orderkey, l_linenumber, 'flag' FROM l WHERE NOT coalesce(l_returnflag IN ('A', 'N', 'R'), false)""",
    "diarization_rules": f"""WITH {TURNS} SELECT part_id, concat_ws(',', CASE WHEN max(speaker) + 1 <> count(DISTINCT speaker) THEN 'speakers' END, CASE WHEN min(end_ms - start_ms) <= 0 OR min(start_ms) < 0 THEN 'bounds' END, CASE WHEN count(DISTINCT (start_ms, end_ms, speaker)) < count(*) THEN 'repeated' END) AS violations FROM turns GROUP BY part_id""",
    "canonical_documents": """WITH j AS (SELECT doc_id, '{"doc_id":' || doc_id || ',"ids":[' || doc_id || '],"quality":' || CASE WHEN doc_id % 7 > 0 THEN coalesce(quality::VARCHAR, 'null') ELSE 'null' END || ',"toxic":' || coalesce(toxic::VARCHAR, 'null') || '}' AS json FROM labels)
      SELECT doc_id, json, true AS exact, sha256(json) AS sha256 FROM j""",
    "stream_dedup": "SELECT event_id, user_id, event_type FROM events",
    "stream_state": "SELECT user_id, count(*) AS n_events, round(sum(value), 4) AS total FROM events GROUP BY user_id",
}
