"""DuckDB SQL of the ordered folds: window functions and recursion over the same tables."""

from __future__ import annotations

from . import oracles as o
from .more import ORACLES

__all__ = ["ORACLES"]

#: The longest monologue of each minute: stretches open where a real turn changes the holder of the floor.
ORACLES["monologue_runs"] = f"""WITH {o.TURNS}, m AS (SELECT DISTINCT part_id, unnest(range(start_ms // 60000, (end_ms - 1) // 60000 + 1)) AS k FROM turns),
  g AS (SELECT m.part_id, k * 60000 AS a, (k + 1) * 60000 AS b, start_ms, end_ms, speaker, CASE WHEN end_ms - start_ms >= 1500 THEN speaker END AS real FROM m JOIN turns t ON t.part_id = m.part_id AND t.end_ms > k * 60000 AND t.start_ms < (k + 1) * 60000),
  h AS (SELECT *, last_value(real IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS holder, last_value(real IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held,
    lag(speaker) OVER w AS led_by, lag(greatest(start_ms, a)) OVER w AS led_from FROM g WINDOW w AS (PARTITION BY part_id, a ORDER BY start_ms, end_ms, speaker)),
  q AS (SELECT *, real IS NOT NULL AND (held IS NULL OR held <> speaker) AS opens FROM h),
  s AS (SELECT *, sum(CASE WHEN opens THEN 1 ELSE 0 END) OVER (PARTITION BY part_id, a ORDER BY start_ms, end_ms, speaker ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stretch FROM q),
  r AS (SELECT part_id, a, b, stretch, speaker, min(CASE WHEN opens THEN CASE WHEN held IS NOT NULL AND led_by = speaker THEN led_from ELSE greatest(start_ms, a) END END) AS start_ms, max(least(end_ms, b)) AS end_ms FROM s WHERE stretch > 0 AND speaker = holder GROUP BY ALL)
  SELECT part_id, a, b, speaker, start_ms, end_ms FROM (SELECT *, row_number() OVER (PARTITION BY part_id, a ORDER BY end_ms - start_ms DESC, stretch) AS n FROM r) WHERE n = 1"""

#: Anchors follow from source times alone; starts need the anchor's generated times, which the recursion carries along.
_TIMELINE = f"""{o.TURNS}, u AS (SELECT part_id, start_ms AS s, end_ms AS e, speaker, 500 + turn_id * 137 % 3000 AS len, row_number() OVER (PARTITION BY part_id ORDER BY start_ms, end_ms, turn_id) - 1 AS i FROM turns),
  n AS (SELECT x.part_id, x.i, max((y.s, y.i)) FILTER (y.e > x.s) AS opened, max((y.e, y.i)) FILTER (y.e <= x.s) AS ended FROM u x JOIN u y ON y.part_id = x.part_id AND y.i < x.i GROUP BY ALL),
  f AS (SELECT u.*, CASE WHEN opened IS NOT NULL THEN opened[2] ELSE ended[2] END AS anchor, opened IS NOT NULL AS is_open FROM u LEFT JOIN n USING (part_id, i)),
  k AS (SELECT f.*, p.s AS as_, p.e AS ae FROM f LEFT JOIN u p ON p.part_id = f.part_id AND p.i = f.anchor),
  t AS (SELECT part_id, i, s AS start_ms, s + len AS end_ms, [s] AS begun, [s + len] AS done, MAP {{speaker: s + len}} AS free, CAST('leading' AS VARCHAR) AS relation, CAST(NULL AS BIGINT) AS anchor FROM k WHERE i = 0
    UNION ALL SELECT part_id, i, g, g + len, list_append(begun, g), list_append(done, g + len), map_concat(free, MAP {{speaker: g + len}}), relation, anchor FROM (
      SELECT k.part_id, k.i, k.len, k.speaker, k.anchor, t.begun, t.done, t.free, CASE WHEN NOT is_open THEN 'gap' WHEN k.s = as_ THEN 'simultaneous' ELSE 'overlap' END AS relation,
        greatest(CASE WHEN is_open THEN t.begun[k.anchor + 1] + CAST(round_even((k.s - as_) / (ae - as_)::DOUBLE * (t.done[k.anchor + 1] - t.begun[k.anchor + 1]), 0) AS BIGINT) ELSE t.done[k.anchor + 1] + k.s - ae END, t.start_ms, coalesce(t.free[k.speaker], 0)) AS g
      FROM t JOIN k ON k.part_id = t.part_id AND k.i = t.i + 1))"""
ORACLES["timeline_schedule"] = f"WITH RECURSIVE {_TIMELINE} SELECT part_id, i AS utterance_index, start_ms, end_ms, relation, anchor AS anchor_index FROM t"
ORACLES["timeline_rules"] = f"""WITH RECURSIVE {_TIMELINE}, moved AS (SELECT part_id, i, CASE WHEN i % 13 = 5 THEN start_ms - 1000000 ELSE start_ms END AS s, CASE WHEN i % 17 = 6 THEN start_ms ELSE end_ms END AS e, CASE WHEN i % 11 = 3 THEN i ELSE anchor END AS anchor FROM t),
  b AS (SELECT *, lag(s) OVER (PARTITION BY part_id ORDER BY i) AS before FROM moved)
  SELECT part_id, i AS utterance_index, 'chronological' AS rule FROM b WHERE s < before UNION ALL SELECT part_id, i, 'anchor' FROM b WHERE anchor >= i UNION ALL SELECT part_id, i, 'bounds' FROM b WHERE e <= s"""


def _pieces(most: int) -> str:
    """Groups cut at the gap nearest each middle until no piece is longer; where there is no gap, into even pieces."""
    return f"""{o.GROUPS}, isl AS (SELECT s.part_id, g.start_ms AS g, s.start_ms AS s, s.end_ms AS e, row_number() OVER (PARTITION BY s.part_id, g.start_ms ORDER BY s.start_ms) AS i FROM speech s JOIN groups g ON g.part_id = s.part_id AND s.start_ms >= g.start_ms AND s.end_ms <= g.end_ms),
  gap AS (SELECT *, lead(s) OVER (PARTITION BY part_id, g ORDER BY i) AS nxt FROM isl),
  cut AS (SELECT part_id, g, min(i) AS lo, max(i) AS hi, min(s) AS a, max(e) AS b FROM isl GROUP BY ALL
    UNION ALL SELECT part_id, g, unnest([lo, k + 1]), unnest([k, hi]), unnest([a, sk]), unnest([ek, b]) FROM (
      SELECT c.part_id, c.g, c.lo, c.hi, c.a, c.b, arg_min(y.i, abs(y.e + y.nxt - c.a - c.b) * 1000000 + y.i) AS k, arg_min(y.e, abs(y.e + y.nxt - c.a - c.b) * 1000000 + y.i) AS ek, arg_min(y.nxt, abs(y.e + y.nxt - c.a - c.b) * 1000000 + y.i) AS sk
      FROM cut c JOIN gap y ON y.part_id = c.part_id AND y.g = c.g AND y.i >= c.lo AND y.i < c.hi WHERE c.b - c.a > {most} GROUP BY ALL)),
  piece AS (SELECT part_id, a AS start_ms, b AS end_ms FROM cut WHERE b - a <= {most} UNION ALL SELECT part_id, x, least(x + {most}, b) FROM (SELECT part_id, b, unnest(range(a, b, {most})) AS x FROM cut WHERE b - a > {most} AND lo = hi))"""


ORACLES["recursive_gap_split"] = f"WITH RECURSIVE {_pieces(90_000)} SELECT part_id, start_ms, end_ms FROM piece"
ORACLES["conversation_windows"] = f"""WITH RECURSIVE {_pieces(90_000)}, lim AS (SELECT part_id, max(end_ms) + 100 AS lim FROM turns GROUP BY part_id), p AS (
  SELECT part_id, start_ms, end_ms, 90000 - (end_ms - start_ms) AS room, least(start_ms, 250) AS f, least(lim - end_ms, 250) AS a FROM piece JOIN lim USING (part_id)), h AS (
  SELECT *, least(f, (room + 1) // 2) AS hf, least(a, room // 2) AS ha FROM p), w AS (SELECT *, hf + least(f - hf, room - hf - ha) AS gf FROM h), x AS (
  SELECT part_id, start_ms - gf AS start_ms, end_ms + ha + least(a - ha, room - gf - ha) AS end_ms FROM w)
  SELECT *, row_number() OVER (PARTITION BY part_id ORDER BY start_ms, end_ms) - 1 AS part_index FROM x"""

ORACLES["rendered_tracks"] = """WITH s AS (SELECT l_orderkey AS track_id, CAST(trunc(l_extendedprice / 10) AS BIGINT) AS x FROM lineitem)
  SELECT track_id, CAST(2 * count(*) + 10 AS BIGINT) AS frames, CAST(2 * sum(x) AS BIGINT) AS total FROM s GROUP BY track_id"""
