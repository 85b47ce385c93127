"""SQL text that several oracles share."""

from __future__ import annotations

from vecflow import fixtures


def solution(source: str = "log", passes: int = 5) -> str:
    """CTEs that solve the ordering of a log by passes: ev (events with g_before and late), tk (ticks with g), fs."""
    multi = source == "log_multi"
    out = [fixtures.LOG_MULTI if multi else fixtures.LOG, f"""
tk0 AS (SELECT pchannel, p, vchannel, tso FROM {source} WHERE kind = 'TimeTick'),
e0 AS (SELECT * FROM {source} WHERE kind <> 'TimeTick'),
fs0 AS (SELECT pchannel, vchannel, min(p) AS p0, arg_min(kind <> 'TimeTick', p) AS by_event FROM {source} WHERE vchannel IS NOT NULL GROUP BY ALL)"""]
    for i in range(passes + 1):
        out.append(f"""
gr{i} AS (
  SELECT t.pchannel, t.p, s.vchannel AS vc, t.p >= s.p0 AS live,
         max(CASE WHEN t.vchannel = s.vchannel THEN t.tso WHEN t.vchannel IS NULL AND (t.p > s.p0 OR s.by_event) THEN t.tso END)
           OVER (PARTITION BY t.pchannel, s.vchannel ORDER BY t.p) AS level
  FROM tk0 t JOIN fs{i} s ON t.pchannel = s.pchannel
),
wm{i} AS (
  SELECT t.pchannel, t.p, t.vchannel, t.tso, max(coalesce(m.w, CASE WHEN t.vchannel IS NULL THEN t.tso ELSE 0 END)) OVER (PARTITION BY t.pchannel ORDER BY t.p) AS g
  FROM tk0 t LEFT JOIN (SELECT pchannel, p, min(coalesce(level, 0)) AS w FROM gr{i} WHERE live GROUP BY ALL) m ON t.pchannel = m.pchannel AND t.p = m.p
),
ev{i} AS (
  SELECT * EXCLUDE (gb), gb AS g_before, coalesce(gb > 0 AND tso <= gb, false) AS late
  FROM (SELECT e0.*, w.g AS gb FROM e0 ASOF LEFT JOIN wm{i} w ON e0.pchannel = w.pchannel AND e0.p > w.p)
)""")
        if i < passes:
            out.append(f"""
fs{i + 1} AS (
  SELECT pchannel, vchannel, min(p) AS p0, arg_min(k, p) AS by_event
  FROM (SELECT pchannel, vchannel, p, true AS k FROM ev{i} WHERE NOT late UNION ALL SELECT pchannel, vchannel, p, false FROM tk0 WHERE vchannel IS NOT NULL) GROUP BY ALL
)""")
    out.append(f"""
gr AS (SELECT * FROM gr{passes}), wm AS (SELECT * FROM wm{passes}), ev AS (SELECT * FROM ev{passes}), fs AS (SELECT * FROM fs{passes}),
rel AS (
  SELECT e.*, w.p AS release_p FROM (SELECT * FROM ev WHERE NOT late) e
  ASOF LEFT JOIN (SELECT pchannel, g, min(p) AS p FROM wm GROUP BY ALL) w ON e.pchannel = w.pchannel AND e.tso <= w.g
),
done AS (
  SELECT *, row_number() OVER (PARTITION BY pchannel ORDER BY tso, CASE kind WHEN 'Delete' THEN 0 ELSE 1 END, p) AS seq FROM rel WHERE release_p IS NOT NULL
)""")
    return "WITH " + ",".join(out)


def on(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)
