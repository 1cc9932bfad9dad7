"""DuckDB SQL of the queries over time, written independently of the Spark expressions."""

from patentflow.plans.event_queries import (
    DELAYED_PART,
    DELAYED_PARTS,
    DELIVERIES,
    FRAME_ROWS,
    GAP_HOURS,
    HOUR,
)

_GAP = GAP_HOURS * HOUR

# Micros of the watermark, of which milliseconds count: two days behind the latest time.
_MARK = "epoch_us(max(ts)) // 1000 * 1000 - 2 * 24 * 3600000000"

_EVENTS = f"""
e AS (SELECT event_id, user_id, event_type, ts, epoch_us(ts) AS us, CAST(round(value * 100) AS bigint) AS cents,
  CAST(least((day(ts) - 1) // 10, {DELIVERIES - 1}) AS bigint) AS own FROM events),
d AS (SELECT *, CASE WHEN event_id % {DELAYED_PARTS} = {DELAYED_PART} THEN least(own + 1, {DELIVERIES - 1})
  ELSE own END AS delivery FROM e)"""


def _windows(width_hours: int, slide_hours: int) -> str:
    slide, width = slide_hours * 3600, width_hours * 3600
    return f"""
WITH {_EVENTS},
marks AS (SELECT delivery, max(ts) AS latest FROM d GROUP BY delivery),
known AS (SELECT a.delivery, {_MARK.replace("ts", "b.latest")} AS mark
  FROM marks AS a JOIN marks AS b ON b.delivery < a.delivery GROUP BY a.delivery),
w AS (SELECT d.*, us // 1000000 // {slide} * {slide} - i * {slide} AS start,
  us // 1000000 // {slide} * {slide} - i * {slide} + {width} AS "end" FROM d, range({width // slide}) AS r(i)),
kept AS (SELECT w.* FROM w LEFT JOIN known USING (delivery)
  WHERE us < "end" * 1000000 AND (mark IS NULL OR "end" * 1000000 > mark))
SELECT start, "end", event_type, count(*) AS n_events, CAST(sum(cents) AS bigint) AS cents FROM kept
WHERE "end" * 1000000 <= (SELECT {_MARK} FROM e)
GROUP BY start, "end", event_type"""


_SESSIONS = f"""
WITH {_EVENTS},
gaps AS (SELECT *, coalesce(us - lag(us) OVER (PARTITION BY user_id ORDER BY us) > {_GAP}, true) AS is_first FROM e),
runs AS (SELECT *, sum(is_first::int) OVER (PARTITION BY user_id ORDER BY us, event_id) AS nth FROM gaps),
found AS (SELECT user_id, nth, min(us) AS first_at, max(us) AS last_at, count(*) AS n_events,
  CAST(sum(cents) AS bigint) AS cents FROM runs GROUP BY user_id, nth)"""



def _totals(sets: str) -> str:
    return f"""
WITH {_EVENTS},
x AS (SELECT nullif(event_type, 'error') AS kind, CAST(day(ts) AS int) AS "day", CAST(hour(ts) AS int) AS "hour", cents FROM e)
SELECT kind, "day", "hour", CAST(grouping_id(kind, "day", "hour") AS bigint) AS level, count(*) AS n_rows,
  CAST(sum(cents) AS bigint) AS cents FROM x GROUP BY {sets}"""


def _frame(names: str, frame: str) -> str:
    n, total, most = names.split()
    return f"""
WITH {_EVENTS}
SELECT event_id, user_id, count(*) OVER w AS {n}, CAST(sum(cents) OVER w AS bigint) AS {total}, max(cents) OVER w AS {most}
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY {frame})"""


ORACLES: dict[str, str] = {
    "stream_tumbling": _windows(1, 1),
    "stream_sliding": _windows(6, 2),
    "stream_sessions": f"""{_SESSIONS}
SELECT first_at AS start, last_at + {_GAP} AS "end", user_id, n_events, cents FROM found
WHERE last_at + {_GAP} <= (SELECT {_MARK} FROM e)""",
    "stream_dedup": f"WITH {_EVENTS} SELECT event_id, user_id, event_type, cents FROM e",
    "session_windows": f"{_SESSIONS} SELECT user_id, first_at, last_at, n_events, cents FROM found",
    "join_asof": f"""
WITH {_EVENTS},
p AS (SELECT * FROM e WHERE event_type = 'purchase'), v AS (SELECT * FROM e WHERE event_type = 'view')
SELECT p.event_id, p.user_id, p.cents, v.event_id AS view_id, p.us - v.us AS waited
FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.us >= v.us""",
    "join_interval": f"""
WITH {_EVENTS},
v AS (SELECT *, us + cents // 5 * 60000000 AS stop FROM e WHERE event_type = 'view'),
x AS (SELECT *, us + cents // 2 * 60000000 AS stop FROM e WHERE event_type = 'error')
SELECT v.user_id, v.event_id AS view_id, x.event_id AS error_id, least(v.stop, x.stop) - greatest(v.us, x.us) AS shared
FROM v JOIN x ON v.user_id = x.user_id AND v.us < x.stop AND x.us < v.stop AND v.us < v.stop AND x.us < x.stop""",
    "agg_grouping_sets": _totals('GROUPING SETS ((kind, "day"), ("hour"), ())'),
    "agg_rollup": _totals('ROLLUP (kind, "day", "hour")'),
    "agg_cube": _totals('CUBE (kind, "day", "hour")'),
    "window_running": f"""
WITH {_EVENTS}
SELECT event_id, user_id, row_number() OVER w AS nth, CAST(sum(cents) OVER w AS bigint) AS running_cents
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)""",
    "window_trailing_rows": _frame(
        "n_last sum_last max_last", f"us, event_id ROWS BETWEEN {FRAME_ROWS - 1} PRECEDING AND CURRENT ROW"
    ),
    "window_trailing_range": _frame(
        "n_day sum_day max_day", "us RANGE BETWEEN 86400000000 PRECEDING AND CURRENT ROW"
    ),
    "json_props": """
WITH x AS (
  SELECT event_id, CASE event_id % 10 WHEN 1 THEN substr(props, 1, length(props) - 1) WHEN 2 THEN replace(props, ': ', ': "x')
    WHEN 3 THEN '{"k": "word"}' WHEN 4 THEN '{"other": [1, 2]}' WHEN 5 THEN '' WHEN 6 THEN NULL ELSE props END AS props
  FROM events)
SELECT event_id, CASE WHEN json_valid(props) AND event_id % 10 <> 3 THEN CAST(json_extract_string(props, '$.k') AS bigint) END AS k,
  event_id % 10 NOT IN (5, 6) AS is_read, CASE WHEN event_id % 10 IN (1, 2, 3, 5) THEN props END AS rejected
FROM x""",
}
