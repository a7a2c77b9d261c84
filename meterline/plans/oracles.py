"""SQL twins of the registered queries, written independently for DuckDB.

Times are compared as whole micro- or milliseconds. ``epoch_us(x) // 1000`` is used for
milliseconds because ``epoch_ms`` rounds.
"""

from __future__ import annotations

_RIDES = """
rides AS (
  SELECT md5(CAST(user_id AS VARCHAR)) AS ride_id,
         event_id AS message_id,
         1704067200000000 + (epoch_us(ts) - 1704067200000000) // 720 AS event_us,
         40.60::DOUBLE + (event_id * 7919 % 30000) / 100000.0::DOUBLE AS latitude,
         -74.10::DOUBLE + (event_id * 104729 % 30000) / 100000.0::DOUBLE AS longitude,
         CAST(value AS DOUBLE) AS meter_increment,
         event_id * 31 % 10000 / 100.0::DOUBLE AS meter_reading, event_id AS point_idx,
         CASE event_type WHEN 'signup' THEN 'pickup' WHEN 'purchase' THEN 'dropoff' ELSE 'enroute' END AS ride_status,
         CAST(1 + event_id % 6 AS INT) AS passenger_count,
         (1704067200000000 + (epoch_us(ts) - 1704067200000000) // 720) // 1000
           + CASE WHEN event_id % 10 = 3 THEN event_id * 7919 % 480000 ELSE 0 END AS arrival_ms
  FROM events)"""


def _with(*parts: str, recursive: bool = False) -> str:
    body = ",\n".join([_RIDES.strip(), *[p.strip() for p in parts]])
    return f"WITH {'RECURSIVE ' if recursive else ''}{body}\n"


def _iso(ms: str) -> str:
    return (
        f"strftime(make_timestamp(({ms}) * 1000), '%Y-%m-%dT%H:%M:%S')"
        f" || CASE WHEN ({ms}) % 1000 = 0 THEN '' ELSE '.' || lpad(CAST(({ms}) % 1000 AS VARCHAR), 3, '0') END || 'Z'"
    )


def _cell(x: str, edge: str = "0.005") -> str:
    e = f"CAST({edge} AS FLOAT)"
    low = f"CAST(CAST(floor(CAST(CAST({x} AS FLOAT) / {e} AS FLOAT)) AS FLOAT) * {e} AS FLOAT)"
    return f"CAST(CAST({low} + CAST({e} / CAST(2 AS FLOAT) AS FLOAT) AS FLOAT) AS DOUBLE)"


def _money(x: str) -> str:
    return f"CAST(SUM(CAST({x} AS DECIMAL(18,6))) AS DOUBLE)"


def _cents(x: str) -> str:
    # DECIMAL rounds halves away from zero
    cents = f"CAST(CAST(CAST(abs({x}) AS VARCHAR) AS DECIMAL(38,12)) AS DECIMAL(38,2))"
    return f"(CASE WHEN {x} < 0 THEN '-' ELSE '' END || '$' || format('{{:,.2f}}', CAST({cents} AS DOUBLE)))"


_PLAIN = (
    "ride_id, message_id, event_us, event_us AS payload_us, latitude, longitude, meter_reading, meter_increment, ride_status,"
    " passenger_count, point_idx, arrival_ms"
)
_F32LAT = "CAST(CAST(latitude AS FLOAT) AS DOUBLE)"
_F32LON = "CAST(CAST(longitude AS FLOAT) AS DOUBLE)"
_BOX = (
    f"{_F32LON} > -74.747::DOUBLE AND {_F32LON} < -73.969::DOUBLE"
    f" AND {_F32LAT} > 40.699::DOUBLE AND {_F32LAT} < 40.720::DOUBLE"
)

_CELLS = f"""
cells AS (
  SELECT event_us // 1000000 * 1000000 AS window_start_us, event_us // 1000000 * 1000000 + 1000000 AS window_end_us,
         {_cell('latitude')} AS latitude, {_cell('longitude')} AS longitude, COUNT(*) AS ntaxis
  FROM rides GROUP BY ALL)"""

_CLOCKS = f"""
clocks AS (
  SELECT event_us // 1000000 * 1000000 AS window_start_us, event_us // 1000000 * 1000000 + 1000000 AS window_end_us,
         MAX(event_us // 1000) AS max_ts_ms
  FROM rides GROUP BY ALL)"""

_RATES = f"""
rates AS (
  SELECT s - k * 3000000 AS window_start_us, s - k * 3000000 + 60000000 AS window_end_us,
         {_money('meter_increment')} AS dollar_run_rate_per_minute
  FROM (SELECT event_us // 3000000 * 3000000 AS s, meter_increment FROM rides), range(20) AS r(k)
  GROUP BY ALL)"""

# watermark: greatest event time of strictly earlier arrival milliseconds
_CLASSED = """
marks AS (
  SELECT arrival_ms, MAX(m) OVER (ORDER BY arrival_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark_us
  FROM (SELECT arrival_ms, MAX(event_us) AS m FROM rides GROUP BY arrival_ms)),
classed AS (
  SELECT *, CASE WHEN watermark_us IS NULL OR window_start_us + 60000000 > watermark_us THEN 'ON_TIME'
                 WHEN window_start_us + 360000000 > watermark_us THEN 'LATE' ELSE 'DROPPED' END AS lateness
  FROM (SELECT r.*, event_us // 60000000 * 60000000 AS window_start_us, watermark_us
        FROM rides r JOIN marks USING (arrival_ms)))"""

_PANES = """
steps AS (
  SELECT window_start_us, CASE WHEN lateness = 'ON_TIME' THEN 0 ELSE arrival_ms END AS pane_order,
         SUM(CAST(meter_increment AS DECIMAL(18,6))) AS d
  FROM classed WHERE lateness <> 'DROPPED' GROUP BY ALL),
panes AS (
  SELECT window_start_us, pane_order, CASE WHEN pane_order = 0 THEN 'ON_TIME' ELSE 'LATE' END AS dollar_timing,
         CAST(SUM(d) OVER (PARTITION BY window_start_us ORDER BY pane_order
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS dollar_turnover,
         (window_start_us // 1000) / 1000.0::DOUBLE / 60.0::DOUBLE AS dollar_window
  FROM steps)"""


def _sessions(gap_us: int) -> str:
    return f"""
sess AS (
  SELECT *, SUM(opens) OVER (PARTITION BY ride_id ORDER BY event_us, message_id ROWS UNBOUNDED PRECEDING) AS s
  FROM (SELECT *, CASE WHEN event_us - LAG(event_us) OVER (PARTITION BY ride_id ORDER BY event_us, message_id) >= {gap_us}
                       OR LAG(event_us) OVER (PARTITION BY ride_id ORDER BY event_us, message_id) IS NULL
                  THEN 1 ELSE 0 END AS opens FROM rides)),
spans AS (
  SELECT ride_id, s, MIN(event_us) AS session_start_us, MAX(event_us) + {gap_us} AS session_end_us, COUNT(*) AS n_points
  FROM sess GROUP BY ALL)"""


def _picked(gap_us: int, order: str, where: str = "TRUE") -> tuple[str, str]:
    return _sessions(gap_us), f"""
picked AS (
  SELECT ride_id, session_start_us, session_end_us, {_F32LAT} AS latitude, {_F32LON} AS longitude,
         {_iso('event_us // 1000')} AS timestamp, ride_status, message_id
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY ride_id, s ORDER BY {order}) AS rn
        FROM sess WHERE {where}) JOIN spans USING (ride_id, s)
  WHERE rn = 1)"""


def _in_time(gap_us: int, order: str, where: str = "TRUE") -> tuple[str, ...]:
    """The same over the rows whose own session is open for the watermark that they meet."""
    sessions, picked = _picked(gap_us, order, where)
    return f"""
marks AS (
  SELECT arrival_ms, MAX(m) OVER (ORDER BY arrival_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS watermark_us
  FROM (SELECT arrival_ms, MAX(event_us) AS m FROM rides GROUP BY arrival_ms)),
in_time AS (
  SELECT r.* FROM rides r JOIN marks USING (arrival_ms) WHERE watermark_us IS NULL OR event_us + {gap_us} > watermark_us)""", sessions.replace(
        "FROM rides", "FROM in_time"
    ), picked


_NEWEST = "event_us // 1000 DESC, message_id"
_OLDEST = "event_us // 1000, message_id"
_IS_PICKUP = "ride_status = 'pickup'"

_DELIVERIES = """
deliveries AS (
  SELECT ride_id, message_id, ride_status AS feed_id, arrival_ms FROM rides
  UNION ALL
  SELECT ride_id, message_id, ride_status, arrival_ms + CAST(trunc(meter_increment * 100) AS BIGINT)
  FROM rides WHERE passenger_count >= 5
  UNION ALL
  SELECT ride_id, message_id, ride_status, arrival_ms + 40000 FROM rides WHERE passenger_count >= 5)"""

_DUPLICATES = """
arrivals AS (SELECT message_id, feed_id, arrival_ms, COUNT(*) AS copies FROM deliveries GROUP BY ALL),
starts AS (
  SELECT message_id, MIN(arrival_ms) AS s FROM arrivals GROUP BY message_id
  UNION ALL
  SELECT a.message_id, MIN(a.arrival_ms) FROM arrivals a JOIN starts USING (message_id)
  WHERE a.arrival_ms > s + 30000 GROUP BY a.message_id),
flagged AS (
  SELECT a.*, copies - CASE WHEN s IS NULL THEN 0 ELSE 1 END AS duplicates
  FROM arrivals a LEFT JOIN starts st ON a.message_id = st.message_id AND a.arrival_ms = st.s)"""

_HEALTH = """
batches AS (
  SELECT feed_id, arrival_ms // 5000 AS batch_id, CAST(SUM(copies) AS BIGINT) AS n_messages,
         CAST(SUM(duplicates) AS BIGINT) AS n_duplicates
  FROM flagged GROUP BY ALL),
framed AS (
  SELECT *, SUM(n_messages) OVER w AS m, SUM(n_duplicates) OVER w AS d,
         AVG(CASE WHEN n_messages = 9 THEN 1.0 ELSE 0.0 END) OVER w AS sat,
         (MAX(batch_id) OVER w - MIN(batch_id) OVER w) * 5000 AS span,
         (batch_id - LAG(batch_id) OVER (PARTITION BY feed_id ORDER BY batch_id)) * 5000 AS idle_ms
  FROM batches WINDOW w AS (PARTITION BY feed_id ORDER BY batch_id ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)),
rated AS (
  SELECT *, floor(CAST(m AS DOUBLE) / (CASE WHEN span = 0 THEN 1.0::DOUBLE ELSE span / 1000.0::DOUBLE END) * 10.0::DOUBLE + 0.5)
            / 10.0::DOUBLE AS r
  FROM framed),
health AS (
  SELECT feed_id, batch_id, n_messages, n_duplicates,
         CASE WHEN r >= 1 THEN floor(r + 0.5) ELSE r END AS data_rate, idle_ms,
         COALESCE(idle_ms > 6000, TRUE) AS was_silent,
         CASE WHEN r = 0 THEN 'none' WHEN d > 0 THEN 'severe' WHEN sat > 0.5 THEN 'overload' ELSE 'ok' END AS status
  FROM rated)"""

_BATCHED = "batched AS (SELECT *, arrival_ms // 250 AS batch_id FROM rides)"

_HEAT = """
instants AS (SELECT UNNEST(range(lo // 5000 * 5000, hi + 200000, 5000)) AS as_of_ms
             FROM (SELECT MIN(arrival_ms) AS lo, MAX(arrival_ms) AS hi FROM rides)),
ride_marks AS (
  SELECT *, 6 - ROW_NUMBER() OVER w
           - GREATEST(0, (as_of_ms - LEAST(COALESCE(LAG(batch_id * 250) OVER w, batch_id * 250 + 5000), batch_id * 250 + 5000)) // 250)
           AS weight
  FROM (SELECT DISTINCT ride_id, batch_id, as_of_ms FROM batched
        JOIN instants ON as_of_ms >= batch_id * 250 AND as_of_ms < batch_id * 250 + 20000)
  WINDOW w AS (PARTITION BY as_of_ms, ride_id ORDER BY batch_id DESC)),
cell_marks AS (
  SELECT as_of_ms, window_end_us, latitude, longitude,
         list_reduce(list_prepend(CAST(5 * ntaxis AS BIGINT),
                     range(GREATEST(0, (as_of_ms - window_end_us // 1000) // 250 - 20))), lambda w, i: 4 * w // 5) AS weight
  FROM cells JOIN instants ON as_of_ms >= window_end_us // 1000 AND as_of_ms < window_end_us // 1000 + 30000)"""


# a tick's limit follows from the heaviest cell before its fade; culled cells, far below the heaviest, set none
_CULLED = """
, cell_ticks AS (
  SELECT c.*, tick, list_reduce(list_prepend(CAST(5 * ntaxis AS BIGINT),
           range(GREATEST(0, (tick - window_end_us // 1000) // 250 - 20))), lambda w, i: 4 * w // 5) AS weight
  FROM cells c, (SELECT UNNEST(range(0, 30000, 250)) AS age), LATERAL (SELECT window_end_us // 1000 + age AS tick)),
limits AS (SELECT tick + 250 AS tick, MAX(weight) // 20 AS weak FROM cell_ticks WHERE weight >= 20 GROUP BY tick),
ride_ticks AS (
  SELECT *, 6 - ROW_NUMBER() OVER w
           - GREATEST(0, (tick - LEAST(COALESCE(LAG(batch_id * 250) OVER w, batch_id * 250 + 5000), batch_id * 250 + 5000)) // 250)
           AS weight
  FROM (SELECT DISTINCT ride_id, batch_id, tick, weak FROM batched
        JOIN limits ON tick >= batch_id * 250 AND tick < batch_id * 250 + 20000)
  WINDOW w AS (PARTITION BY tick, ride_id ORDER BY batch_id DESC)),
gone_rides AS (SELECT ride_id, batch_id, MIN(tick) AS gone FROM ride_ticks WHERE tick > batch_id * 250 AND weight <= weak GROUP BY ALL),
gone_cells AS (
  SELECT window_end_us, latitude, longitude, MIN(tick) AS gone FROM cell_ticks JOIN limits USING (tick)
  WHERE tick > window_end_us // 1000 AND weight <= weak GROUP BY ALL)
SELECT m.as_of_ms, b.ride_id, b.message_id, b.latitude, b.longitude, m.weight
FROM batched b JOIN ride_marks m ON b.ride_id = m.ride_id AND b.batch_id = m.batch_id
  LEFT JOIN gone_rides g ON g.ride_id = b.ride_id AND g.batch_id = b.batch_id
WHERE m.weight > 0 AND (gone IS NULL OR m.as_of_ms < gone)
UNION ALL
SELECT as_of_ms, NULL, NULL, c.latitude, c.longitude, weight
FROM cell_marks c LEFT JOIN gone_cells g
  ON g.window_end_us = c.window_end_us AND g.latitude = c.latitude AND g.longitude = c.longitude
WHERE weight > 0 AND (gone IS NULL OR as_of_ms < gone)"""

_BUNDLES = f"""
cells AS (
  SELECT event_us // 10000000 * 10000000 AS window_start_us, event_us // 10000000 * 10000000 + 10000000 AS window_end_us,
         {_cell('latitude', '0.2')} AS latitude, {_cell('longitude', '0.2')} AS longitude, COUNT(*) AS ntaxis
  FROM rides GROUP BY ALL)"""


def _bundle(n: int) -> str:
    return _with(_CELLS) + f"""
SELECT window_start_us, latitude, longitude, ntaxis, ROW_NUMBER() OVER o - 1 AS cell_index,
       CAST(SUM(ntaxis) OVER f AS DOUBLE) / CAST(COUNT(*) OVER f AS DOUBLE) AS avg_ntaxis
FROM cells
WINDOW o AS (ORDER BY window_start_us, latitude, longitude),
       f AS (ORDER BY window_start_us, latitude, longitude ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"""


_INDEXED = """
seen AS (
  SELECT *, FIRST_VALUE(point_idx) OVER o AS origin,
         COALESCE(MAX(CASE WHEN ride_status = 'dropoff' THEN 1 ELSE 0 END)
                  OVER (PARTITION BY ride_id ORDER BY arrival_ms, message_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS after_done
  FROM rides
  WINDOW o AS (PARTITION BY ride_id ORDER BY arrival_ms, message_id))"""

_SPLIT = """
parts AS (
  SELECT ride_id, message_id, arrival_ms // 60000 AS minute, CAST(LEAST(passenger_count, 5) AS BIGINT) AS weight FROM rides),
held AS (SELECT * FROM parts WHERE minute < (SELECT MAX(minute) FROM parts)),
arrived AS (SELECT * FROM parts WHERE minute = (SELECT MAX(minute) FROM parts))"""

# a replay delivers twelve equal spans of arrival time, one after the other
_REPLAYED = """
ends AS (SELECT MIN(arrival_ms) AS lo, MAX(arrival_ms) AS hi FROM rides),
numbered AS (SELECT r.*, (arrival_ms - lo) * 12 // (hi - lo + 1) AS k FROM rides r, ends),
tops AS (SELECT k, MAX(event_us) // 1000 * 1000 AS top FROM numbered GROUP BY k),
seen_tops AS (SELECT b.k, (SELECT MAX(top) FROM tops t WHERE t.k < b.k) AS mark,
                     (SELECT MAX(top) FROM tops t WHERE t.k < b.k - 1) AS late_mark FROM range(12) AS b(k))"""


def _kept(width_us: int) -> str:
    """Rows whose window was open when their micro-batch came; Spark judges them by the watermark of the batch before."""
    end = f"event_us // {width_us} * {width_us} + {width_us}"
    return f"""
{_REPLAYED.strip()},
all_rides AS (SELECT * FROM rides),
kept AS (SELECT n.* FROM numbered n JOIN seen_tops USING (k) WHERE late_mark IS NULL OR {end} > late_mark)"""


def _on_kept(width_us: int, part: str) -> tuple[str, str]:
    """A part that reads only the rows that a stream without delay keeps."""
    return _kept(width_us), part.replace("FROM rides", "FROM kept")


_POINT = "ride_id, session_start_us, session_end_us, latitude, longitude, timestamp, ride_status, message_id"


def _session_panes(gap_us: int, order: str, where: str = "TRUE") -> str:
    """Per micro-batch an early pane of every session that it changed, as it is then; one on-time pane of each in the end."""
    return _with(*_picked(gap_us, order, where), _REPLAYED) + f"""
, so_far AS (SELECT b.k AS now, n.* FROM numbered n JOIN range(12) AS b(k) ON n.k <= b.k),
opened AS (
  SELECT *, CASE WHEN event_us - LAG(event_us) OVER w >= {gap_us} OR LAG(event_us) OVER w IS NULL THEN 1 ELSE 0 END AS opens
  FROM so_far WINDOW w AS (PARTITION BY now, ride_id ORDER BY event_us, message_id)),
placed AS (SELECT *, SUM(opens) OVER (PARTITION BY now, ride_id ORDER BY event_us, message_id ROWS UNBOUNDED PRECEDING) AS s FROM opened),
lengths AS (
  SELECT now, ride_id, s, MIN(event_us) AS session_start_us, MAX(event_us) + {gap_us} AS session_end_us FROM placed
  GROUP BY ALL HAVING MAX(k) = now),
firsts AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY now, ride_id, s ORDER BY {order}) AS rn FROM placed WHERE {where})
SELECT ride_id, session_start_us, session_end_us, {_F32LAT} AS latitude, {_F32LON} AS longitude,
       {_iso('event_us // 1000')} AS timestamp, ride_status, message_id, 'EARLY' AS pane_timing
FROM firsts JOIN lengths USING (now, ride_id, s) WHERE rn = 1
UNION ALL SELECT {_POINT}, 'ON_TIME' FROM picked"""


_WINDOW_SUMS = f"""
sums AS (
  SELECT event_us // 60000000 * 60000000 AS window_start_us, {_money('meter_increment')} AS dollar_turnover,
         (event_us // 60000000 * 60000) / 1000.0::DOUBLE / 60.0::DOUBLE AS dollar_window
  FROM rides GROUP BY ALL)"""

_TOPIC = f"""
topic AS (
  SELECT ride_id, {_iso('event_us // 1000')} AS timestamp, NULL AS dollar_timing, NULL::BIGINT AS ntaxis, latitude, longitude,
         NULL::DOUBLE AS dollar_run_rate_per_minute, NULL::DOUBLE AS dollar_turnover, NULL::DOUBLE AS dollar_window FROM rides
  UNION ALL SELECT NULL, NULL, NULL, ntaxis, latitude, longitude, NULL, NULL, NULL FROM cells
  UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, dollar_run_rate_per_minute, NULL, NULL FROM rates
  UNION ALL SELECT NULL, NULL, dollar_timing, NULL, NULL, NULL, NULL, dollar_turnover, dollar_window FROM panes
  UNION ALL SELECT NULL, {_iso('max_ts_ms')}, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM clocks)"""

ORACLES: dict[str, str] = {
    "all_rides": _with() + f"SELECT {_PLAIN} FROM rides",
    "filter_box": _with() + f"SELECT {_PLAIN} FROM rides WHERE {_BOX}",
    "filter_prefix": _with() + f"SELECT {_PLAIN} FROM rides WHERE ride_id LIKE 'a%'",
    "reject_split": _with()
    + """
SELECT message_id, verdict, CASE WHEN verdict = 'good' THEN latitude END AS latitude,
       CASE WHEN verdict = 'good' THEN event_us // 1000 END AS ts_ms,
       CASE WHEN verdict = 'good' THEN meter_increment END AS meter_increment
FROM (SELECT *, CASE WHEN ride_status <> 'dropoff' THEN 'good'
                     WHEN passenger_count = 6 THEN CASE message_id // 6 % 6 WHEN 0 THEN 'bad latitude' WHEN 1 THEN 'bad latitude'
                       WHEN 2 THEN 'bad longitude' WHEN 3 THEN 'bad meter_increment' WHEN 4 THEN 'bad meter_increment' ELSE 'good' END
                     WHEN passenger_count = 1 THEN 'missing latitude' WHEN passenger_count = 2 THEN 'bad timestamp'
                     WHEN passenger_count = 3 THEN 'bad meter_increment' WHEN passenger_count = 5 THEN 'malformed'
                     ELSE 'missing ride_id' END AS verdict FROM rides)""",
    "grid_cells": _with()
    + f"SELECT message_id, {_cell('latitude')} AS latitude, {_cell('longitude')} AS longitude FROM rides",
    "max_timestamp": _with(_CLOCKS) + f"SELECT *, {_iso('max_ts_ms')} AS timestamp FROM clocks",
    "count_cells": _with(_CELLS) + "SELECT * FROM cells",
    "run_rate": _with(_RATES) + "SELECT * FROM rates",
    "run_rate_direct": _with(_RATES) + "SELECT * FROM rates",
    "exact_turnover": _with(_CLASSED)
    + f"""
SELECT window_start_us, {_money('meter_increment')} AS dollar_turnover, COUNT(*) AS n_points,
       (window_start_us // 1000) / 1000.0::DOUBLE / 60.0::DOUBLE AS dollar_window
FROM classed WHERE lateness <> 'DROPPED' GROUP BY window_start_us""",
    "turnover_panes": _with(_CLASSED, _PANES) + "SELECT * FROM panes",
    "lateness_rows": _with(_CLASSED) + "SELECT message_id, window_start_us, watermark_us, lateness FROM classed",
    "lateness_classes": _with(_CLASSED)
    + f"SELECT window_start_us, lateness, COUNT(*) AS n_points, {_money('meter_increment')} AS dollars FROM classed GROUP BY ALL",
    "latest_points": _with(*_in_time(3_600_000_000, _NEWEST)) + "SELECT * FROM picked",
    "latest_points_minute_gap": _with(*_in_time(60_000_000, _NEWEST)) + "SELECT * FROM picked",
    "pickup_points": _with(*_in_time(60_000_000, _OLDEST, _IS_PICKUP)) + "SELECT * FROM picked",
    "session_spans": _with(_sessions(60_000_000))
    + "SELECT ride_id, session_start_us, session_end_us, n_points FROM spans",
    "message_topic": _with(_CELLS, _CLOCKS, _RATES, _CLASSED, _PANES, _TOPIC) + "SELECT * FROM topic",
    "route_messages": _with(_CELLS, _CLOCKS, _RATES, _CLASSED, _PANES, _TOPIC)
    + """
SELECT 'ride' AS kind, * FROM topic WHERE ride_id IS NOT NULL
UNION ALL SELECT 'cell', * FROM topic WHERE ntaxis IS NOT NULL
UNION ALL SELECT 'rate', * FROM topic WHERE dollar_run_rate_per_minute IS NOT NULL
UNION ALL SELECT 'pane', * FROM topic WHERE dollar_turnover IS NOT NULL
UNION ALL SELECT 'clock', * FROM topic WHERE timestamp IS NOT NULL""",
    "ride_trails": _with(_BATCHED)
    + """
SELECT ride_id, batch_id, message_id, 6 - k AS weight
FROM (SELECT *, DENSE_RANK() OVER (PARTITION BY ride_id ORDER BY batch_id DESC) AS k FROM batched) WHERE k <= 5""",
    "trail_updated": _with(_SPLIT) + "SELECT * FROM held WHERE ride_id IN (SELECT ride_id FROM arrived)",
    "trail_other": _with(_SPLIT) + "SELECT * FROM held WHERE ride_id NOT IN (SELECT ride_id FROM arrived)",
    "trail_merge": _with(_SPLIT)
    + """
SELECT ride_id, message_id, minute, weight - 1 AS weight FROM held
WHERE ride_id IN (SELECT ride_id FROM arrived) AND weight > 1
UNION ALL SELECT ride_id, message_id, minute, weight FROM held WHERE ride_id NOT IN (SELECT ride_id FROM arrived)
UNION ALL SELECT ride_id, message_id, minute, 5 FROM arrived""",
    "heat_weights": _with(_CELLS, _BATCHED, _HEAT) + _CULLED,
    "heat_weights_bundles": _with(_BUNDLES, _BATCHED, _HEAT) + _CULLED,
    "cell_weights": _with(
        f"""
wide AS (
  SELECT event_us // 600000000 * 600000000 AS window_start_us, {_cell('latitude', '0.02')} AS latitude,
         {_cell('longitude', '0.02')} AS longitude, COUNT(*) AS ntaxis, 5 * COUNT(*) AS weight
  FROM rides GROUP BY 1, 2, 3)"""
    )
    + "SELECT * FROM wide WHERE weight > (SELECT MAX(weight) // 2 FROM wide)",
    "flag_duplicates": _with(_DELIVERIES, _DUPLICATES, recursive=True)
    + "SELECT message_id, arrival_ms, copies, duplicates FROM flagged",
    "duplicates_per_batch": _with(_DELIVERIES, _DUPLICATES, recursive=True)
    + """
SELECT arrival_ms // 250 AS batch_id, CAST(SUM(copies) AS BIGINT) AS n_messages, CAST(SUM(duplicates) AS BIGINT) AS n_duplicates
FROM flagged GROUP BY 1""",
    "feed_health": _with(_DELIVERIES, _DUPLICATES, _HEALTH, recursive=True) + "SELECT * FROM health",
    "feed_health_now": _with(_DELIVERIES, _DUPLICATES, _HEALTH, recursive=True)
    + """
SELECT feed_id, batch_id, data_rate,
       CASE WHEN (SELECT MAX(arrival_ms) FROM rides) - batch_id * 5000 > 6000 THEN 'none' ELSE status END AS status
FROM health WHERE (feed_id, batch_id) IN (SELECT (feed_id, MAX(batch_id)) FROM health GROUP BY feed_id)""",
    "ring_statistics": _with(_BATCHED)
    + """
SELECT ride_status, batch_id, n_messages, ROW_NUMBER() OVER o - 1 AS batch_index, COUNT(*) OVER w AS rows_in_frame,
       CAST(SUM(n_messages) OVER w AS BIGINT) AS ring_sum, MIN(n_messages) OVER w AS ring_min, MAX(n_messages) OVER w AS ring_max,
       CAST(SUM(n_messages) OVER w AS DOUBLE) / COUNT(*) OVER w AS ring_avg,
       MAX(n_messages) OVER w - MIN(n_messages) OVER w AS ring_span
FROM (SELECT ride_status, batch_id, COUNT(*) AS n_messages FROM batched GROUP BY ALL)
WINDOW o AS (PARTITION BY ride_status ORDER BY batch_id),
       w AS (PARTITION BY ride_status ORDER BY batch_id ROWS BETWEEN 14 PRECEDING AND CURRENT ROW)""",
    "bundle_average": _bundle(10_000),
    "bundle_average_short": _bundle(100),
    "turnover_board": _with(_CLASSED, _PANES)
    + f"""
SELECT dollar_window, dollar_timing, dollar_turnover,
       CASE dollar_timing WHEN 'LATE' THEN 'corrected' ELSE '' END AS state,
       CASE dollar_timing WHEN 'LATE' THEN '(updated)' ELSE '' END AS note,
       CASE dollar_timing WHEN 'LATE' THEN '(updated)' ELSE '' END || ' ' || {_cents('dollar_turnover')} AS text
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY dollar_window ORDER BY pane_order DESC) AS rn FROM panes) WHERE rn = 1""",
    "latest_run_rate": _with(_RATES)
    + f"""
SELECT dollar_run_rate_per_minute, {_cents('dollar_run_rate_per_minute')} AS text
FROM rates ORDER BY window_end_us DESC LIMIT 1""",
    "data_clock": _with(_BATCHED)
    + f"""
SELECT batch_id, clock_ms, {_iso('clock_ms')} AS clock
FROM (SELECT batch_id, MAX(m) OVER (ORDER BY batch_id ROWS UNBOUNDED PRECEDING) AS clock_ms
      FROM (SELECT batch_id, MAX(event_us // 1000) AS m FROM batched GROUP BY batch_id))""",
    "point_marks": _with(_INDEXED)
    + "SELECT message_id, ride_id, point_idx, point_idx - origin AS offset, after_done FROM seen",
    "ride_completeness": _with(_INDEXED)
    + """
SELECT ride_id, ANY_VALUE(origin) AS origin, COUNT(*) AS n_points, COUNT(DISTINCT point_idx) AS n_offsets,
       MIN(point_idx - origin) AS min_offset, MAX(point_idx - origin) AS max_offset,
       MAX(CASE WHEN ride_status = 'dropoff' THEN 1 ELSE 0 END) = 1 AS done,
       COUNT(*) FILTER (WHERE after_done) AS n_after_done,
       MAX(point_idx) - MIN(point_idx) + 1 - COUNT(DISTINCT point_idx) AS n_missing
FROM seen GROUP BY ride_id""",
    "stream_filter_box": _with() + f"SELECT {_PLAIN} FROM rides WHERE {_BOX}",
    "stream_max_timestamp": _with(*_on_kept(1_000_000, _CLOCKS)) + f"SELECT *, {_iso('max_ts_ms')} AS timestamp FROM clocks",
    "stream_count_cells": _with(*_on_kept(1_000_000, _CELLS)) + "SELECT * FROM cells",
    "stream_run_rate": _with(*_on_kept(3_000_000, _RATES)) + "SELECT * FROM rates",
    "stream_turnover": _with(*_on_kept(60_000_000, _WINDOW_SUMS)) + "SELECT * FROM sums",
    "stream_latest_points": _with(*_picked(60_000_000, _NEWEST)) + "SELECT * FROM picked",
    "stream_pickup_points": _with(*_picked(60_000_000, _OLDEST, _IS_PICKUP)) + "SELECT * FROM picked",
    "stream_drop_resent": _with(_DELIVERIES, _DUPLICATES, recursive=True) + "SELECT message_id, s AS arrival_ms FROM starts",
    "stream_data_clock": _with() + "SELECT MAX(event_us // 1000) AS clock_ms FROM rides",
    "stream_turnover_panes": _with(_REPLAYED)
    + """
, parts AS (
  SELECT w AS window_start_us, k, SUM(CAST(meter_increment AS DECIMAL(18,6))) AS d,
         CASE WHEN ANY_VALUE(mark) IS NULL OR ANY_VALUE(mark) < w + 60000000 THEN 'EARLY' ELSE 'LATE' END AS dollar_timing
  FROM (SELECT n.*, event_us // 60000000 * 60000000 AS w, mark FROM numbered n JOIN seen_tops USING (k))
  WHERE mark IS NULL OR mark < w + 360000000 GROUP BY w, k),
sums AS (
  SELECT window_start_us, dollar_timing, k, SUM(d) OVER (PARTITION BY window_start_us ORDER BY k) AS total FROM parts
  UNION ALL
  SELECT window_start_us, 'ON_TIME', NULL, SUM(d) FROM parts WHERE dollar_timing = 'EARLY' GROUP BY window_start_us)
SELECT window_start_us, dollar_timing, CAST(total AS DOUBLE) AS dollar_turnover,
       (window_start_us // 1000) / 1000.0::DOUBLE / 60.0::DOUBLE AS dollar_window FROM sums""",
    "stream_latest_panes": _session_panes(3_600_000_000, _NEWEST),
    "stream_pickup_panes": _session_panes(60_000_000, _OLDEST, _IS_PICKUP),
}

_STREAM_CLASSED = """
judged AS (
  SELECT n.*, event_us // 60000000 * 60000000 AS window_start_us, mark AS watermark_us,
         CASE WHEN mark IS NULL OR event_us // 60000000 * 60000000 + 60000000 > mark THEN 'ON_TIME'
              WHEN event_us // 60000000 * 60000000 + 360000000 > mark THEN 'LATE' ELSE 'DROPPED' END AS lateness
  FROM numbered n JOIN seen_tops USING (k))"""

# per source the greatest event time of earlier micro-batches less its delay; the least of the two counts
_TWO_SOURCES = """
ends AS (SELECT MIN(arrival_ms) AS lo, MAX(arrival_ms) AS hi FROM rides),
numbered AS (SELECT r.*, (arrival_ms - lo) * 12 // (hi - lo + 1) AS k FROM rides r, ends),
clocks AS (
  SELECT b.k, coalesce((SELECT MAX(event_us) // 1000 * 1000 FROM numbered n WHERE n.k < b.k - 1 AND ride_status = 'enroute'), 0) AS a,
         coalesce((SELECT MAX(event_us) // 1000 * 1000 - 90000000 FROM numbered n WHERE n.k < b.k - 1 AND ride_status <> 'enroute'), 0) AS m
  FROM range(12) AS b(k)),
all_rides AS (SELECT * FROM rides),
kept AS (SELECT n.* FROM numbered n JOIN clocks USING (k) WHERE event_us // 1000000 * 1000000 + 1000000 > least(a, m))"""

_SHOWN = "CASE dollar_timing WHEN 'EARLY' THEN 'incomplete' WHEN 'LATE' THEN 'corrected' ELSE '' END AS state, CASE dollar_timing WHEN 'EARLY' THEN '(processing)' WHEN 'LATE' THEN '(updated)' ELSE '' END AS note"

ORACLES |= {
    "combine_latest_points": ORACLES["latest_points"],
    "combine_pickup_points": ORACLES["pickup_points"],
    "combine_ride_totals": _with()
    + f"""
SELECT ride_id, COUNT(*) AS n_points, {_money('meter_increment')} AS dollars, MIN(passenger_count) AS least_riders,
       MAX(passenger_count) AS most_riders FROM rides GROUP BY ride_id""",
    "stream_turnover_board": ORACLES["stream_turnover_panes"].replace(
        "SELECT window_start_us, dollar_timing, CAST(total AS DOUBLE)", f"SELECT dollar_timing, {_SHOWN}, CAST(total AS DOUBLE)"
    )
    + " QUALIFY row_number() OVER (PARTITION BY window_start_us ORDER BY dollar_timing = 'LATE' DESC, dollar_timing = 'ON_TIME' DESC, k DESC) = 1",
    "stream_fan_out": _with()
    + f"""
, judged AS (SELECT message_id, verdict, ride_status = 'dropoff' AND passenger_count IN (4, 5) AS empty FROM rides
  JOIN (SELECT message_id, verdict FROM ({ORACLES["reject_split"]})) USING (message_id))
SELECT 'good' AS sink, message_id, '' AS reason FROM judged WHERE verdict = 'good'
UNION ALL SELECT 'rejects', message_id, verdict FROM judged WHERE verdict <> 'good'
UNION ALL SELECT 'ride', message_id, '' FROM judged WHERE NOT empty
UNION ALL SELECT 'clock', message_id, '' FROM judged WHERE NOT empty""",
    "stream_lateness_rows": _with(_REPLAYED, _STREAM_CLASSED) + "SELECT message_id, window_start_us, watermark_us, lateness FROM judged",
    "stream_lateness_classes": _with(_REPLAYED, _STREAM_CLASSED)
    + f"SELECT window_start_us, lateness, COUNT(*) AS n_points, {_money('meter_increment')} AS dollars FROM judged GROUP BY ALL",
    "stream_combine_latest": ORACLES["stream_latest_points"],
    "stream_ride_gaps": _with()
    + """
SELECT ride_id, before + 1 AS gap_from, point_idx - 1 AS gap_to
FROM (SELECT ride_id, point_idx, LAG(point_idx) OVER (PARTITION BY ride_id ORDER BY point_idx) AS before FROM rides)
WHERE point_idx - before > 1""",
    "stream_ride_trails": ORACLES["ride_trails"],
    "stream_feed_health": _with(_DELIVERIES, _DUPLICATES, _HEALTH, recursive=True)
    + """
SELECT feed_id, batch_id * 5000 AS at_ms, data_rate, status FROM health
UNION ALL SELECT feed_id, batch_id * 5000 + 6000, 0.0, 'none'
FROM (SELECT feed_id, batch_id, LEAD(batch_id) OVER (PARTITION BY feed_id ORDER BY batch_id) AS next FROM health)
WHERE next IS NULL OR (next - batch_id) * 5000 > 6000""",
    "stream_ring_statistics": ORACLES["ring_statistics"],
    "stream_bundle_average": ORACLES["bundle_average"],
    "stream_bundle_average_short": ORACLES["bundle_average_short"],
    "stream_union_idle": _with(
        _TWO_SOURCES.replace("> least(a, m)", "> greatest(least(a, m), a - 30000000, m + 60000000)"), _CELLS.replace("FROM rides", "FROM kept")
    )
    + "SELECT * FROM cells",
    "stream_ride_fading": _with(_BATCHED)
    + """
, pairs AS (SELECT DISTINCT ride_id, batch_id * 250 AS batch_ms FROM batched),
marks AS (
  SELECT p.ride_id, p.batch_ms, p.batch_ms + 250 * j AS at_ms, COUNT(q.batch_ms) AS later, MIN(q.batch_ms) AS overtaken
  FROM pairs p CROSS JOIN range(30) AS r(j)
    LEFT JOIN pairs q ON q.ride_id = p.ride_id AND q.batch_ms > p.batch_ms AND q.batch_ms <= p.batch_ms + 250 * j
  GROUP BY ALL),
weighed AS (
  SELECT *, GREATEST(0, 5 - later - GREATEST(0, (at_ms - LEAST(COALESCE(overtaken, batch_ms + 5000), batch_ms + 5000)) // 250)) AS weight
  FROM marks)
SELECT ride_id, batch_ms, at_ms, CAST(weight AS BIGINT) AS weight FROM weighed
QUALIFY weight IS DISTINCT FROM LAG(weight) OVER (PARTITION BY ride_id, batch_ms ORDER BY at_ms)""",
    "stream_heat_limits": _with(_BUNDLES)
    + """
, cell_ticks AS (
  SELECT window_end_us // 1000 + age AS tick, list_reduce(list_prepend(CAST(5 * ntaxis AS BIGINT), range(GREATEST(0, age // 250 - 20))),
         lambda w, i: 4 * w // 5) AS weight
  FROM cells, (SELECT UNNEST(range(0, 30000, 250)) AS age))
SELECT tick + 250 AS as_of_ms, MAX(weight) // 20 AS "limit" FROM cell_ticks WHERE weight >= 20 GROUP BY tick""",
    "stream_union_cells": _with(_TWO_SOURCES, _CELLS.replace("FROM rides", "FROM kept")) + "SELECT * FROM cells",
}
