"""Each query once more, as SQL for DuckDB on the same tables."""

from __future__ import annotations

SENSORS = ("click", "error", "purchase", "signup", "view")
STATUSES = ("F", "O", "P")
ORACLES: dict[str, str] = {}

# --- building blocks -----------------------------------------------------------------------------

_cases = ", ".join(f"CASE WHEN event_type = '{s}' THEN value END AS {s}" for s in SENSORS)
WIDE = f"""wide AS (SELECT event_id, user_id % 10 AS station, ts AS "DateTime", {_cases} FROM events)"""
WHOLE = WIDE + f""", whole AS (SELECT station, "DateTime", {", ".join(f"round({s} * 100) AS {s}" for s in SENSORS)} FROM wide)"""


def resampled(source: str, columns: dict[str, str], step: str, key: str | None = "station") -> str:
    """``bins`` and ``grid`` for steps that divide a day; ``columns`` maps names to aggregates."""
    k, on = (f"{key}, ", f"{key}, b") if key else ("", "b")
    by = f"GROUP BY {key}" if key else ""
    aggs = ", ".join(f"{a} AS {n}" for n, a in columns.items())
    names = ", ".join(columns)
    return f"""bins AS (
  SELECT {k}time_bucket(INTERVAL '{step}', "DateTime", TIMESTAMP '1970-01-01') AS b, {aggs}
  FROM {source} GROUP BY {k}b),
slots AS (SELECT {k}unnest(generate_series(min(b), max(b), INTERVAL '{step}')) AS b FROM bins {by}),
grid AS (SELECT {k}b AS "DateTime", {names} FROM slots LEFT JOIN bins USING ({on}))"""


MEANS = {s: f"avg({s})" for s in SENSORS}
GRID = WHOLE + ", " + resampled("whole", MEANS, "1 hour")


ALL_SENSORS = ", ".join(SENSORS)


LOG_ROWS = """rows AS (
  SELECT 'log/' || (user_id % 10) || '.txt' AS path, event_id + 2 AS line,
    CASE WHEN value > 200 THEN NULL ELSE ts END AS "DateTime",
    CASE WHEN user_id % 10 < 5 AND (value > 200 OR value <= 150) THEN value END AS "Temp1",
    user_id::DOUBLE AS "User1",
    CASE WHEN user_id % 10 >= 5 AND (value > 200 OR value <= 150) THEN value END AS "Hum1"
  FROM events WHERE NOT value < 1)"""

# --- sources and merging -------------------------------------------------------------------------

ORACLES["parse_station_log"] = f"""
WITH {LOG_ROWS}
SELECT (regexp_extract(path, '([0-9]+)', 1)) AS source, "DateTime", "Temp1", "User1", "Hum1" FROM rows"""

ORACLES["merge_station_logs"] = f"""
WITH {LOG_ROWS}
SELECT path AS source, "DateTime", "Temp1", "User1", "Hum1" FROM rows
QUALIFY row_number() OVER (PARTITION BY path, "DateTime" ORDER BY line) = 1"""

ORACLES["parse_date_time_columns"] = """
SELECT o_orderkey,
  CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' AND o_orderstatus <> 'P'
       THEN strptime(strftime(o_orderdate, '%Y/%m/%d %H:%M:%S'), '%Y/%m/%d %H:%M:%S') END AS "DateTime"
FROM orders"""

ORACLES["source_file_audit"] = """
SELECT 'log/' || (user_id % 10) || '.txt' AS source, count(*) + 2 AS lines,
  CASE WHEN count(*) + 2 < 3 THEN 'too short' ELSE 'ok' END AS status
FROM events GROUP BY user_id % 10
UNION ALL VALUES ('log/short.txt', 1, 'too short'), ('log/wrong.txt', 3, 'ok')"""

ORACLES["failed_sources"] = """
SELECT * FROM (VALUES ('log/short.txt', 'no header'), ('log/wrong.txt', 'header without DateTime')) v(source, status)
WHERE (SELECT count(*) FROM events) > 0"""

ORACLES["time_contract"] = """
SELECT o_orderstatus AS status, count(*) AS records, count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS without_time,
  min(o_orderdate) FILTER (o_orderpriority <> '4-NOT SPECIFIED') AS start,
  max(o_orderdate) FILTER (o_orderpriority <> '4-NOT SPECIFIED') AS "end"
FROM orders GROUP BY o_orderstatus"""

ORACLES["table_contract"] = """
WITH n AS (
  SELECT count(*) AS rows, count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS without_time,
    count(*) FILTER (o_totalprice < 1000 OR o_totalprice > 200000) AS price, count(*) FILTER (o_custkey < 1 OR o_custkey > 1000000000) AS cust
  FROM orders),
r AS (
  SELECT 'required_column' AS rule, 'DateTime' AS "column", 1::BIGINT AS found, 1::BIGINT AS low, NULL::BIGINT AS high
  UNION ALL SELECT 'required_column', 'o_totalprice', 1, 1, NULL
  UNION ALL SELECT 'required_column', 'humidity', 0, 1, NULL
  UNION ALL SELECT 'rows', NULL, rows, 1000, NULL FROM n
  UNION ALL SELECT 'without_time', 'DateTime', without_time, NULL, 0 FROM n
  UNION ALL SELECT 'out_of_range', 'o_totalprice', price, NULL, 0 FROM n
  UNION ALL SELECT 'out_of_range', 'o_custkey', cust, NULL, 0 FROM n)
SELECT *, coalesce(found >= low, true) AND coalesce(found <= high, true) AS ok FROM r"""

ORACLES["power_file_losses"] = """
WITH rows AS (
  SELECT 'power/' || (o_custkey % 7) || '.csv' AS source, o_orderkey,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderdate END AS t
  FROM orders),
placed AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY source, o_orderkey) AS place FROM rows)
SELECT source, count(*) AS data_lines, count(*) FILTER (t IS NULL) AS invalid_time,
  count(*) FILTER (t IS NOT NULL AND place > 1) AS duplicate_times
FROM placed GROUP BY source"""

ORACLES["log_source_audit"] = """
SELECT 'log/' || (user_id % 10) || '.txt' AS source, count(*) + 2 AS lines, 'ok' AS status FROM events GROUP BY user_id % 10
UNION ALL VALUES ('log/short.txt', 1, 'no header'), ('log/wrong.txt', 3, 'header without DateTime')"""

ORACLES["merge_loss_counts"] = """
WITH rows AS (SELECT 'log/' || (user_id % 10) || '.txt' AS source, value < 1 AS narrow, CASE WHEN value <= 200 THEN ts END AS t FROM events)
SELECT source, count(*) AS data_lines, count(*) FILTER (narrow) AS wrong_width,
  count(*) FILTER (NOT narrow AND t IS NULL) AS invalid_time,
  count(*) FILTER (NOT narrow) - count(DISTINCT t) FILTER (NOT narrow)
    - CASE WHEN count(*) FILTER (NOT narrow AND t IS NULL) > 0 THEN 1 ELSE 0 END AS duplicate_times
FROM rows GROUP BY source"""

ORACLES["merge_devices"] = f"""
WITH {WIDE},
minutes AS (SELECT station AS device, date_trunc('minute', "DateTime") AS "DateTime", event_id, click, error, purchase, signup, view FROM wide),
tables AS (
  SELECT 0 AS t, device, "DateTime", event_id, click, error, purchase FROM minutes WHERE event_id % 2 = 0
  UNION ALL BY NAME
  SELECT 1 AS t, device, "DateTime", event_id, click, signup, view FROM minutes WHERE event_id % 2 = 1 OR event_id % 3 = 0)
SELECT device, "DateTime", event_id, click, error, purchase, signup, view FROM tables
QUALIFY row_number() OVER (PARTITION BY device, "DateTime" ORDER BY t, event_id) = 1"""

ORACLES["merge_power"] = """
SELECT o_orderdate AS "DateTime", o_orderkey, o_totalprice AS power FROM orders
WHERE o_orderpriority <> '4-NOT SPECIFIED'
QUALIFY row_number() OVER (PARTITION BY o_orderdate ORDER BY o_orderkey) = 1"""

_sources = ", ".join(
    f"""src_{s} AS (SELECT date_trunc('minute', ts) AS "DateTime", value AS {s} FROM events
  WHERE event_type = '{s}' QUALIFY row_number() OVER (PARTITION BY date_trunc('minute', ts) ORDER BY event_id) = 1)"""
    for s in SENSORS
)
ORACLES["merge_weather_full_outer"] = f"""
WITH {_sources}
SELECT "DateTime", {ALL_SENSORS}
FROM src_click {" ".join(f'FULL JOIN src_{s} USING ("DateTime")' for s in SENSORS[1:])}"""

_hourly = lambda s, p: f"""(SELECT date_trunc('hour', ts) AS "DateTime", avg(round(value * 100)) AS {p}mean,
  max(value) AS {p}max FROM events WHERE event_type = '{s}' GROUP BY ALL)"""  # noqa: E731
_prefixes = {"A": "click", "B": "error", "C": "view", "D": "purchase", "E": "signup"}
ORACLES["combine_prefixed_sources"] = f"""
SELECT "DateTime", {", ".join(f'"{p}_mean", "{p}_max"' for p in _prefixes)}
FROM {_hourly("click", "A_")} a {" ".join(f'FULL JOIN {_hourly(s, f"{p}_")} src_{p} USING ("DateTime")' for p, s in list(_prefixes.items())[1:])}"""

_long = {"A": "click", "B": "error", "C": "view"}
ORACLES["long_csv_tables"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", "DateTime" AS time, '{p}_{n}' AS sensor, {n}::DOUBLE AS value FROM {_hourly(s, "")}"""
    for t, (p, s) in zip(("A_1yr", "B_yr", "C"), _long.items()) for n in ("mean", "max")
) + f""" UNION ALL SELECT 'E, 1' AS "table", "DateTime" AS time, 'E, 1_max' AS sensor, max AS value FROM {_hourly("signup", "")}"""

_uneven = {"a_WT": "click", "b_WT-to-Sed": "error", "c_SM_": "view", "d": "purchase", "e_WT_SM_": "signup"}
ORACLES["missing_rate_long"] = f"""
WITH t AS ({" UNION ALL ".join(
    f"""SELECT '{n}' AS tbl, {k} AS k, "DateTime" AS time, mean, CASE WHEN max < 900 THEN max END AS max
    FROM {_hourly(s, "")} WHERE hour("DateTime") <> {k}""" for k, (n, s) in enumerate(_uneven.items()))}),
cell AS (
  SELECT tbl || '_mean' AS sensor, 2 * k AS place, time, mean IS NOT NULL AS present FROM t WHERE hour(time) BETWEEN 6 AND 17
  UNION ALL SELECT tbl || '_max', 2 * k + 1, time, max IS NOT NULL FROM t WHERE hour(time) BETWEEN 6 AND 17),
grouped AS (
  SELECT *, CASE WHEN contains(sensor, 'SM_') THEN 'microclimate_soil_moisture' WHEN contains(sensor, '_WT-to-Sed') THEN 'microclimate_wt_to_sed'
    WHEN contains(sensor, '_WT') THEN 'microclimate_wt' ELSE 'microclimate_other' END AS "group" FROM cell),
sensor AS (
  SELECT *, (row_number() OVER (PARTITION BY "group" ORDER BY place) - 1) // 2 + 1 AS part, (count(*) OVER (PARTITION BY "group") + 1) // 2 AS parts
  FROM (SELECT DISTINCT sensor, place, "group" FROM grouped)),
time AS (SELECT time, bool_or(present AND "group" = 'microclimate_soil_moisture') AS soil FROM grouped GROUP BY time),
counts AS (
  SELECT strftime(time, '%Y-%m') AS month, "group", count(*) AS n FROM time CROSS JOIN (SELECT DISTINCT "group" FROM sensor)
  WHERE CASE "group" WHEN 'microclimate_wt' THEN time < '2024-01-16' WHEN 'microclimate_wt_to_sed' THEN time >= '2024-01-16'
    WHEN 'microclimate_soil_moisture' THEN soil ELSE true END
  GROUP BY ALL),
found AS (
  SELECT strftime(time, '%Y-%m') AS month, sensor, count(*) AS n FROM grouped
  WHERE present AND ("group" <> 'microclimate_wt' OR time < '2024-01-16') AND ("group" <> 'microclimate_wt_to_sed' OR time >= '2024-01-16') GROUP BY ALL)
SELECT 'microclimate' AS data_type, s."group", c.month, s.sensor, round((c.n - coalesce(f.n, 0)) / c.n::DOUBLE, 6) AS missing_rate,
  part, parts, CASE s."group" WHEN 'microclimate_soil_moisture' THEN 'Microclimate (Soil Moisture)' WHEN 'microclimate_wt' THEN 'Microclimate (WT - Before Dec 2024)'
    WHEN 'microclimate_wt_to_sed' THEN 'Microclimate (WT-to-Sed - After Dec 2024)' ELSE 'Microclimate (Other)' END || ' Missing Rate'
  || CASE WHEN parts > 1 THEN ' (Part ' || part || '/' || parts || ')' ELSE '' END AS title
FROM sensor s JOIN counts c USING ("group") LEFT JOIN found f ON f.month = c.month AND f.sensor = s.sensor"""

ORACLES["csv_scan"] = f"""
WITH {WIDE} SELECT event_id::DOUBLE AS event_id, station::DOUBLE AS station, "DateTime", {ALL_SENSORS} FROM wide"""

ORACLES["csv_mixed_headers"] = f"""
WITH {WIDE} SELECT "DateTime", event_id::DOUBLE AS event_id, click, error, purchase FROM wide
UNION ALL BY NAME
SELECT station::DOUBLE AS station, event_id::DOUBLE AS event_id, view, "DateTime", signup, click FROM wide"""

ORACLES["partitioned_sink"] = f"WITH {WIDE} SELECT * FROM wide"

ORACLES["clustered_sink"] = f"""
WITH {WIDE} SELECT * FROM wide WHERE "DateTime" BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'"""

# --- extraction ----------------------------------------------------------------------------------

ORACLES["extract_rename"] = f"""
WITH {WIDE} SELECT event_id AS id, "DateTime" AS time, click AS "Ta_180cm", view AS "RH_050cm [%]" FROM wide"""

ORACLES["extract_date_range"] = f"""
WITH {WIDE} SELECT * FROM wide WHERE "DateTime" BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20'"""

ORACLES["extract_date_range_daily"] = """
SELECT o_orderkey, o_orderdate AS "DateTime" FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-06-30'"""

ORACLES["extract_join"] = f"""
SELECT "DateTime", {", ".join(f"{s}_mean, {s}_max" for s in SENSORS)}
FROM {_hourly("click", "click_")} a {" ".join(f'JOIN {_hourly(s, f"{s}_")} src_{s} USING ("DateTime")' for s in SENSORS[1:])}
WHERE "DateTime" BETWEEN TIMESTAMP '2024-01-03' AND TIMESTAMP '2024-01-28'"""

ORACLES["extract_task_records"] = f"""
WITH {WIDE}
SELECT 'power' AS task, 'power/s' || station AS output, count(*) AS records, 'DateTime,a' AS columns
FROM wide WHERE station % 2 = 0 AND "DateTime" BETWEEN '2024-01-10' AND '2024-01-28' GROUP BY station
UNION ALL SELECT 'climate', 'climate/s' || station, count(*), 'DateTime,v,e'
FROM wide a JOIN wide b USING (station, "DateTime")
WHERE station % 2 = 1 AND "DateTime" BETWEEN '2024-01-02' AND '2024-01-12' GROUP BY station
UNION ALL SELECT 'climate', 'climate/all_columns', count(*), 'DateTime,click,error,purchase,signup,view'
FROM wide WHERE station = 0 AND "DateTime" BETWEEN '2024-01-02' AND '2024-01-28'"""

ORACLES["split_rows_by_date"] = f"""
WITH {WIDE} SELECT *, CASE WHEN "DateTime" < '2024-01-16' THEN '_WT' ELSE '_WT-to-Sed' END AS part FROM wide"""

ORACLES["split_columns_by_date"] = f"""
WITH {WIDE} SELECT event_id, station, "DateTime", error, purchase, signup, {", ".join(
    f'''CASE WHEN "DateTime" < '2024-01-16' THEN {s} END AS {s}_part1,
    CASE WHEN "DateTime" >= '2024-01-16' THEN {s} END AS {s}_part2''' for s in ("click", "view"))} FROM wide"""

ORACLES["split_stats"] = f"""
WITH {WIDE} SELECT station, count(*) AS total_records,
  count(*) FILTER ("DateTime" < '2024-01-16') AS part1_records,
  count(*) FILTER ("DateTime" >= '2024-01-16') AS part2_records
FROM wide GROUP BY station"""

ORACLES["classify_sensors"] = """
WITH names AS (SELECT p_partkey, p_name || '_' || p_type AS n FROM part)
SELECT p_partkey, CASE
  WHEN contains(n, 'bolt') OR contains(n, 'ring') THEN 'joint'
  WHEN contains(n, 'red') OR contains(n, 'blue') THEN 'colour'
  WHEN contains(n, 'ECONOMY') OR contains(n, 'SMALL') THEN 'grade' ELSE 'other' END AS kind
FROM names"""

# --- quality control -----------------------------------------------------------------------------

_ranges = {"click": (5, 200, "click_rate"), "error": (0, 150, "error_rate"), "purchase": (1, 100, "purchase_rate"),
           "signup": (0, 1000, "signup_rate")}
ORACLES["qc_range_mask"] = f"""
WITH {WIDE} SELECT event_id, station, "DateTime", {", ".join(
    f"CASE WHEN {s} > {lo} AND {s} < {hi} THEN {s} END AS {s}" for s, (lo, hi, _) in _ranges.items())}, view FROM wide"""

ORACLES["qc_range_stats"] = f"WITH {WIDE}" + " UNION ALL ".join(
    f"""SELECT station, '{s}' AS sensor, '{kind}' AS variable_type, count({s}) AS initial_count,
  count(*) FILTER ({s} <= {lo} OR {s} >= {hi}) AS flagged_count,
  round(count(*) FILTER ({s} <= {lo} OR {s} >= {hi}) * 100.0 / count({s}), 6)::DOUBLE AS flagged_percentage,
  '{lo} to {hi} u' AS bounds
FROM wide GROUP BY station HAVING count(*) FILTER ({s} <= {lo} OR {s} >= {hi}) > 0
""" for s, (lo, hi, kind) in _ranges.items()
)

_passes = WIDE + """, first_pass AS (SELECT event_id, station, "DateTime", purchase, signup,
  CASE WHEN error <= 0 OR error >= 150 THEN NULL ELSE error END AS error,
  view <= 0 OR view >= 160 AS view_pre, click <= 2 OR click >= 200 AS click_pre,
  CASE WHEN view <= 0 OR view >= 160 THEN NULL ELSE view END AS view,
  CASE WHEN click <= 2 OR click >= 200 THEN NULL ELSE click END AS click FROM wide),
flags AS (SELECT *,
  coalesce(hour("DateTime") BETWEEN 7 AND 16 AND (view < 10 OR view >= 160), false) AS view_day,
  coalesce(NOT hour("DateTime") BETWEEN 7 AND 16 AND (view < 0 OR view >= 160), false) AS view_night,
  coalesce(hour("DateTime") BETWEEN 6 AND 17 AND (click < 8 OR click >= 200), false) AS click_day,
  coalesce(NOT hour("DateTime") BETWEEN 6 AND 17 AND (click < 4 OR click >= 120), false) AS click_night
  FROM first_pass)"""
ORACLES["qc_time_range_mask"] = f"""
WITH {_passes} SELECT event_id, station, "DateTime", error, purchase, signup,
  CASE WHEN NOT (view_day OR view_night) THEN view END AS view,
  CASE WHEN NOT (click_day OR click_night) THEN click END AS click FROM flags"""

_timed = {
    "view": ("view_rate", "Daytime (07:00-17:00): 10 to 160 u, Nighttime: 0 to 160 u"),
    "click": ("click_rate", "Daytime (06:00-18:00): 8 to 200 u, Nighttime: 4 to 120 u"),
}
ORACLES["qc_time_range_stats"] = f"WITH {_passes}" + " UNION ALL ".join(
    f"""SELECT '{s}' AS sensor, '{kind}' AS variable_type, count({s}) AS initial_count,
  count_if({s}_day OR {s}_night)::BIGINT AS flagged_count,
  round(count_if({s}_day OR {s}_night) * 100.0::DOUBLE / count({s}), 6) AS flagged_percentage, '{bounds}' AS bounds,
  count_if({s}_day)::BIGINT AS daytime_flagged, count_if({s}_night)::BIGINT AS nighttime_flagged,
  round(count_if({s}_day) * 100.0::DOUBLE / count({s}), 6) AS daytime_percentage,
  round(count_if({s}_night) * 100.0::DOUBLE / count({s}), 6) AS nighttime_percentage,
  count_if({s}_pre)::BIGINT AS prefiltered_count FROM flags
""" for s, (kind, bounds) in _timed.items()
) + """ UNION ALL SELECT 'error', 'error_rate', count(error), count_if(error <= 0 OR error >= 150)::BIGINT,
  round(count_if(error <= 0 OR error >= 150) * 100.0::DOUBLE / count(error), 6), '0 to 150 u', NULL, NULL, NULL, NULL, 0
FROM wide HAVING count_if(error <= 0 OR error >= 150) > 0"""

ORACLES["qc_failure_mask"] = f"""
WITH {WIDE}, hit AS (SELECT *,
  station = 3 AND "DateTime" BETWEEN '2024-01-05' AND '2024-01-09' AS a,
  station = 7 AND "DateTime" BETWEEN '2024-01-10' AND '2024-01-20' AS b FROM wide)
SELECT event_id, station, "DateTime", purchase,
  CASE WHEN NOT a THEN click END AS click, CASE WHEN NOT a THEN signup END AS signup,
  CASE WHEN NOT b THEN view END AS view, CASE WHEN NOT b THEN error END AS error FROM hit"""

ORACLES["qc_failure_mask_many"] = f"""
WITH {WIDE}, windows AS (
  SELECT s AS station, TIMESTAMP '2024-01-01' + to_days((3 * i)::INTEGER) AS w_start,
    TIMESTAMP '2024-01-02' + to_days((3 * i)::INTEGER) AS w_end
  FROM range(10) a(s), range(8) b(i)),
hit AS (SELECT w.*, x.w_start IS NOT NULL AS bad FROM wide w LEFT JOIN windows x
  ON w.station = x.station AND w."DateTime" BETWEEN x.w_start AND x.w_end)
SELECT event_id, station, "DateTime", signup_ AS signup, click_ AS click, error_ AS error, purchase_ AS purchase, view_ AS view
FROM (SELECT event_id, station, "DateTime",
  signup AS signup_,
  CASE WHEN NOT (bad AND station % 2 = 1) THEN click END AS click_,
  CASE WHEN NOT (bad AND station % 2 = 0) THEN error END AS error_,
  CASE WHEN NOT (bad AND station % 2 = 0) THEN purchase END AS purchase_,
  CASE WHEN NOT bad THEN view END AS view_ FROM hit)"""

ORACLES["qc_failure_stats"] = """
SELECT 3::BIGINT AS station, 's3' AS failure_station, 'click,signup' AS affected_columns, '2024-01-05 to 2024-01-09' AS failure_period,
  count(*) FILTER (ts BETWEEN '2024-01-05' AND '2024-01-09') AS affected_timestamps, 'cl,si' AS sensor_patterns
FROM events WHERE user_id % 10 = 3
UNION ALL
SELECT 7, 's7', 'view,view,error', '2024-01-10 to 2024-01-20',
  count(*) FILTER (ts BETWEEN '2024-01-10' AND '2024-01-20'), 'view,vi,error'
FROM events WHERE user_id % 10 = 7"""

ORACLES["qc_failure_stats_many"] = """
WITH windows AS (
  SELECT s AS station, TIMESTAMP '2024-01-01' + to_days((3 * i)::INTEGER) AS a, TIMESTAMP '2024-01-02' + to_days((3 * i)::INTEGER) AS b
  FROM range(10) x(s), range(8) y(i))
SELECT station, 's' || station AS failure_station, strftime(a, '%Y-%m-%d') || ' to ' || strftime(b, '%Y-%m-%d') AS failure_period,
  count(*) FILTER (ts BETWEEN a AND b) AS affected_timestamps,
  CASE WHEN station % 2 = 1 THEN 'click,view' ELSE 'error,purchase,view' END AS affected_columns,
  CASE WHEN station % 2 = 1 THEN 'click,view' ELSE 'e' END AS sensor_patterns
FROM windows JOIN events ON user_id % 10 = station GROUP BY ALL"""

ORACLES["daily_std"] = f"""
WITH {WIDE} SELECT station, "DateTime"::DATE AS day, count(*) AS rows,
  {", ".join(f"round(stddev_samp({s}), 6) AS {s}" for s in SENSORS)} FROM wide GROUP BY ALL"""

SHIPMENTS = """series AS (SELECT l_linestatus AS station, l_shipdate AS "DateTime", l_returnflag AS flag,
  CASE WHEN datediff('day', DATE '1995-01-01', l_shipdate::DATE) % 11 < 7 THEN 20.0 ELSE l_quantity END AS v FROM lineitem),
ships AS (SELECT station, "DateTime", CASE WHEN flag = 'A' THEN v END AS "q_A",
  CASE WHEN flag = 'N' THEN v END AS "q_N", CASE WHEN flag = 'R' THEN v END AS "q_R" FROM series)"""
FLAGGED = SHIPMENTS + """,
rules AS (SELECT * FROM (VALUES ('A', 'one_day', 1), ('N', 'three_days', 3), ('R', 'seven_days', 7)) r(flag, category, w)),
all_days AS (SELECT station, "DateTime"::DATE AS day, count(*) AS rows FROM series GROUP BY ALL),
std AS (SELECT station, flag, "DateTime"::DATE AS day, stddev_samp(v) AS std FROM series GROUP BY ALL),
days AS (SELECT d.station, d.day, d.rows, r.flag, r.category, r.w, coalesce(s.std < 1e-6, false) AS is_const
  FROM all_days d CROSS JOIN rules r LEFT JOIN std s ON s.station = d.station AND s.day = d.day AND s.flag = r.flag),
islands AS (SELECT *, count_if(NOT is_const) OVER (PARTITION BY station, flag ORDER BY day) AS island FROM days),
runs AS (SELECT *, row_number() OVER (PARTITION BY station, flag, island ORDER BY day) AS pos,
  count(*) OVER (PARTITION BY station, flag, island) AS len FROM islands WHERE is_const),
flagged AS (SELECT station, 'q_' || flag AS sensor, category, day, rows, w AS window_days, 1e-6::DOUBLE AS tolerance
  FROM runs WHERE pos <= len // w * w)"""
ORACLES["qc_constant_days"] = f"WITH {FLAGGED} SELECT * FROM flagged"

_masked = """masked AS (SELECT s.station, s."DateTime",
  CASE WHEN a.day IS NULL THEN s."q_A" END AS "q_A", CASE WHEN n.day IS NULL THEN s."q_N" END AS "q_N",
  CASE WHEN r.day IS NULL THEN s."q_R" END AS "q_R" FROM ships s
  LEFT JOIN flagged a ON a.sensor = 'q_A' AND a.station = s.station AND a.day = s."DateTime"::DATE
  LEFT JOIN flagged n ON n.sensor = 'q_N' AND n.station = s.station AND n.day = s."DateTime"::DATE
  LEFT JOIN flagged r ON r.sensor = 'q_R' AND r.station = s.station AND r.day = s."DateTime"::DATE)"""
ORACLES["qc_constant_mask"] = f"WITH {FLAGGED}, {_masked} SELECT * FROM masked"

ORACLES["qc_constant_stats"] = f"""
WITH {FLAGGED} SELECT station, sensor, category, window_days, tolerance, sum(rows)::BIGINT AS flagged_count,
  string_agg(day::VARCHAR, ',' ORDER BY day) AS dates FROM flagged GROUP BY ALL"""

ORACLES["qc_full"] = f"""
WITH {FLAGGED}, {_masked},
failed AS (SELECT station, "DateTime",
  CASE WHEN (station = 'F' AND "DateTime" BETWEEN '1996-03-01' AND '1996-06-01')
    OR (station = 'O' AND "DateTime" BETWEEN '1999-01-01' AND '1999-12-31') THEN NULL ELSE "q_A" END AS "q_A",
  CASE WHEN (station = 'F' AND "DateTime" BETWEEN '1996-03-01' AND '1996-06-01')
    OR (station = 'O' AND "DateTime" BETWEEN '1999-01-01' AND '1999-12-31') THEN NULL ELSE "q_N" END AS "q_N",
  CASE WHEN station = 'O' AND "DateTime" BETWEEN '1999-01-01' AND '1999-12-31' THEN NULL ELSE "q_R" END AS "q_R"
  FROM masked)
SELECT station, "DateTime", {", ".join(f'CASE WHEN "q_{f}" > 2 AND "q_{f}" < 48 THEN "q_{f}" END AS "q_{f}"' for f in "ANR")}
FROM failed"""

ORACLES["qc_total_flagged"] = f"""
WITH {FLAGGED}, {_masked}, counts AS (
  SELECT sum(rows) AS n FROM flagged
  UNION ALL
  SELECT {" + ".join(f"""count(*) FILTER (("q_{f}" <= 2 OR "q_{f}" >= 48) AND NOT coalesce(
    (station = 'O' AND "DateTime" BETWEEN '1999-01-01' AND '1999-12-31')
    OR ({"true" if f in "AN" else "false"} AND station = 'F' AND "DateTime" BETWEEN '1996-03-01' AND '1996-06-01'), false))"""
    for f in "ANR")} FROM masked)
SELECT sum(n)::BIGINT AS total_flagged FROM counts"""

# --- resampling and gap filling ------------------------------------------------------------------

ORACLES["resample_mean"] = f"""WITH {GRID} SELECT station, "DateTime", {ALL_SENSORS} FROM grid"""

ORACLES["resample_sum"] = f"""
WITH {WHOLE}, {resampled("whole", {s: f"sum({s})" for s in SENSORS}, "1 hour")}
SELECT station, "DateTime", {", ".join(f"coalesce({s}, 0) AS {s}" for s in SENSORS)} FROM grid"""


def circular(v: str) -> str:
    angle = f"degrees(atan2(avg(sin(radians({v}))), avg(cos(radians({v})))))"
    return f"round({angle} + CASE WHEN {angle} < 0 THEN 360 ELSE 0 END, 6) % 360"


_angles = """dirs AS (SELECT station, "DateTime", click % 360 AS d1, view * 7 % 360 AS d2, error, signup, purchase FROM whole)"""
ORACLES["resample_circular_mean"] = f"""
WITH {WHOLE}, {_angles}, {resampled("dirs", {'"Met_Dir1"': circular("d1"), '"Met_Dir2"': circular("d2")}, "1 hour")}
SELECT * FROM grid"""

ORACLES["resample_mixed"] = f"""
WITH {WHOLE}, {_angles}, {resampled("dirs", {
    '"Met_Dir1"': circular("d1"), '"Met_Dir2"': circular("d2"), '"Temp1"': "avg(error)",
    '"WindDirection_deg"': "avg(signup)", "other": "avg(purchase)"}, "30 minutes")}
SELECT * FROM grid"""

ORACLES["resample_stats"] = f"""
WITH {GRID} SELECT '1h' AS frequency, (SELECT count(*) FROM wide) AS original_rows, count(*) AS downsampled_rows,
  round((SELECT count(*) FROM wide)::DOUBLE / count(*), 6) AS reduction_factor, 7::BIGINT AS columns_processed FROM grid"""

ORACLES["resample_daily"] = """
WITH bins AS (SELECT o_orderstatus AS status, o_orderdate AS b, avg(round(o_totalprice * 100)) AS price FROM orders GROUP BY ALL),
slots AS (SELECT status, unnest(generate_series(min(b), max(b), INTERVAL 1 DAY)) AS b FROM bins GROUP BY status)
SELECT status, b AS "DateTime", price FROM slots LEFT JOIN bins USING (status, b)"""

_calendar = lambda trunc, step, end: f"""
WITH bins AS (SELECT o_orderstatus AS status, date_trunc('{trunc}', o_orderdate)::TIMESTAMP AS b, avg(round(o_totalprice * 100)) AS price
  FROM orders GROUP BY ALL),
slots AS (SELECT status, unnest(generate_series(min(b), max(b), INTERVAL {step})) AS b FROM bins GROUP BY status)
SELECT status, {end} AS "DateTime", price FROM slots LEFT JOIN bins USING (status, b)"""  # noqa: E731
ORACLES["resample_week"] = _calendar("week", "7 DAY", "b + INTERVAL 6 DAY")
ORACLES["resample_month"] = _calendar("month", "1 MONTH", "last_day(b)::TIMESTAMP")
ORACLES["resample_quarter"] = _calendar("quarter", "3 MONTH", "last_day(b + INTERVAL 2 MONTH)::TIMESTAMP")
ORACLES["resample_year"] = _calendar("year", "1 YEAR", "last_day(b + INTERVAL 11 MONTH)::TIMESTAMP")

ORACLES["resample_month_start"] = _calendar("month", "1 MONTH", "b")
ORACLES["resample_week_monday"] = ORACLES["resample_week"].replace(
    "date_trunc('week', o_orderdate)::TIMESTAMP", "date_trunc('week', o_orderdate - INTERVAL 1 DAY)::TIMESTAMP + INTERVAL 1 DAY"
)
ORACLES["resample_ninety_minutes"] = f"""WITH {WHOLE}, {resampled("whole", MEANS, "90 minutes")} SELECT * FROM grid"""

# first moment of a bin, length, and how its label follows from it
_frequencies = {
    "6h": ("time_bucket(INTERVAL 6 HOUR, o_orderdate, TIMESTAMP '1970-01-01')", "6 HOUR", "b"),
    "1d": ("date_trunc('day', o_orderdate)", "1 DAY", "b"),
    "W": ("date_trunc('week', o_orderdate)", "7 DAY", "b + INTERVAL 6 DAY"),
    "W-WED": ("date_trunc('week', o_orderdate - INTERVAL 3 DAY) + INTERVAL 3 DAY", "7 DAY", "b + INTERVAL 6 DAY"),
    "M": ("date_trunc('month', o_orderdate)", "1 MONTH", "last_day(b)"),
    "MS": ("date_trunc('month', o_orderdate)", "1 MONTH", "b"),
    "Q": ("date_trunc('quarter', o_orderdate)", "3 MONTH", "last_day(b + INTERVAL 2 MONTH)"),
    "QS": ("date_trunc('quarter', o_orderdate)", "3 MONTH", "b"),
    "Y": ("date_trunc('year', o_orderdate)", "1 YEAR", "last_day(b + INTERVAL 11 MONTH)"),
    "YS": ("date_trunc('year', o_orderdate)", "1 YEAR", "b"),
}
ORACLES["frequency_bins"] = " UNION ALL ".join(
    f"""SELECT '{f}' AS frequency, status, count(*) AS bins, min({label})::TIMESTAMP AS first, max({label})::TIMESTAMP AS last,
  any_value(total) AS total
FROM (SELECT status, unnest(generate_series(min(b)::TIMESTAMP, max(b)::TIMESTAMP, INTERVAL {step})) AS b, sum(p) AS total
  FROM (SELECT o_orderstatus AS status, {start} AS b, round(o_totalprice * 100) AS p FROM orders) GROUP BY status) GROUP BY status
""" for f, (start, step, label) in _frequencies.items()
)

ORACLES["resample_two_months"] = """
WITH months AS (SELECT o_orderstatus AS status, date_trunc('month', o_orderdate)::DATE AS m, o_totalprice FROM orders),
firsts AS (SELECT status, min(m) AS m0 FROM months GROUP BY status),
bins AS (SELECT status, m0, (datediff('month', m0, m) + 1) // 2 AS k, avg(round(o_totalprice * 100)) AS price
  FROM months JOIN firsts USING (status) GROUP BY ALL),
slots AS (SELECT status, m0, unnest(range(0, max(k) + 1)) AS k FROM bins GROUP BY status, m0)
SELECT status, last_day(m0 + to_months((2 * k)::INTEGER))::TIMESTAMP AS "DateTime", price
FROM slots LEFT JOIN bins USING (status, m0, k)"""

ORACLES["resample_seven_hours"] = f"""
WITH {WHOLE}, firsts AS (SELECT station, date_trunc('day', min("DateTime"))::TIMESTAMP AS o FROM whole GROUP BY station),
bins AS (SELECT station, o, datediff('microsecond', o, "DateTime") // 25200000000 AS k,
  {", ".join(f"avg({s}) AS {s}" for s in SENSORS)} FROM whole JOIN firsts USING (station) GROUP BY ALL),
slots AS (SELECT station, o, unnest(range(min(k), max(k) + 1)) AS k FROM bins GROUP BY station, o)
SELECT station, o + to_hours((7 * k)::INTEGER) AS "DateTime", {ALL_SENSORS}
FROM slots LEFT JOIN bins USING (station, o, k)"""


def interpolated(limit: int | None) -> str:
    """``filled`` from ``grid``: per sensor the estimate, and whether it is close enough."""
    near = lambda s: "true" if limit is None else f"(p - {s}_pp <= {limit} OR {s}_np - p <= {limit})"
    both = ", ".join(
        f"""last_value({s} IGNORE NULLS) OVER up AS {s}_pv, first_value({s} IGNORE NULLS) OVER down AS {s}_nv,
    last_value(CASE WHEN {s} IS NOT NULL THEN p END IGNORE NULLS) OVER up AS {s}_pp,
    first_value(CASE WHEN {s} IS NOT NULL THEN p END IGNORE NULLS) OVER down AS {s}_np""" for s in SENSORS
    )
    values = ", ".join(
        f"""CASE WHEN {s} IS NOT NULL THEN {s} WHEN {near(s)} THEN coalesce(
      {s}_pv + ({s}_nv - {s}_pv) * (p - {s}_pp) / ({s}_np - {s}_pp), {s}_pv, {s}_nv) END AS {s}_y""" for s in SENSORS
    )
    return f"""numbered AS (SELECT *, row_number() OVER (PARTITION BY station ORDER BY "DateTime") AS p FROM grid),
edges AS (SELECT *, {both} FROM numbered WINDOW
  up AS (PARTITION BY station ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  down AS (PARTITION BY station ORDER BY p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (SELECT *, {values} FROM edges)"""


_filled = ", ".join(f"{s}_y AS {s}, ({s} IS NULL AND {s}_y IS NOT NULL) AS {s}_interpolated" for s in SENSORS)
ORACLES["interpolate_linear"] = f"""WITH {GRID}, {interpolated(None)} SELECT station, "DateTime", {_filled} FROM filled"""
ORACLES["interpolate_limited"] = f"""WITH {GRID}, {interpolated(2)} SELECT station, "DateTime", {_filled} FROM filled"""
ORACLES["interpolate_edges"] = f"""
WITH {WHOLE}, {resampled("whole", MEANS, "2 hours")}, {interpolated(3)} SELECT station, "DateTime", {_filled} FROM filled"""
ORACLES["interpolation_stats"] = f"WITH {GRID}, {interpolated(2)}" + " UNION ALL ".join(
    f"""SELECT station, '{s}' AS sensor, count(*) FILTER ({s} IS NULL AND {s}_y IS NOT NULL) AS filled
FROM filled GROUP BY station
""" for s in SENSORS
)

_clean = WHOLE + """, clean AS (SELECT station, "DateTime", error, purchase, signup,
  CASE WHEN click > 500 AND click < 20000 THEN click END AS click,
  CASE WHEN view > 0 AND view < 15000 THEN view END AS view FROM whole)"""
ORACLES["curated_dataset"] = f"""
WITH {_clean}, {resampled("clean", MEANS, "1 hour")}, {interpolated(2)}
SELECT station, "DateTime", view_y AS "RH", error_y AS "E", purchase_y AS "P", signup_y AS "S", (click IS NULL AND click_y IS NOT NULL) AS filled,
  CASE WHEN "DateTime" < '2024-01-16' THEN click_y END AS "Ta_WT_part1",
  CASE WHEN "DateTime" >= '2024-01-16' THEN click_y END AS "Ta_WT_part2"
FROM filled WHERE "DateTime" BETWEEN '2024-01-03' AND '2024-01-28'"""

ORACLES["resample_unkeyed"] = f"""
WITH {WHOLE}, {resampled("whole", MEANS, "5 minutes", None)} SELECT * FROM grid"""

# --- integrity -----------------------------------------------------------------------------------

ORACLES["dedupe_keep_first"] = """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax
FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax) = 1"""

ORACLES["duplicate_count"] = """
SELECT sum(n)::BIGINT AS total_rows, sum(n - 1)::BIGINT AS duplicate_count
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"""

ORACLES["missing_ratio"] = f"WITH {WIDE}" + " UNION ALL ".join(
    f"""SELECT station, '{s}' AS "column", round(avg(CASE WHEN {s} IS NULL THEN 1.0::DOUBLE ELSE 0 END), 6) AS missing_ratio
FROM wide GROUP BY station HAVING count({s}) < count(*)
""" for s in SENSORS
)

ORACLES["value_range_counts"] = f"WITH {WIDE}" + " UNION ALL ".join(
    f"""SELECT station, '{s}' AS "column", count(*) FILTER ({s} < {lo}) AS below_min, count(*) FILTER ({s} > {hi}) AS above_max,
  count(*) FILTER ({s} < {lo} OR {s} > {hi}) AS out_of_range FROM wide GROUP BY station
HAVING count(*) FILTER ({s} < {lo} OR {s} > {hi}) > 0
""" for s, lo, hi in (("click", 5, 200), ("error", 0, 150), ("view", -1, 1000000))
)

ORACLES["table_summary"] = f"""
WITH {WIDE} SELECT station, count(*) AS records, 8::BIGINT AS columns, min("DateTime") AS start, max("DateTime") AS "end"
FROM wide GROUP BY station"""

STEPS = """steps AS (SELECT user_id % 10 AS station, lag(ts) OVER (PARTITION BY user_id % 10 ORDER BY ts) AS before, ts,
  datediff('microsecond', lag(ts) OVER (PARTITION BY user_id % 10 ORDER BY ts), ts) / 1e6 AS s FROM events)"""
ORACLES["temporal_consistency"] = f"""
WITH {STEPS} SELECT station, count(*) AS total_records, min(ts) AS start, max(ts) AS "end",
  round(median(s), 6) AS median_interval_s, round(min(s), 6) AS min_interval_s, round(max(s), 6) AS max_interval_s,
  count(*) FILTER (s > 3600) AS gap_count, count(*) FILTER (s < 0) AS backwards FROM steps GROUP BY station"""

ORACLES["temporal_gaps"] = f"""
WITH {STEPS} SELECT station, before AS start, ts AS "end", round(s, 6) AS duration_s FROM steps WHERE s > 3600"""

# --- missing rates -------------------------------------------------------------------------------

_rate = lambda n: f"round(avg(CASE WHEN {n} IS NULL THEN 1.0::DOUBLE ELSE 0 END), 6)"
ORDERS_WIDE = "wide AS (SELECT o_orderdate AS \"DateTime\", " + ", ".join(
    f"CASE WHEN o_orderstatus = '{s}' THEN o_totalprice END AS {s}" for s in STATUSES
) + " FROM orders)"
ORACLES["missing_rate_monthly"] = f"WITH {ORDERS_WIDE}" + " UNION ALL ".join(
    f"""SELECT strftime("DateTime", '%Y-%m') AS month, '{s}' AS sensor, {_rate(s)} AS missing_rate FROM wide GROUP BY ALL
""" for s in STATUSES
)

ORACLES["missing_rate_daylight"] = f"WITH {WIDE}" + " UNION ALL ".join(
    f"""SELECT strftime("DateTime", '%Y-%m') AS month, '{s}' AS sensor, {_rate(s)} AS missing_rate
FROM wide WHERE hour("DateTime") BETWEEN 6 AND 17 GROUP BY ALL
""" for s in SENSORS
)

ORACLES["missing_rate_matrix"] = f"""WITH {ORDERS_WIDE}, rates AS ({" UNION ALL ".join(
    f'''SELECT strftime("DateTime", '%Y-%m') AS month, '{s}' AS sensor,
    avg(CASE WHEN {s} IS NULL THEN 1.0::DOUBLE ELSE 0 END) * 100 AS rate FROM wide GROUP BY ALL''' for s in STATUSES)}),
months AS (SELECT strftime(unnest(generate_series(date_trunc('month', min("DateTime")), date_trunc('month', max("DateTime")),
  INTERVAL 1 MONTH)), '%Y-%m') AS month FROM wide)
SELECT sensor AS label, sensor, month, round(rate, 6) AS missing_percent
FROM months CROSS JOIN (SELECT DISTINCT sensor FROM rates) LEFT JOIN rates USING (month, sensor)"""

TEN_MINUTES = WIDE + ", " + resampled("wide", MEANS, "10 minutes", None)
_groups = (
    ("a_WT_click", "click", "microclimate_wt", "\"DateTime\" < '2024-01-16'"),
    ("b_WT-to-Sed_error", "error", "microclimate_wt_to_sed", "\"DateTime\" >= '2024-01-16'"),
    ("c_SM_purchase", "purchase", "microclimate_soil_moisture", "(purchase IS NOT NULL OR signup IS NOT NULL)"),
    ("d_SM_signup", "signup", "microclimate_soil_moisture", "(purchase IS NOT NULL OR signup IS NOT NULL)"),
    ("e_view", "view", "microclimate_other", "true"),
)
ORACLES["missing_rate_by_group"] = f"WITH {TEN_MINUTES}" + " UNION ALL ".join(
    f"""SELECT 'microclimate' AS data_type, '{group}' AS "group", strftime("DateTime", '%Y-%m') AS month, '{name}' AS sensor,
  {_rate(s)} AS missing_rate FROM grid WHERE hour("DateTime") BETWEEN 6 AND 17 AND {condition} GROUP BY ALL
""" for name, s, group, condition in _groups
)

ORACLES["missing_rate_task_summary"] = f"""
WITH {TEN_MINUTES}, counts AS (
  SELECT count(*) AS records, 2 * count(*) AS cells, 2 * count(*) - count(click) - count(error) AS missing
  FROM grid WHERE hour("DateTime") BETWEEN 6 AND 17
  UNION ALL
  SELECT count(*), 4 * count(*), 4 * count(*) - count(error) - count(view) - count(purchase) - count(signup)
  FROM grid WHERE hour("DateTime") BETWEEN 6 AND 17)
SELECT 'Soil Moisture' AS task, 5::BIGINT AS total_sensors, max(records) AS total_records,
  round(sum(missing) * 100.0::DOUBLE / sum(cells), 2) AS missing_rate_pct, 2::BIGINT AS files FROM counts"""

ORACLES["drop_all_null_rows"] = f"""
WITH {GRID} SELECT station, "DateTime", {ALL_SENSORS} FROM grid
WHERE NOT ({" AND ".join(f"{s} IS NULL" for s in SENSORS)})"""

PARTS = """parts AS (SELECT c_mktsegment AS "group", c_name AS sensor,
  ((row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_name) + 9) // 10)::BIGINT AS part,
  ((count(*) OVER (PARTITION BY c_mktsegment) + 9) // 10)::BIGINT AS parts
FROM (SELECT DISTINCT c_mktsegment, c_name FROM customer))"""
ORACLES["report_parts"] = f"WITH {PARTS} SELECT *, part || '/' || parts AS part_label FROM parts"
ORACLES["report_part_titles"] = f"""
WITH {PARTS} SELECT DISTINCT "group", part, parts,
  "group"[1] || lower("group"[2:]) || ' Missing Rate' || CASE WHEN parts > 1 THEN ' (Part ' || part || '/' || parts || ')' ELSE '' END AS title,
  lower(replace("group", ' ', '_')) || '_missing_rate' || CASE WHEN parts > 1 THEN '_part' || part ELSE '' END AS stem
FROM parts"""
ORACLES["report_part_counts"] = f'WITH {PARTS} SELECT "group", max(parts) AS part_count FROM parts GROUP BY "group"'

NAMES = """names AS (SELECT p_partkey,
  CASE WHEN p_size < 10 THEN 'Temperature' WHEN p_size < 20 THEN 'WindSpeed_WindSpeed' WHEN p_size < 30 THEN 'Humidity_RH'
    ELSE 'Radiation' END
  || CASE WHEN p_size % 3 = 0 THEN '_180cm' WHEN p_size % 3 = 1 THEN '_050cm' ELSE '__' END
  || '_PVHgt_090cm_' || replace(p_name, ' ', '_') || '_' || p_type || '_' || p_type || '_(No Change)' AS name FROM part)"""
_short = "name"
for _old, _new in (
    ("(Changed to Sedum lineare)", "Changed"), ("(No Change)", "NoChange"), ("Temperature", "Temp"), ("Humidity", "RH"),
    ("WindSpeed", "Ws"), ("WindDirection", "Wdir"), ("Radiation", "Rad"), ("_200cm", " SH200"), ("_180cm", " SH180"),
    ("_050cm", " SH050"), ("_090cm", " Hgt090"), ("_060cm", " Hgt060"), ("_075cm", " Hgt075"), ("PVHgt_", ""), ("_PVHgt", ""),
):
    _short = f"replace({_short}, '{_old}', '{_new}')"
ORACLES["abbreviate_names"] = f"""
WITH {NAMES}, parts AS (SELECT p_partkey, string_split(regexp_replace({_short}, '_+', '_', 'g'), '_') AS l FROM names)
SELECT p_partkey, array_to_string(list_filter(l, lambda x, i: i = 1 OR x <> l[i - 1]), '_') AS short FROM parts"""

ORACLES["wrap_names"] = f"""
WITH {NAMES} SELECT p_partkey, list_reduce(string_split(name, '_'), lambda a, x:
  CASE WHEN length(string_split(a, chr(10))[-1]) + 1 + length(x) > 30 THEN a || chr(10) || x ELSE a || '_' || x END) AS wrapped
FROM names"""

# --- a NULL key and NaN readings ---------------------------------------------------------------------


def odd(name: str) -> str:
    """The SQL of a query with NULL readings where its input has NaN, and station 3 unnamed in its result."""
    sql = ORACLES[name]
    for s in SENSORS:
        sql = sql.replace(
            f"CASE WHEN event_type = '{s}' THEN value END AS {s}",
            f"CASE WHEN event_type = '{s}' AND event_id % 71 <> 5 THEN value END AS {s}",
        )
    return f"SELECT * REPLACE (CASE WHEN station <> 3 THEN station END AS station) FROM ({sql})"


for _name in ("range_mask", "range_stats"):
    ORACLES[f"odd_{_name}"] = odd(f"qc_{_name}")
for _name in ("resample_mean", "resample_seven_hours", "interpolate_edges", "temporal_consistency", "missing_ratio"):
    ORACLES[f"odd_{_name}"] = odd(_name)
ORACLES["odd_constant_mask"] = f"""
SELECT * REPLACE (CASE WHEN station <> 'O' THEN station END AS station) FROM ({ORACLES["qc_constant_mask"]})"""
