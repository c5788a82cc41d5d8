"""Independent DuckDB SQL for each catalog query (same column names).

Conventions shared with the Spark side so values agree bit for bit:
double literals are written ``x::DOUBLE``; rounding is
``floor(x * 10^d + 0.5) / 10^d``; sums go through DECIMAL(38,6), which holds
the tables' two decimals exactly, and nulls count in no mean.
"""

from __future__ import annotations

from .feed_oracle import FEED_ORACLE

# Fixed values, written out here so that a wrong one in the library shows: labels by index, condition names.
LABELS = "['Bon', 'Moyen', 'Dégradé', 'Mauvais', 'Très mauvais']"
CONDITIONS = ("['clear', 'partly_cloudy', 'cloudy', 'overcast', 'light_rain', 'moderate_rain', 'drizzle', "
              "'thunderstorm', 'fog', 'mist', 'haze', 'light_snow', 'snow']")


def _r1(x: str, digits: int = 1) -> str:
    s = f"{10 ** digits}.0::DOUBLE"
    return f"(floor(({x}) * {s} + 0.5::DOUBLE) / {s})"


READINGS = f"""
WITH r AS (
  SELECT l_orderkey, l_linenumber,
    (l_quantity - 25.0::DOUBLE) * 2.0::DOUBLE AS temperature,
    CAST(round(l_discount * 1100.0::DOUBLE) AS INTEGER) AS humidity,
    (l_quantity - 1.0::DOUBLE) * 5.0::DOUBLE AS wind,
    CASE WHEN l_linenumber % 2 = 0 THEN (l_quantity - 1.0::DOUBLE) * 7.0::DOUBLE END AS gust,
    940.0::DOUBLE + l_extendedprice / 1000.0::DOUBLE AS pressure,
    l_quantity * 2.5::DOUBLE AS precipitation,
    l_linenumber - 1 AS aqi,
    {CONDITIONS}[CAST(l_partkey % 13 AS INTEGER) + 1] AS condition,
    l_tax * 400.0::DOUBLE AS visibility,
    l_quantity * 2.0::DOUBLE AS humidity_raw,
    CAST(month(l_shipdate) AS INTEGER) AS month, CAST(hour(l_shipdate) AS INTEGER) AS hour,
    l_returnflag AS zone, l_linenumber * 20 AS altitude,
    l_quantity, l_extendedprice
  FROM lineitem)
"""

QC = """
  COALESCE(temperature >= -20 AND temperature <= 45, false) AS temperature_valid,
  COALESCE(pressure >= 950 AND pressure <= 1050, false) AS pressure_valid,
  COALESCE(humidity >= 0 AND humidity <= 100, false) AS humidity_valid,
  COALESCE(wind <= 150, false) AS wind_valid,
  COALESCE(precipitation < 100, false) AS precipitation_valid
"""

ROUTED = """
WITH m AS (
  SELECT e.event_type AS topic, CAST(e.user_id % 4 AS INTEGER) AS partition, e.event_id AS "offset",
         e.ts, c.c_acctbal, r.r_name, n.n_nationkey
  FROM events e
  LEFT JOIN customer c ON c.c_custkey = e.user_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey),
x AS (
  SELECT *,
    substr(sha256(concat_ws('-', topic, CAST(partition AS VARCHAR), CAST("offset" AS VARCHAR))), 1, 8) AS message_id,
    COALESCE(topic = 'click' AND c_acctbal >= 0, false) AS is_weather,
    replace(coalesce(r_name, 'unknown_zone'), ' ', '_') AS zone_slug,
    coalesce(lpad(CAST(n_nationkey AS VARCHAR), 2, '0'), 'unknown_dept') AS dept_v,
    strftime(ts, '%Y-%m-%d') AS date
  FROM m)
"""

SEASON = """CASE WHEN {m} IN (12, 1, 2) THEN 'winter' WHEN {m} IN (3, 4, 5) THEN 'spring'
       WHEN {m} IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END"""

EVENT_K = "CAST(json_extract(props, '$.k') AS INTEGER)"

PARTS = """CAST(year({t}) AS INTEGER) AS year, CAST(month({t}) AS INTEGER) AS month,
  CAST(day({t}) AS INTEGER) AS day"""


def _sum(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(38,6))) AS DOUBLE)"


def _mean(x: str) -> str:
    return f"{_sum(x)} / nullif(count({x}), 0)"


def _column_stats(cols) -> str:
    parts = []
    for c in cols:
        x = "(CASE WHEN l_linenumber % 3 <> 0 THEN l_discount END)" if c == "l_discount" else c
        parts.append(
            f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({x}) AS n_null, "
            f"min(CAST({x} AS DOUBLE)) AS min_value, max(CAST({x} AS DOUBLE)) AS max_value, "
            f"{_mean(x)} AS mean_value FROM lineitem")
    return "\nUNION ALL\n".join(parts)


_season_o = SEASON.format(m="month(o_orderdate)")
_season_e = SEASON.format(m="month(ts)")
_diurnal = "sin(((hour(ts) - 6) * pi()) / 12.0::DOUBLE) * 4.0::DOUBLE"
_base = f"""CASE {_season_e} WHEN 'winter' THEN 5.0::DOUBLE WHEN 'spring' THEN 12.0::DOUBLE
  WHEN 'summer' THEN 22.0::DOUBLE ELSE 12.0::DOUBLE END"""
_expected = _r1(f"({_base} + {_diurnal}) + CASE WHEN event_type = 'click' THEN 2 ELSE 0 END")
_empty_re = r"^\s*(null|false|\"\"|\{\s*\}|\[\s*\]|-?0+(\.0*)?([eE][+-]?[0-9]+)?)?\s*$"
_frac = "epoch_us(ts) % 1000000"

_season_r = SEASON.format(m="month")
_base_r = f"""CASE {_season_r} WHEN 'winter' THEN 5.0::DOUBLE WHEN 'spring' THEN 12.0::DOUBLE
  WHEN 'summer' THEN 22.0::DOUBLE ELSE 12.0::DOUBLE END"""
_diurnal_r = "sin(((hour - 6) * pi()) / 12.0::DOUBLE) * 4.0::DOUBLE"
_uhi_r = "CASE WHEN zone IS NULL THEN NULL WHEN zone = 'R' THEN 2 ELSE 0 END"
_vis_lo = """CASE condition WHEN 'fog' THEN 0.1::DOUBLE WHEN 'mist' THEN 1.0::DOUBLE WHEN 'moderate_rain' THEN 3.0::DOUBLE
    WHEN 'light_rain' THEN 8.0::DOUBLE ELSE 15.0::DOUBLE END"""
_vis_hi = """CASE condition WHEN 'fog' THEN 1.0::DOUBLE WHEN 'mist' THEN 8.0::DOUBLE WHEN 'moderate_rain' THEN 8.0::DOUBLE
    WHEN 'light_rain' THEN 15.0::DOUBLE ELSE 35.0::DOUBLE END"""
_daylight_r = "hour BETWEEN 7 AND 17"

INDICATORS = READINGS + f"""
SELECT l_orderkey, l_linenumber,
  {_r1('temperature - (100.0::DOUBLE - humidity) / 5.0::DOUBLE')} AS dew_point_c,
  {_r1('CASE WHEN wind > 10.0::DOUBLE THEN temperature - wind * 0.15::DOUBLE ELSE temperature END')} AS feels_like_c,
  array_to_string(list_transform(string_split(replace(condition, '_', ' '), ' '),
                                 lambda w: upper(w[1]) || lower(w[2:])), ' ') AS condition_description,
  CASE WHEN condition IS NULL THEN NULL WHEN contains(condition, 'rain') THEN 'rain'
    WHEN contains(condition, 'snow') THEN 'snow' ELSE 'none' END AS precipitation_type,
  CASE WHEN precipitation IS NULL THEN NULL WHEN precipitation < 2.5::DOUBLE THEN 'light'
    WHEN precipitation < 7.5::DOUBLE THEN 'moderate' ELSE 'heavy' END AS precipitation_intensity,
  {_season_r} AS season,
  {_r1(f'({_base_r} + {_diurnal_r}) + {_uhi_r}')} AS expected_temp_c,
  {_daylight_r} AS daylight,
  ({_daylight_r}) AND condition IN ('clear', 'partly_cloudy') AS uv_possible,
  {_r1('1013.25::DOUBLE - altitude * 0.12::DOUBLE')} AS expected_pressure_hpa,
  CASE WHEN aqi BETWEEN 1 AND 5 THEN {LABELS}[aqi] END AS air_quality_label,
  COALESCE(visibility BETWEEN {_vis_lo} AND {_vis_hi}, false) AS visibility_plausible,
  coalesce(gust, wind) AS gust_kmh
FROM r"""

# OLS with intercept in closed form: centred cross-products, Cramer's rule.
REGRESSION = f"""
WITH l AS (SELECT l_quantity AS q, l_discount AS d, l_tax AS t, l_extendedprice AS y FROM lineitem
           WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL AND l_tax IS NOT NULL
             AND l_extendedprice IS NOT NULL),
m AS (SELECT avg(q) AS mq, avg(d) AS md, avg(t) AS mt, avg(y) AS my, count(*) AS n FROM l),
c AS (SELECT sum((q-mq)*(q-mq)) AS a11, sum((q-mq)*(d-md)) AS a12, sum((q-mq)*(t-mt)) AS a13,
             sum((d-md)*(d-md)) AS a22, sum((d-md)*(t-mt)) AS a23, sum((t-mt)*(t-mt)) AS a33,
             sum((q-mq)*(y-my)) AS b1, sum((d-md)*(y-my)) AS b2, sum((t-mt)*(y-my)) AS b3,
             sum((y-my)*(y-my)) AS syy, any_value(mq) AS mq, any_value(md) AS md, any_value(mt) AS mt,
             any_value(my) AS my, any_value(n) AS n FROM l, m),
s AS (SELECT *, a11*(a22*a33-a23*a23) - a12*(a12*a33-a23*a13) + a13*(a12*a23-a22*a13) AS det FROM c),
x AS (SELECT *,
  (b1*(a22*a33-a23*a23) - a12*(b2*a33-a23*b3) + a13*(b2*a23-a22*b3)) / det AS c1,
  (a11*(b2*a33-a23*b3) - b1*(a12*a33-a23*a13) + a13*(a12*b3-b2*a13)) / det AS c2,
  (a11*(a22*b3-b2*a23) - a12*(a12*b3-b2*a13) + b1*(a12*a23-a22*a13)) / det AS c3 FROM s),
f AS (SELECT *, my - c1*mq - c2*md - c3*mt AS c0, syy - (c1*b1 + c2*b2 + c3*b3) AS sse FROM x)
SELECT 'intercept' AS term, {_r1('c0', 3)} AS estimate FROM f
UNION ALL SELECT 'l_quantity', {_r1('c1', 3)} FROM f
UNION ALL SELECT 'l_discount', {_r1('c2', 3)} FROM f
UNION ALL SELECT 'l_tax', {_r1('c3', 3)} FROM f
UNION ALL SELECT 'r2', {_r1('1 - sse / syy', 9)} FROM f
UNION ALL SELECT 'rmse', {_r1('sqrt(sse / n)', 3)} FROM f"""

ORACLE: dict[str, str] = {
    "stream_ingest": f"""
SELECT event_id, user_id, event_type, value, props, ts AS event_ts, {PARTS.format(t='ts')},
  CAST(hour(ts) AS INTEGER) AS hour FROM events""",
    "partitioned_write": f"SELECT *, {PARTS.format(t='ts')} FROM events",
    "batch_partition_cols": "SELECT *, 2025 AS year, 7 AS month, 2 AS day FROM orders",
    "csv_scan": "SELECT * FROM customer",
    "csv_scan_inferred": """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, CAST(c_nationkey AS INTEGER) AS c_nationkey,
  c_acctbal, c_mktsegment FROM customer""",
    "csv_folder_ingest": """
SELECT 'region' AS dataset, true AS ok, (SELECT count(*) FROM region) AS n_rows, * FROM region
UNION ALL BY NAME SELECT 'nation' AS dataset, true AS ok, (SELECT count(*) FROM nation) AS n_rows, * FROM nation
UNION ALL BY NAME SELECT 'supplier' AS dataset, true AS ok, (SELECT count(*) FROM supplier) AS n_rows, * FROM supplier
UNION ALL BY NAME SELECT 'customer' AS dataset, true AS ok, (SELECT count(*) FROM customer) AS n_rows, * FROM customer
UNION ALL BY NAME SELECT 'nothing' AS dataset, false AS ok, 0 AS n_rows""",
    "csv_folder_uniform": """
WITH l AS (SELECT * REPLACE (CASE WHEN l_linenumber <> 7 THEN l_returnflag END AS l_returnflag) FROM lineitem)
SELECT 'lineitem_' || coalesce(l_returnflag, 'none') AS dataset, * FROM l""",
    "pm_parse": """
SELECT event_type AS station, ts AS event_ts, CAST(floor(value) AS INTEGER) AS pm10,
  CAST(floor(value / 2.0::DOUBLE) AS INTEGER) AS pm25, event_id AS counter FROM events""",
    "hourly_spine": """
WITH b AS (SELECT date_trunc('hour', min(ts)) AS lo, date_trunc('hour', max(ts)) AS hi FROM events),
s AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour_start FROM b),
c AS (SELECT date_trunc('hour', ts) AS hour_start, count(*) AS n_events FROM events GROUP BY 1)
SELECT s.hour_start, coalesce(c.n_events, 0) AS n_events FROM s LEFT JOIN c ON s.hour_start = c.hour_start""",
    "kafka_encode": "SELECT c_name AS key, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "json_flatten": f"SELECT event_id, {EVENT_K} AS k FROM events",
    "drop_empty": f"""
WITH f AS (SELECT event_id, event_type, {EVENT_K} AS k FROM events),
p AS (SELECT event_id, event_type, CASE k WHEN 0 THEN NULL WHEN 1 THEN 'null' WHEN 2 THEN '{{}}'
  WHEN 3 THEN '[]' WHEN 4 THEN '""' WHEN 5 THEN '0' WHEN 6 THEN ' {{ }} ' WHEN 7 THEN 'not json'
  WHEN 8 THEN '[{{"a":1}},{{"b":2}}]' WHEN 11 THEN '0.0' WHEN 12 THEN 'false'
  ELSE '{{"event_id":' || event_id || '}}' END AS payload FROM f)
SELECT event_id AS "offset", event_type AS topic FROM p
WHERE payload IS NOT NULL AND NOT regexp_matches(payload, '{_empty_re}')""",
    "nested_project": """
SELECT CAST(c_custkey AS VARCHAR) AS reading_id, c_name AS station_name, c_mktsegment AS zone,
  lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS department, c_acctbal AS temp_c FROM customer""",
    "nested_default": """
SELECT CAST(c_custkey AS VARCHAR) AS reading_id,
  CASE WHEN c_acctbal >= 0 THEN c_name ELSE 'Station inconnue' END AS station_name,
  CASE WHEN c_mktsegment <> 'AUTOMOBILE' THEN c_mktsegment ELSE 'unknown_zone' END AS zone,
  CASE WHEN c_acctbal >= 1000 THEN c_acctbal END AS temp_c FROM customer""",
    "route_path": ROUTED + """
SELECT topic, partition, "offset", CASE WHEN is_weather THEN 'weather' ELSE 'kafka' END AS layout,
  CASE WHEN is_weather
    THEN 'weather/' || zone_slug || '/dept_' || dept_v || '/' || date || '/hour_' || strftime(ts, '%H') || '/' || message_id || '.json'
    ELSE 'kafka/' || topic || '/' || date || '/' || strftime(ts, '%H-%M-%S') || '_' || message_id || '.json'
  END AS object_path FROM x""",
    "topic_routing": ROUTED + """
SELECT CASE WHEN is_weather THEN 'weather' ELSE 'kafka' END AS layout, topic, partition, "offset", message_id,
  CASE WHEN is_weather THEN zone_slug END AS zone, CASE WHEN is_weather THEN dept_v END AS dept, date FROM x""",
    "event_time_parts": f"""
SELECT event_id, ts AS event_ts, {PARTS.format(t='ts')}, CAST(hour(ts) AS INTEGER) AS hour FROM events""",
    "format_ts": f"""
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_str, strftime(ts, '%H-%M-%S') AS time_str,
  strftime(ts, '%H') AS hour_str, strftime(ts, '%Y-%m-%d %H:%M:%S') AS datetime_str,
  strftime(ts, '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN {_frac} <> 0 THEN '.' || lpad(CAST({_frac} AS VARCHAR), 6, '0') ELSE '' END
    || 'Z' AS iso_str FROM events""",
    "season": f"""
SELECT o_orderkey, {_season_o} AS season,
  CASE WHEN {_season_o} = 'winter' THEN 75 ELSE 65 END AS humidity_base FROM orders""",
    "daylight": """
SELECT event_id, hour(ts) BETWEEN 7 AND 17 AS daylight, event_type IN ('view', 'click') AS clear_sky,
  (hour(ts) BETWEEN 7 AND 17) AND event_type IN ('view', 'click') AS uv_possible FROM events""",
    "expected_temp": f"""
SELECT event_id, {_expected} AS expected_temp_c, {_r1(f'value - {_expected}')} AS anomaly_c FROM events""",
    "expected_pressure": f"""
SELECT p_partkey, {_r1('1013.25::DOUBLE - (p_size * 3) * 0.12::DOUBLE')} AS expected_pressure_hpa FROM part""",
    "clamp": READINGS + """
SELECT l_orderkey, l_linenumber, CASE WHEN humidity_raw IS NULL THEN NULL
  ELSE least(95.0::DOUBLE, greatest(30.0::DOUBLE, humidity_raw)) END AS humidity_clamped FROM r""",
    "dew_point": READINGS + f"""
SELECT l_orderkey, l_linenumber, {_r1('temperature - (100.0::DOUBLE - humidity) / 5.0::DOUBLE')} AS dew_point_c FROM r""",
    "feels_like": READINGS + f"""
SELECT l_orderkey, l_linenumber,
  {_r1('CASE WHEN wind > 10.0::DOUBLE THEN temperature - wind * 0.15::DOUBLE ELSE temperature END')} AS feels_like_c FROM r""",
    "precip_type": READINGS + """
SELECT l_orderkey, l_linenumber, condition, CASE WHEN condition IS NULL THEN NULL
  WHEN contains(condition, 'rain') THEN 'rain' WHEN contains(condition, 'snow') THEN 'snow'
  ELSE 'none' END AS precipitation_type FROM r""",
    "precip_intensity": READINGS + """
SELECT l_orderkey, l_linenumber, CASE WHEN precipitation IS NULL THEN NULL
  WHEN precipitation < 2.5::DOUBLE THEN 'light' WHEN precipitation < 7.5::DOUBLE THEN 'moderate'
  ELSE 'heavy' END AS precipitation_intensity FROM r""",
    "aqi_label": READINGS + f"""
SELECT l_orderkey, l_linenumber, aqi,
  CASE WHEN aqi BETWEEN 1 AND 5 THEN {LABELS}[aqi] END AS air_quality_label FROM r""",
    "visibility_plausible": READINGS + """
SELECT l_orderkey, l_linenumber, COALESCE(visibility BETWEEN
  CASE condition WHEN 'fog' THEN 0.1::DOUBLE WHEN 'mist' THEN 1.0::DOUBLE WHEN 'moderate_rain' THEN 3.0::DOUBLE
    WHEN 'light_rain' THEN 8.0::DOUBLE ELSE 15.0::DOUBLE END
  AND CASE condition WHEN 'fog' THEN 1.0::DOUBLE WHEN 'mist' THEN 8.0::DOUBLE WHEN 'moderate_rain' THEN 8.0::DOUBLE
    WHEN 'light_rain' THEN 15.0::DOUBLE ELSE 35.0::DOUBLE END, false) AS visibility_plausible FROM r""",
    "condition_title": READINGS + """
SELECT l_orderkey, l_linenumber,
  array_to_string(list_transform(string_split(replace(condition, '_', ' '), ' '),
                                 lambda w: upper(w[1]) || lower(w[2:])), ' ') AS condition_description FROM r""",
    "pollutant_unpivot": """
SELECT l_orderkey, l_linenumber, 'PM10' AS pollutant, CAST(floor(l_quantity) AS INTEGER) AS concentration FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'PM2.5', CAST(floor(l_quantity / 2.0::DOUBLE) AS INTEGER) FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'NO2', CAST(floor(l_extendedprice / 1000.0::DOUBLE) AS INTEGER) FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'O3', CAST(floor(l_extendedprice / 600.0::DOUBLE) AS INTEGER) FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'SO2', l_linenumber * 3 FROM lineitem
UNION ALL SELECT l_orderkey, l_linenumber, 'CO', CAST(floor(l_extendedprice / 50.0::DOUBLE) AS INTEGER) FROM lineitem""",
    "weather_indicators": INDICATORS,
    "short_id": """
SELECT event_id, 'PAR-' || substr(sha256(concat_ws('-', event_type, CAST(user_id % 4 AS VARCHAR),
  CAST(event_id AS VARCHAR))), 1, 8) AS reading_id FROM events""",
    "qc_flags": READINGS + f""", q AS (SELECT l_orderkey, l_linenumber, {QC} FROM r)
SELECT *, temperature_valid AND pressure_valid AND humidity_valid AND wind_valid AND precipitation_valid AS all_valid FROM q""",
    "qc_split": READINGS + f""", q AS (SELECT l_orderkey, l_linenumber, {QC} FROM r)
SELECT l_orderkey, l_linenumber, CASE WHEN ok THEN 'valid' ELSE 'rejected' END AS side, concat_ws(',',
  CASE WHEN NOT temperature_valid THEN 'temperature_valid' END,
  CASE WHEN NOT pressure_valid THEN 'pressure_valid' END,
  CASE WHEN NOT humidity_valid THEN 'humidity_valid' END,
  CASE WHEN NOT wind_valid THEN 'wind_valid' END,
  CASE WHEN NOT precipitation_valid THEN 'precipitation_valid' END) AS failed_rules
FROM (SELECT *, temperature_valid AND pressure_valid AND humidity_valid AND wind_valid AND precipitation_valid AS ok
      FROM q) s""",
    "dim_enrich": """
SELECT c_custkey, c_name, n_name, r_name FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "gold_fusion": f"""
SELECT c.c_custkey, c.c_name, n.n_name, coalesce(a.order_count, 0) AS order_count, a.total_price, a.mean_price,
  a.last_order_date
FROM customer c
LEFT JOIN (SELECT o_custkey, count(*) AS order_count, {_sum('p')} AS total_price, {_mean('p')} AS mean_price,
                  max(o_orderdate) AS last_order_date
           FROM (SELECT *, CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS p FROM orders) o
           GROUP BY o_custkey) a ON a.o_custkey = c.c_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "row_count": "SELECT count(*) AS row_count FROM lineitem",
    "column_stats": _column_stats(["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]),
    "ingest_report": f"""
WITH f AS (SELECT event_type, ts, {EVENT_K} AS k FROM events)
SELECT event_type AS dataset, count(*) AS n_records,
  count(*) FILTER (WHERE k NOT IN (7, 8, 9)) AS n_valid,
  count(*) FILTER (WHERE k IN (7, 8, 9)) AS n_quarantined,
  min(ts) FILTER (WHERE k NOT IN (7, 8, 9)) AS first_event_ts,
  max(ts) FILTER (WHERE k NOT IN (7, 8, 9)) AS last_event_ts,
  count(*) FILTER (WHERE k IN (7, 8, 10)) AS n_corrupt
FROM f WHERE k NOT IN (0, 1, 2, 3, 4, 5, 6, 11, 12) GROUP BY event_type""",
    "hourly_summary": f"""
SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
  event_type, count(*) AS n, min(v) AS min_value, max(v) AS max_value, {_mean('v')} AS mean_value
FROM (SELECT *, CASE WHEN event_id % 7 <> 0 THEN value END AS v FROM events) e GROUP BY 1, 2, event_type""",
    "hourly_summary_stream": f"""
WITH s AS (
  SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
    event_type, count(*) AS n, min(v) AS min_value, max(v) AS max_value, {_mean('v')} AS mean_value
  FROM (SELECT *, CASE WHEN event_id % 7 <> 0 THEN value END AS v FROM events) e GROUP BY 1, 2, event_type)
SELECT * FROM s WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 72 HOUR""",
    "pm_regression": REGRESSION,
    "message_number": """
SELECT event_id, user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS message_number
FROM events""",
    **FEED_ORACLE,
}
