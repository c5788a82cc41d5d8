"""DuckDB SQL of the feed queries, written from what the feeds are, not from how the library reads them."""

from __future__ import annotations

K = "CAST(regexp_extract(props, '-?[0-9]+') AS INTEGER)"
PLACE = """'{"zone":"z' || user_id % 5 || '","seen":[{"id":' || user_id || '}]}'"""


def _payload(value: str, place: str) -> str:
    return f"""'{{"event_id":' || event_id || ',"value":' || {value} || ',"ok":' || (event_id % 2 = 0) || ',"place":' || {place} || '}}'"""


NUMBER = "coalesce(CAST(value AS VARCHAR), 'null')"

SKETCHED = {"l_orderkey": True, "l_partkey": True, "l_quantity": True, "l_extendedprice": True, "l_discount": True, "l_tax": True,
            "l_shipdate": False, "l_linestatus": False}

SESSIONS = """
WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 12 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS spell FROM g),
x AS (SELECT user_id, min(ts) AS session_start, max(ts) AS last_seen, max(ts) + INTERVAL 12 HOUR AS session_end, count(*) AS n,
    min(value) AS min_value, max(value) AS max_value FROM s GROUP BY user_id, spell)
SELECT * FROM x"""

KINDS = ("integer", "number", "boolean", "date", "timestamp", "text")


def _kinds(column: str, type_: str, null: str = "0", **counts: str) -> str:
    """Counts of one column; each given as an expression over the number of rows n, or an aggregate."""
    each = ", ".join(f"CAST({counts.get(k, '0')} AS BIGINT) AS n_{k}" for k in KINDS)
    most = "greatest(" + ", ".join(f"CAST({counts.get(k, '0')} AS BIGINT)" for k in KINDS) + ")"
    return f"""SELECT '{column}' AS column_name, count(*) AS n_rows, {each}, CAST({null} AS BIGINT) AS n_null, '{type_}' AS "type",
  count(*) - CAST({null} AS BIGINT) - {most} AS n_against FROM orders"""


def _if(condition: str) -> str:
    return f"count(*) FILTER (WHERE {condition})"


CSV_TYPES = " UNION ALL ".join([
    _kinds("o_orderkey", "bigint", integer="count(*)"), _kinds("o_custkey", "bigint", integer="count(*)"),
    _kinds("o_orderstatus", "string", text="count(*)"), _kinds("o_totalprice", "double", number="count(*)"),
    _kinds("o_orderdate", "timestamp_ntz", timestamp="count(*)"), _kinds("o_orderpriority", "string", text="count(*)"),
    _kinds("line", "string", null=_if("o_orderkey % 7 >= 3"), integer=_if("o_orderkey % 7 IN (1, 2)"), text=_if("o_orderkey % 7 = 0")),
    _kinds("zone", "string", integer=_if("o_orderkey % 20 >= 10"), text=_if("o_orderkey % 20 < 10")),
    _kinds("open", "boolean", boolean="count(*)"),
    _kinds("day", "timestamp_ntz", date=_if("o_orderkey % 3 = 0"), timestamp=_if("o_orderkey % 3 <> 0")),
    _kinds("score", "double", null=_if("o_orderkey % 5 > 1"), integer=_if("o_orderkey % 5 = 0"), number=_if("o_orderkey % 5 = 1")),
    _kinds("nothing", "string", null="count(*)")])

RIDGE_CV = """
WITH d AS (SELECT CAST(l_orderkey % 5 AS INTEGER) AS fold, l_quantity - 25 AS a, l_discount - 0.05::DOUBLE AS b, l_extendedprice - 38000 AS y FROM lineitem),
t AS (SELECT f.fold, count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, avg(a * a) AS aa, avg(a * b) AS ab, avg(b * b) AS bb,
    avg(a * y) AS ay, avg(b * y) AS by_ FROM (SELECT DISTINCT fold FROM d) f JOIN d ON d.fold <> f.fold GROUP BY f.fold),
p AS (SELECT unnest([0.0, 0.01, 1.0, 100.0])::DOUBLE AS penalty),
c AS (SELECT fold, penalty, ma, mb, my, aa - ma * ma + penalty AS saa, ab - ma * mb AS sab, bb - mb * mb + penalty AS sbb,
    ay - ma * my AS say, by_ - mb * my AS sby FROM t, p),
w AS (SELECT *, (say * sbb - sby * sab) / (saa * sbb - sab * sab) AS wa, (sby * saa - say * sab) / (saa * sbb - sab * sab) AS wb FROM c)
SELECT w.fold, penalty, count(*) AS n,
  floor(sqrt(avg((y - my - wa * (a - ma) - wb * (b - mb)) ** 2)) * 1000.0::DOUBLE + 0.5::DOUBLE) / 1000.0::DOUBLE AS rmse
FROM w JOIN d ON d.fold = w.fold GROUP BY w.fold, penalty"""

SERIES = """
WITH e AS (SELECT CASE WHEN user_id % 3 = 0 THEN 'hot' ELSE event_type || '-' || user_id % 20 END AS zone, date_trunc('hour', ts) AS h, value FROM events),
m AS (SELECT zone, h, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(38, 6))) AS DOUBLE) / count(value) AS value FROM e GROUP BY zone, h),
s AS (SELECT zone, unnest(generate_series(min(h), max(h), INTERVAL 1 HOUR)) AS hour_start FROM m GROUP BY zone),
f AS (SELECT s.zone, s.hour_start, coalesce(m.n, 0) AS n, m.value, CASE WHEN m.value IS NOT NULL THEN epoch_us(s.hour_start) END AS t
      FROM s LEFT JOIN m ON m.zone = s.zone AND m.h = s.hour_start),
g AS (SELECT *, last_value(value IGNORE NULLS) OVER b AS v0, last_value(t IGNORE NULLS) OVER b AS t0,
    first_value(value IGNORE NULLS) OVER a AS v1, first_value(t IGNORE NULLS) OVER a AS t1 FROM f
  WINDOW b AS (PARTITION BY zone ORDER BY hour_start ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    a AS (PARTITION BY zone ORDER BY hour_start ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT zone, hour_start, n, value, v0 AS carried,
  coalesce(value, v0 + (v1 - v0) * (CAST(epoch_us(hour_start) - t0 AS DOUBLE) / CAST(t1 - t0 AS DOUBLE))) AS interpolated FROM g"""

FEED_ORACLE: dict[str, str] = {
    "stream_dedup": "SELECT event_id, user_id, event_type, value, ts AS event_ts FROM events",
    "stream_fusion": """
WITH c AS (SELECT event_id AS click_id, user_id, ts AS click_ts FROM events WHERE event_type = 'click'),
p AS (SELECT event_id AS purchase_id, user_id, ts AS purchase_ts, value AS amount FROM events WHERE event_type = 'purchase'),
w AS (SELECT least((SELECT max(click_ts) FROM c), (SELECT max(purchase_ts) FROM p)) - INTERVAL 72 HOUR AS mark)
SELECT c.user_id, click_id, click_ts, purchase_id, purchase_ts, amount
FROM c CROSS JOIN w LEFT JOIN p ON c.user_id = p.user_id
  AND purchase_ts BETWEEN click_ts - INTERVAL 24 HOUR AND click_ts + INTERVAL 24 HOUR
WHERE purchase_id IS NOT NULL OR click_ts + INTERVAL 24 HOUR <= mark""",
    "variant_discovery": f"""
WITH f AS (SELECT event_type AS topic, CASE {K} WHEN 0 THEN NULL WHEN 1 THEN 'null' WHEN 2 THEN '{{}}' WHEN 7 THEN 'not json'
    WHEN 8 THEN '[{{"a":1}},{{"b":"x"}}]' WHEN 10 THEN {_payload("'\"abc\"'", PLACE)}
    WHEN 11 THEN {_payload(NUMBER, "'\"nowhere\"'")} ELSE {_payload(NUMBER, PLACE)} END AS v FROM events),
n AS (SELECT topic, regexp_replace(t.fullkey, '\\[[0-9]+\\]', '[*]', 'g') AS path, t.type AS type
      FROM (SELECT topic, v FROM f WHERE json_valid(v)) g, json_tree(g.v) t
      UNION ALL SELECT topic, '$', CASE WHEN v IS NULL THEN 'missing' ELSE 'invalid' END FROM f WHERE NOT coalesce(json_valid(v), false))
SELECT topic, path, CASE type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean'
    WHEN 'NULL' THEN 'null' WHEN 'DOUBLE' THEN 'number' WHEN 'UBIGINT' THEN 'integer' WHEN 'BIGINT' THEN 'integer' ELSE type END AS kind,
  count(*) AS n FROM n GROUP BY ALL""",
    "typed_landing": f"""
WITH f AS (SELECT *, {K} AS k, coalesce({K} NOT IN (0, 1, 2, 7, 8), true) AS whole FROM events)
SELECT event_type AS topic, event_id AS "offset", CASE WHEN whole THEN event_id END AS event_id, CASE WHEN whole THEN event_id % 2 = 0 END AS ok,
  CASE WHEN whole AND k <> 10 THEN value END AS value_number, CASE WHEN k = 10 THEN '"abc"' END AS value_text,
  CASE WHEN whole AND k <> 11 THEN 'z' || user_id % 5 END AS zone, CASE WHEN k = 11 THEN '"nowhere"' END AS place_text
FROM f""",
    "offset_gaps": """
WITH d AS (SELECT event_type AS topic, CAST(event_id % 4 AS INTEGER) AS "partition", event_id // 20 AS o, count(*) AS n FROM events GROUP BY ALL),
r AS (SELECT *, o - row_number() OVER (PARTITION BY topic, "partition" ORDER BY o) AS run FROM d),
i AS (SELECT topic, "partition", min(o) AS "first", max(o) AS "last", CAST(sum(n) AS BIGINT) AS "rows", count(*) AS offsets FROM r GROUP BY topic, "partition", run)
SELECT topic, "partition", "first", "last", "rows",
  coalesce("first" - lag("last") OVER (PARTITION BY topic, "partition" ORDER BY "first") - 1, 0) AS missing, "rows" - offsets AS repeated
FROM i""",
    "pm_quarantine": """
SELECT event_id AS counter, CASE WHEN event_id % 11 >= 6 THEN ts END AS event_ts, event_id % 11 >= 6 AS valid, event_id % 11 < 6 AS kept_raw FROM events""",
    "column_sketches": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct,
  true AS distinct_within, {'true' if number else 'CAST(NULL AS BOOLEAN)'} AS quantiles_within
FROM (SELECT * REPLACE (CASE WHEN l_linenumber <> 3 THEN l_tax END AS l_tax) FROM lineitem)""" for c, number in SKETCHED.items()),
    "station_sessions": SESSIONS,
    "station_sessions_stream": SESSIONS + " WHERE session_end <= (SELECT max(ts) FROM events) - INTERVAL 72 HOUR",
    "message_number_stream": """
SELECT event_id, user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS message_number FROM events""",
    "folder_incremental": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS c_mktsegment, CAST(c_custkey % 3 AS INTEGER) AS run
FROM customer""",
    "csv_type_lattice": CSV_TYPES,
    "summary_delta": """
WITH e AS (SELECT *, CASE WHEN event_id % 7 <> 0 THEN value END AS v, least((day(ts) - 1) // 10, 2) AS due FROM events),
l AS (SELECT *, least(due + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END, 2) AS load FROM e)
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, event_type, count(*) AS n, min(v) AS min_value,
  max(v) AS max_value, CAST(sum(CAST(v AS DECIMAL(38, 6))) AS DOUBLE) / count(v) AS mean_value, count(DISTINCT load) AS loads
FROM l GROUP BY 1, 2, 3""",
    "pm_ridge_cv": RIDGE_CV,
    "series_filled": SERIES,
}
