"""Transit-shaped views derived from the warehouse tables.

Each block is plain SQL that Spark and an ANSI engine read alike. ``{lineitem}``-style marks stand for base tables;
blocks may use earlier blocks by name.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BLOCKS: dict[str, str] = {}

BLOCKS["fx_stops_raw"] = """
SELECT '85' || lpad(CAST(s_suppkey AS STRING), 5, '0') || ':0:' || CAST(p.p AS STRING) AS stop_id,
       'Stop ' || lpad(CAST(s_suppkey AS STRING), 5, '0') AS stop_name,
       CAST(46.51 AS DOUBLE) + CAST((s_suppkey * 7919) % 1000 AS DOUBLE) * 0.00002 + p.p * CAST(0.00001 AS DOUBLE) AS stop_lat,
       CAST(6.60 AS DOUBLE) + CAST((s_suppkey * 104729) % 997 AS DOUBLE) * 0.00003 AS stop_lon,
       CASE WHEN p.p = 1 THEN NULL ELSE 0 END AS location_type
FROM {supplier} CROSS JOIN (VALUES (1), (2)) p(p)
UNION ALL
SELECT 'Parent85' || lpad(CAST(s_suppkey AS STRING), 5, '0'), 'Stop ' || CAST(s_suppkey AS STRING),
       CAST(46.5 AS DOUBLE), CAST(6.6 AS DOUBLE), 1 FROM {supplier}"""

BLOCKS["fx_stop_times"] = """
SELECT trip_id, stop_sequence, stop_id, arr_sec AS arrival_time_sec, arr_sec + 30 AS departure_time_sec,
       lpad(CAST(CAST(floor(arr_sec / 3600.0) AS INT) AS STRING), 2, '0') || ':' ||
       lpad(CAST(CAST(floor((arr_sec % 3600) / 60.0) AS INT) AS STRING), 2, '0') || ':' ||
       lpad(CAST(arr_sec % 60 AS STRING), 2, '0') AS arrival_time,
       lpad(CAST(CAST(floor((arr_sec + 30) / 3600.0) AS INT) AS STRING), 2, '0') || ':' ||
       lpad(CAST(CAST(floor(((arr_sec + 30) % 3600) / 60.0) AS INT) AS STRING), 2, '0') || ':' ||
       lpad(CAST((arr_sec + 30) % 60 AS STRING), 2, '0') AS departure_time
FROM (SELECT l_orderkey AS trip_id, seq AS stop_sequence, 8500000 + l_suppkey AS stop_id,
             14400 + (l_orderkey * 37) % 72000 + (seq - 1) * (300 + (l_orderkey % 4) * 30) AS arr_sec
      FROM (SELECT l_orderkey, l_suppkey,
                   CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INT) AS seq
            FROM {lineitem}) a) b
WHERE NOT (trip_id % 97 = 0 AND stop_sequence = 2)"""

# The publisher's form: platform ids and time texts, with a few unusable rows.
BLOCKS["fx_stop_times_text"] = """
SELECT trip_id, CAST(stop_sequence AS INT) AS stop_sequence,
       CASE WHEN trip_id % 223 = 0 AND stop_sequence = 4 THEN 'Parent' || CAST(stop_id AS STRING)
            ELSE CAST(stop_id AS STRING) || ':0:' || CAST(1 + trip_id % 2 AS STRING) END AS stop_id,
       CASE WHEN trip_id % 211 = 0 AND stop_sequence = 3 THEN '' ELSE arrival_time END AS arrival_time,
       CASE WHEN trip_id % 199 = 0 AND stop_sequence = 3 THEN NULL ELSE departure_time END AS departure_time
FROM fx_stop_times"""

BLOCKS["fx_trips"] = """
SELECT o_orderkey AS trip_id, 'R' || CAST(o_orderkey % 12 AS STRING) AS route_id,
       substr(o_orderpriority, 1, 1) AS service_id
FROM {orders}"""

BLOCKS["fx_calendar"] = """
SELECT * FROM (VALUES ('1', true, true, true, true, true, false, false), ('2', true, true, true, true, true, true, true),
  ('3', false, false, false, false, false, true, true), ('4', false, true, false, true, false, false, false))
  c(service_id, monday, tuesday, wednesday, thursday, friday, saturday, sunday)"""

# Services with validity dates and exceptions: one per customer, with the dates of its orders.
BLOCKS["fx_service_calendar"] = """
SELECT 'C' || CAST(o_custkey AS STRING) AS service_id, o_custkey % 2 = 0 AS monday, o_custkey % 3 = 0 AS tuesday, o_custkey % 2 = 1 AS wednesday,
       o_custkey % 5 = 0 AS thursday, o_custkey % 3 <> 0 AS friday, o_custkey % 7 = 0 AS saturday, o_custkey % 11 = 0 AS sunday,
       min(CAST(o_orderdate AS DATE)) AS start_date, max(CAST(o_orderdate AS DATE)) AS end_date
FROM {orders} GROUP BY o_custkey"""

BLOCKS["fx_service_exceptions"] = """
SELECT DISTINCT 'C' || CAST(o_custkey AS STRING) AS service_id, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 - 20 AS INT) AS date,
       CAST(1 + o_orderkey % 2 AS INT) AS exception_type
FROM {orders}"""

# The services of fx_trips with validity dates; dear orders are their exceptions.
BLOCKS["fx_trip_calendar"] = """
SELECT c.service_id, c.monday, c.tuesday, c.wednesday, c.thursday, c.friday, c.saturday, c.sunday, v.start_date, v.end_date
FROM fx_calendar c JOIN (SELECT substr(o_orderpriority, 1, 1) AS service_id, min(CAST(o_orderdate AS DATE)) AS start_date,
                                max(CAST(o_orderdate AS DATE)) AS end_date FROM {orders} GROUP BY substr(o_orderpriority, 1, 1)) v
  ON v.service_id = c.service_id"""

BLOCKS["fx_trip_exceptions"] = """
SELECT substr(o_orderpriority, 1, 1) AS service_id, CAST(o_orderdate AS DATE) AS date, CAST(1 + min(o_orderkey) % 2 AS INT) AS exception_type
FROM {orders} WHERE o_totalprice > (SELECT avg(o_totalprice) FROM {orders})
GROUP BY substr(o_orderpriority, 1, 1), CAST(o_orderdate AS DATE)"""

BLOCKS["fx_routes"] = """
SELECT * FROM (VALUES ('R0','11','L0','S',109), ('R1','11','L1','B',700), ('R2','11','L2','T',900), ('R3','11','L3','M',401),
  ('R4','11','L4','S',106), ('R5','11','L5','B',705), ('R6','11','L6','T',900), ('R7','11','L7','M',401),
  ('R8','11','L8','B',1400), ('R9','11','L0','S',1303), ('R10','12','L1','B',702))
  r(route_id, agency_id, route_short_name, route_desc, route_type)"""

BLOCKS["fx_actuals"] = """
SELECT event_id, CAST(ts AS DATE) AS operating_day, 8500000 + 2 * user_id AS bpuic,
       'T' || CAST(event_id % 977 AS STRING) AS trip_id,
       CASE WHEN event_id % 3 = 0 THEN '11' ELSE '85:11' END AS operator_id,
       'L' || CAST(CAST(regexp_extract(props, '[0-9]+', 0) AS INT) % 10 AS STRING) AS line_text,
       CASE event_type WHEN 'click' THEN 'S' WHEN 'view' THEN 'b' WHEN 'purchase' THEN 'T' WHEN 'signup' THEN 'M' ELSE 'ZZ' END AS transport,
       event_type AS product_id, event_id % 23 = 0 AS unplanned, date_trunc('minute', ts) AS arr_time,
       CASE WHEN event_id % 29 = 0 THEN NULL
            ELSE date_trunc('minute', ts) + INTERVAL '1' SECOND *
                 (CAST(floor(value * 10) AS INT) - 240 - CASE WHEN event_id % 211 = 0 THEN 540 ELSE 0 END) END AS arr_actual,
       CASE WHEN event_id % 17 = 0 THEN 'UNBEKANNT' WHEN event_id % 13 = 0 THEN '' WHEN event_id % 19 = 0 THEN NULL ELSE 'REAL' END AS arr_status
FROM {events}"""

BLOCKS["fx_ring_edges"] = """
SELECT uuid, ring, x1, y1, x2, y2 FROM (VALUES
  ('rA', 0, 6.599, 46.509, 6.618, 46.509), ('rA', 0, 6.618, 46.509, 6.610, 46.519), ('rA', 0, 6.610, 46.519, 6.618, 46.531),
  ('rA', 0, 6.618, 46.531, 6.599, 46.531), ('rA', 0, 6.599, 46.531, 6.599, 46.509),
  ('rA', 1, 6.602, 46.515, 6.605, 46.515), ('rA', 1, 6.605, 46.515, 6.605, 46.520), ('rA', 1, 6.605, 46.520, 6.602, 46.520),
  ('rA', 1, 6.602, 46.520, 6.602, 46.515),
  ('rB', 0, 6.612, 46.512, 6.629, 46.512), ('rB', 0, 6.629, 46.512, 6.629, 46.528), ('rB', 0, 6.629, 46.528, 6.612, 46.528),
  ('rB', 0, 6.612, 46.528, 6.612, 46.512)) e(uuid, ring, x1, y1, x2, y2)"""

# Published snapshots: every table carries its own publication dates.
BLOCKS["fx_trip_snapshots"] = """
SELECT CAST(o_orderdate AS DATE) AS pub_date, o_orderkey AS trip_id, 'R' || CAST(o_orderkey % 12 AS STRING) AS route_id
FROM {orders}"""

BLOCKS["fx_stop_time_snapshots"] = """
SELECT CAST(l_shipdate AS DATE) AS pub_date, l_orderkey AS trip_id, l_linenumber AS stop_sequence,
       8500000 + l_suppkey AS stop_id
FROM {lineitem}"""

# Areas with names and levels; the nation's name repeats over levels as place names do.
BLOCKS["fx_shapes"] = """
SELECT md5('shape' || CAST(c_custkey AS STRING)) AS uuid, n_name AS name,
       CASE c_custkey % 3 WHEN 0 THEN 'district' WHEN 1 THEN 'canton' ELSE 'city' END AS level
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey"""

# Itineraries of another planner as JSON answers, one per order.
BLOCKS["fx_external_json"] = """
SELECT query_id, orig_id, dest_id,
       '{"connections":[{"from":{"departure":"2024-03-05T' || dep_t || '+0100"},"to":{"arrival":"2024-03-05T' || arr_t ||
       '+0100"},"duration":"' || CASE WHEN query_id % 50 = 0 THEN '01' ELSE '00' END || 'd' || dur_t || '","sections":[' ||
       '{"journey":{"name":"' || name1 || '"},"departure":{"station":{"name":"' || orig || '"},"departure":"2024-03-05T' || dep_t ||
       '+0100"},"arrival":{"station":{"name":"' || mid || '"},"arrival":"2024-03-05T' || mid_t || '+0100"}}' ||
       CASE WHEN query_id % 2 = 0 THEN '' ELSE
       ',{"walk":{"duration":180},"departure":{"station":{"name":"' || mid || '"},"departure":"2024-03-05T' || mid_t ||
       '+0100"},"arrival":{"station":{"name":"' || mid || '"},"arrival":"2024-03-05T' || mid_t || '+0100"}}' ||
       ',{"journey":{"name":"' || name2 || '"},"departure":{"station":{"name":"' || mid || '"},"departure":"2024-03-05T' || mid2_t ||
       '+0100"},"arrival":{"station":{"name":"' || dest || '"},"arrival":"2024-03-05T' || arr_t || '+0100"}}' END || ']}]}' AS body
FROM (SELECT o_orderkey AS query_id,
             8500000 + o_custkey % (SELECT count(*) FROM {supplier}) AS orig_id,
             8500000 + (o_custkey * 7 + 3) % (SELECT count(*) FROM {supplier}) AS dest_id,
             'L' || CAST(o_orderkey % 9 AS STRING) AS name1, 'L' || CAST(o_orderkey % 7 AS STRING) AS name2,
             CASE WHEN o_orderkey % 11 = 0 THEN 'Nowhere' ELSE
               'stop ' || lpad(CAST(o_custkey % (SELECT count(*) FROM {supplier}) AS STRING), 5, '0') END AS orig,
             CASE WHEN o_orderkey % 5 = 0 THEN lpad(CAST((o_custkey * 3 + 1) % (SELECT count(*) FROM {supplier}) AS STRING), 5, '0')
               ELSE 'Stop ' || lpad(CAST((o_custkey * 3 + 1) % (SELECT count(*) FROM {supplier}) AS STRING), 5, '0') END AS mid,
             'STOP ' || lpad(CAST((o_custkey * 7 + 3) % (SELECT count(*) FROM {supplier}) AS STRING), 5, '0') AS dest,
             lpad(CAST(6 + o_orderkey % 3 AS STRING), 2, '0') || ':' || lpad(CAST(o_orderkey % 20 AS STRING), 2, '0') || ':00' AS dep_t,
             lpad(CAST(6 + o_orderkey % 3 AS STRING), 2, '0') || ':' || lpad(CAST(20 + o_orderkey % 10 AS STRING), 2, '0') || ':00' AS mid_t,
             lpad(CAST(6 + o_orderkey % 3 AS STRING), 2, '0') || ':' || lpad(CAST(32 + o_orderkey % 8 AS STRING), 2, '0') || ':00' AS mid2_t,
             lpad(CAST(6 + o_orderkey % 3 AS STRING), 2, '0') || ':' || lpad(CAST(45 + o_orderkey % 15 AS STRING), 2, '0') || ':00' AS arr_t,
             '00:' || lpad(CAST(45 + o_orderkey % 15 - o_orderkey % 20 AS STRING), 2, '0') || ':00' AS dur_t
      FROM {orders}) j"""


_NAME = re.compile(r"\b[a-z]x_[a-z0-9_]+\b")


def needed(text: str, blocks: dict[str, str]) -> list[str]:
    """Names of the blocks that ``text`` uses, directly or through other blocks, in dependency order."""
    order: list[str] = []

    def visit(part: str) -> None:
        for name in dict.fromkeys(_NAME.findall(part)):
            if name in blocks and name not in order:
                visit(blocks[name])
                order.append(name)

    visit(text)
    return order


def with_blocks(text: str, blocks: dict[str, str] | None = None, keyword: str = "AS") -> str:
    """``text`` preceded by the blocks it uses as common table expressions."""
    blocks = BLOCKS if blocks is None else blocks
    names = needed(text, blocks)
    if not names:
        return text
    return "WITH " + ",\n".join(f"{n} {keyword} ({blocks[n]})" for n in names) + "\n" + text


_BASE = re.compile(r"\{([a-z]+)\}")


def plain_tables(text: str) -> str:
    """Base-table marks as bare names, for an engine where the tables are registered."""
    return _BASE.sub(r"\1", text)


class TransitTables:
    """The views above over one folder of Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._base: dict[str, DataFrame] = {}

    def base(self, name: str) -> DataFrame:
        if name not in self._base:
            self._base[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._base[name]

    def sql(self, text: str) -> DataFrame:
        full = with_blocks(text)
        tables = {name: self.base(name) for name in set(_BASE.findall(full))}
        literal = full.replace("{", "{{").replace("}", "}}")
        for name in tables:
            literal = literal.replace("{{" + name + "}}", "{" + name + "}")
        return self.spark.sql(literal, **tables)

    def view(self, name: str) -> DataFrame:
        return self.sql(f"SELECT * FROM {name}")
