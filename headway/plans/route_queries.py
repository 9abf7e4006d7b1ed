"""Routes after the search: legs, replay, confidence and map data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import cut_lineage
from ..operators import distributions as ds
from ..operators import legs as lg
from ..operators import search
from . import shared
from .registry import ORACLE_BLOCKS as B
from .registry import query
from .scalar_queries import p_connection_sql, resolve_sql
from .search_queries import LATEST_ROUNDS, requests, routes
from .shared import rounded, rounded_sql


def parts(t, panel: str = "own"):
    return lg.collapse_legs(lg.route_legs(routes(t, panel)))


def add_parts(name: str) -> None:
    p = f"ox_{name}_"
    B[p + "parts"] = f"""
SELECT query_id, option, start_id, end_id, q, part, arg_min(kind, leg_no) AS kind, arg_min(from_stop, leg_no) AS from_stop,
       min(CASE WHEN first THEN trip_id END) AS trip_id, min(CASE WHEN first THEN label END) AS label,
       min(CASE WHEN first THEN line_text END) AS line_text, arg_min(dep_sec, leg_no) AS dep_sec,
       arg_max(to_stop, leg_no) AS to_stop, arg_max(arr_sec, leg_no) AS arr_sec, sum(walk_m) AS walk_m
FROM (SELECT *, sum(CASE WHEN first THEN 1 ELSE 0 END) OVER (PARTITION BY query_id, option ORDER BY leg_no) AS part
      FROM (SELECT *, NOT coalesce(kind = 'ride' AND lag(kind) OVER w = 'ride' AND (trip_id = lag(trip_id) OVER w OR label = lag(label) OVER w),
                                   false) AS first
            FROM ox_{name}_legs WINDOW w AS (PARTITION BY query_id, option ORDER BY leg_no)) a) b GROUP BY ALL"""
    B[p + "changes"] = f"""
SELECT query_id, option, part, alight_stop, alight_sec, from_stop AS board_stop, dep_sec AS board_sec, trip_id, line_text,
       dep_sec - alight_sec AS slack_sec
FROM (SELECT *, lag(to_stop) OVER w AS alight_stop, lag(arr_sec) OVER w AS alight_sec, lag(trip_id) OVER w AS before
      FROM {p}parts WHERE kind = 'ride' WINDOW w AS (PARTITION BY query_id, option ORDER BY part)) r
WHERE before IS NOT NULL AND before <> trip_id"""
    B[p + "success"] = f"""
SELECT r.query_id, r.option, r.q, r.conf, r.t AS dep_sec, r.n_transfers, r.walk_m, r.start_id, r.end_id,
       coalesce(s.success, 1e0) AS success, coalesce(s.n_changes, 0) AS n_changes
FROM {p}routes r LEFT JOIN (
  SELECT query_id, option, product(share) AS success, count(*) AS n_changes FROM (
    SELECT c.query_id, c.option, c.part, coalesce(avg(CASE WHEN c.board_sec >= c.alight_sec + h.arr_delay_sec THEN 1e0
             WHEN h.arr_delay_sec IS NOT NULL THEN 0e0 END), CASE WHEN c.slack_sec >= 0 THEN 1e0 ELSE 0e0 END) AS share
    FROM {p}changes c LEFT JOIN ox_holdout h ON h.bpuic = c.alight_stop AND h.hour_of_day = (c.alight_sec // 3600) % 24
    GROUP BY c.query_id, c.option, c.part, c.slack_sec) x GROUP BY query_id, option) s USING (query_id, option)"""


for _name in ("own", "ladder", "walks", "external"):
    add_parts(_name)

_OPTION = "query_id, CAST(option AS INTEGER) AS option"
_PART = f"{_OPTION}, CAST(part AS INTEGER) AS part"


@query("collapse_legs", f"""
SELECT {_PART}, kind, from_stop, to_stop, trip_id, label, dep_sec, arr_sec, {rounded_sql(['walk_m'], 3)} FROM ox_own_parts""")
def collapse_legs(t):
    return parts(t).select("query_id", "option", "part", "kind", "from_stop", "to_stop", "trip_id", "label", "dep_sec", "arr_sec",
                           *rounded(["walk_m"], 3))


@query("line_sequence", f"SELECT {_OPTION}, lines FROM ox_own_routes WHERE lines <> ''")
def line_sequence(t):
    return lg.line_sequences(parts(t))


@query("first_last_event", f"""
SELECT {_OPTION}, min(dep_sec) AS dep_sec, coalesce(max(CASE WHEN kind = 'ride' THEN arr_sec END), max(dep_sec)) AS arr_sec
FROM ox_own_parts GROUP BY query_id, option""")
def first_last_event(t):
    return lg.first_last_event(parts(t))


@query("endpoint_stops", f"""
SELECT {_OPTION}, arg_min(from_stop, part) AS first_stop, arg_max(to_stop, part) AS last_stop FROM ox_own_parts GROUP BY query_id, option""")
def endpoint_stops(t):
    return lg.endpoint_stops(parts(t))


def hhmm_sql(c: str) -> str:
    return f"lpad(CAST({c} // 3600 AS VARCHAR), 2, '0') || ':' || lpad(CAST(({c} % 3600) // 60 AS VARCHAR), 2, '0')"


for _name in ("own", "external"):
    B[f"ox_{_name}_times"] = f"""
SELECT query_id, option, min(dep_sec) AS dep_sec, coalesce(max(CASE WHEN kind = 'ride' THEN arr_sec END), max(dep_sec)) AS arr_sec
FROM ox_{_name}_parts GROUP BY query_id, option"""


@query("route_summary", f"""
SELECT r.query_id, CAST(r.option AS INTEGER) AS option, {hhmm_sql('e.dep_sec')} AS departs, {hhmm_sql('e.arr_sec')} AS arrives,
       (e.arr_sec - e.dep_sec) // 60 AS minutes, r.conf, CAST(r.n_transfers AS INTEGER) AS n_transfers, r.walk_m,
       a.stop_name AS start_name, z.stop_name AS end_name
FROM ox_own_routes r JOIN ox_own_times e USING (query_id, option) LEFT JOIN ox_region_stops a ON a.stop_id = r.start_id
LEFT JOIN ox_region_stops z ON z.stop_id = r.end_id""")
def route_summary(t):
    return lg.route_summary(routes(t), parts(t), shared.prepared(t).stops)


@query("replayed_success", f"SELECT {_OPTION}, n_changes, {rounded_sql(['success'], 9)} FROM ox_own_success")
def replayed_success(t):
    out = lg.replayed_success(routes(t), lg.transfers(parts(t)), shared.holdout_part(t))
    return out.select("query_id", "option", "n_changes", *rounded(["success"], 9))


B["ox_own_checks"] = """
SELECT k.*, CASE r.day WHEN 'saturday' THEN 'saturday' WHEN 'sunday' THEN 'sunday' ELSE 'weekday' END AS dow_bucket,
       CAST((alight_sec // 3600) % 24 AS INTEGER) AS hour_of_day, CAST(NULL AS VARCHAR) AS product_id_clean
FROM (SELECT query_id, option, part, 'change' AS what, alight_stop AS bpuic, alight_sec, slack_sec, line_text FROM ox_own_changes
      UNION ALL
      SELECT p.query_id, option, part + 1000, 'arrival', to_stop, arr_sec, r.deadline_sec - arr_sec, line_text
      FROM ox_own_parts p JOIN ox_requests_own r USING (query_id)
      WHERE kind = 'ride' AND part = (SELECT max(part) FROM ox_own_parts x WHERE x.kind = 'ride' AND x.query_id = p.query_id
                                      AND x.option = p.option)) k JOIN ox_requests_own r USING (query_id)"""
B["ox_own_checked"] = resolve_sql("ox_own_checks")
B["ox_own_scored_checks"] = f"""
SELECT query_id, option, part, what, bpuic, alight_sec, slack_sec, coalesce({p_connection_sql('d.slack_sec', 'd.', 'd.')}, 1e0) AS p
FROM ox_own_checked d"""


@query("confidence_breakdown", f"""
SELECT {_PART}, what, bpuic, alight_sec, slack_sec, round(p, 9) + 0e0 AS p,
       round(product(p) OVER (PARTITION BY query_id, option ORDER BY part), 9) + 0e0 AS p_so_far FROM ox_own_scored_checks""")
def confidence_breakdown(t):
    out = lg.confidence_breakdown(parts(t), requests(t, "own"), shared.prepared(t).delay_levels, shared.prepared(t).delay_features)
    return out.select("query_id", "option", "part", "what", "bpuic", "alight_sec", "slack_sec", *rounded(["p", "p_so_far"], 9))


@query("route_confidence", f"""
SELECT r.query_id, CAST(r.option AS INTEGER) AS option, r.conf, round(coalesce(c.p, 1e0), 9) + 0e0 AS recomputed
FROM ox_own_routes r LEFT JOIN (SELECT query_id, option, product(p) AS p FROM ox_own_scored_checks GROUP BY ALL) c USING (query_id, option)""")
def route_confidence(t):
    out = lg.route_confidence(routes(t), parts(t), requests(t, "own"), shared.prepared(t).delay_levels, shared.prepared(t).delay_features)
    return out.select("query_id", "option", "conf", *rounded(["recomputed"], 9))


_COORDS = ["from_lat", "from_lon", "to_lat", "to_lon"]
B["ox_own_coords"] = """
SELECT p.*, a.stop_lat AS from_lat, a.stop_lon AS from_lon, a.stop_name AS from_name, z.stop_lat AS to_lat, z.stop_lon AS to_lon,
       z.stop_name AS to_name
FROM ox_own_parts p LEFT JOIN ox_region_stops a ON a.stop_id = p.from_stop LEFT JOIN ox_region_stops z ON z.stop_id = p.to_stop"""


@query("legs_with_stop_coords", f"SELECT {_PART}, from_stop, to_stop, from_name, to_name, {rounded_sql(_COORDS)} FROM ox_own_coords")
def legs_with_stop_coords(t):
    return lg.legs_with_coords(parts(t), shared.prepared(t).stops).select(
        "query_id", "option", "part", "from_stop", "to_stop", "from_name", "to_name", *rounded(_COORDS))


@query("route_segments", f"""
SELECT {_PART}, kind, label, {rounded_sql(_COORDS)} FROM ox_own_coords WHERE from_lat IS NOT NULL AND to_lat IS NOT NULL""")
def route_segments(t):
    return lg.route_segments(parts(t), shared.prepared(t).stops).select("query_id", "option", "part", "kind", "label", *rounded(_COORDS))


B["ox_own_events"] = """
SELECT e.*, s.stop_name, s.stop_lat, s.stop_lon FROM (
  SELECT query_id, option, part, kind, coalesce(trip_id, 'walk') AS trip, 0 AS side, from_stop AS stop_id, dep_sec AS sec FROM ox_own_parts
  UNION ALL SELECT query_id, option, part, kind, coalesce(trip_id, 'walk'), 1, to_stop, CASE WHEN kind = 'ride' THEN arr_sec ELSE dep_sec END
  FROM ox_own_parts) e JOIN ox_region_stops s USING (stop_id)"""


@query("transfer_points", f"""
SELECT query_id, stop_id, CAST(option AS INTEGER) AS option, sec, stop_name, {rounded_sql(['stop_lat', 'stop_lon'])} FROM (
  SELECT e.*, row_number() OVER (PARTITION BY e.query_id, e.stop_id ORDER BY e.option, e.part, e.side) AS n
  FROM ox_own_events e
  LEFT JOIN ox_own_parts b ON b.query_id = e.query_id AND b.option = e.option AND b.part = e.part - 1
  JOIN (SELECT query_id, arg_min(from_stop, part) AS first_stop, arg_max(to_stop, part) AS last_stop FROM ox_own_parts WHERE option = 1
        GROUP BY query_id) x ON x.query_id = e.query_id
  WHERE e.stop_id <> x.first_stop AND e.stop_id <> x.last_stop
    AND ((b.part IS NULL AND e.kind = 'ride') OR coalesce(b.trip_id, CASE WHEN b.part IS NOT NULL THEN 'walk' END) <> e.trip)
    AND (e.kind = 'walk' OR e.side = 0)) z WHERE n = 1""")
def transfer_points(t):
    return lg.transfer_points(parts(t), shared.prepared(t).stops).select(
        "query_id", "stop_id", "option", "sec", "stop_name", *rounded(["stop_lat", "stop_lon"]))


_EXTENT = ["center_lat", "center_lon", "south", "west", "north", "east"]


@query("map_extent", f"""
SELECT query_id, {rounded_sql(_EXTENT, 10)} FROM (
  SELECT query_id, avg(stop_lat) AS center_lat, avg(stop_lon) AS center_lon, min(stop_lat) - 0.002e0 AS south, min(stop_lon) - 0.002e0 AS west,
         max(stop_lat) + 0.002e0 AS north, max(stop_lon) + 0.002e0 AS east FROM ox_own_events GROUP BY query_id) m""")
def map_extent(t):
    return lg.map_extent(parts(t), shared.prepared(t).stops).select("query_id", *rounded(_EXTENT, 10))


@query("network_walk_seed", f"""
SELECT r.query_id, w.a_stop_id AS stop_id, {rounded_sql(['distance_m'], 4)}, r.deadline_sec - w.walk_sec AS latest_sec
FROM ox_requests_own r JOIN ox_walks w ON w.b_stop_id = r.end_id WHERE w.distance_m <= r.max_walk_m""")
def network_walk_seed(t):
    return lg.network_walk_seed(requests(t, "own"), shared.prepared(t).walking_edges).select(
        "query_id", "stop_id", *rounded(["distance_m"], 4), "latest_sec")


B["ox_audit"] = f"""
SELECT r.query_id, r.q, r.deadline_sec, c.dep_time_sec AS dep, c.arr_time_sec AS arr, b.best, {p_connection_sql('(r.deadline_sec - c.arr_time_sec)', 'd.', 'd.')} AS p
FROM ox_requests_own r JOIN ox_connections c ON c.arr_stop_id = r.end_id
  AND CASE r.day WHEN 'monday' THEN c.monday WHEN 'tuesday' THEN c.tuesday ELSE c.wednesday END
LEFT JOIN ox_own_resolved d ON d.bpuic = c.arr_stop_id AND d.hour_of_day = (c.arr_time_sec // 3600) % 24
  AND d.line_text IS NOT DISTINCT FROM c.line_text
LEFT JOIN (SELECT query_id, stop_id, max(t) AS best FROM ox_latest_{LATEST_ROUNDS} GROUP BY ALL) b ON b.query_id = r.query_id AND b.stop_id = c.dep_stop_id"""


@query("feasibility_audit", """
SELECT query_id, CASE WHEN arr > deadline_sec THEN 'too late' WHEN round(CASE WHEN q = 0 THEN 1e0 ELSE coalesce(p, 1e0) END, 9) < q
  THEN 'confidence below Q' WHEN best IS NULL THEN 'unreachable' WHEN dep < best THEN 'not better' ELSE 'accepted' END AS reason,
  count(*) AS n FROM ox_audit GROUP BY ALL""")
def feasibility_audit(t):
    p, ask = shared.prepared(t), requests(t, "own")
    latest = search.latest_departures(ask, p.stop_times, p.walking_edges)
    scored = search.scored_arrivals(p.stop_times, p.delay_levels, ask, p.delay_features)
    return lg.feasibility_audit(ask, p.connections, latest, scored)


# The stops where most rides land are watched.
WATCHED = 10
B["ox_watched"] = f"""
SELECT arr_stop_id AS watched_id FROM ox_connections GROUP BY arr_stop_id ORDER BY count(*) DESC, arr_stop_id LIMIT {WATCHED}"""
B["ox_latest_best"] = f"SELECT query_id, stop_id, max(t) AS t FROM ox_latest_{LATEST_ROUNDS} GROUP BY ALL"
B["ox_stop_audit"] = f"""
SELECT x.*, {p_connection_sql('x.slack', 'x.', 'x.')} AS p
FROM (SELECT r.query_id, w.watched_id, r.q, c.dep_time_sec AS dep, l.t AS label, b.t AS best, {", ".join("d." + c for c in ds.DIST_COLS)},
             l.t - CASE WHEN c.arr_stop_id = r.end_id THEN 0 ELSE r.min_transfer_secs END - c.arr_time_sec AS slack
      FROM ox_requests_own r JOIN ox_connections c ON CASE r.day WHEN 'monday' THEN c.monday WHEN 'tuesday' THEN c.tuesday ELSE c.wednesday END
      JOIN ox_watched w ON w.watched_id = c.arr_stop_id OR w.watched_id = c.dep_stop_id
      LEFT JOIN ox_latest_best l ON l.query_id = r.query_id AND l.stop_id = c.arr_stop_id
      LEFT JOIN ox_latest_best b ON b.query_id = r.query_id AND b.stop_id = c.dep_stop_id
      LEFT JOIN ox_own_resolved d ON d.bpuic = c.arr_stop_id AND d.hour_of_day = (c.arr_time_sec // 3600) % 24
        AND d.line_text IS NOT DISTINCT FROM c.line_text) x"""


@query("feasibility_at_stops", """
SELECT query_id, watched_id AS stop_id, CASE WHEN label IS NULL THEN 'unreachable' WHEN slack < 0 THEN 'too late'
  WHEN round(CASE WHEN q = 0 THEN 1e0 ELSE coalesce(p, 1e0) END, 9) < q THEN 'confidence below Q' WHEN dep < best THEN 'not better' ELSE 'accepted' END AS reason,
  count(*) AS n FROM ox_stop_audit GROUP BY ALL""")
def feasibility_at_stops(t):
    p, ask = shared.prepared(t), requests(t, "own")
    latest = cut_lineage(search.latest_departures(ask, p.stop_times, p.walking_edges))
    scored = search.scored_arrivals(p.stop_times, p.delay_levels, ask, p.delay_features)
    busiest = p.connections.groupBy(F.col("arr_stop_id").alias("stop_id")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "stop_id").limit(WATCHED)
    return lg.feasibility_at_stops(ask, p.connections, latest, scored, busiest)
