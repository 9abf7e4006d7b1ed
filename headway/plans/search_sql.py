"""The backward search written out as SQL blocks, round by round, for the oracles."""

from __future__ import annotations

from ..functions import fixed_values as fv
from ..operators import distributions as ds
from .registry import ORACLE_BLOCKS as B
from .scalar_queries import p_connection_sql, resolve_sql

_DAY_MASK = " + ".join(f"CASE WHEN {d} THEN {1 << i} ELSE 0 END" for i, d in enumerate(fv.DAYS))
_DAY_BIT = "CASE day " + " ".join(f"WHEN '{d}' THEN {1 << i}" for i, d in enumerate(fv.DAYS)) + " ELSE 0 END"

B["ox_calls_by_day"] = f"""
SELECT CAST(trip_id AS VARCHAR) AS trip_id, stop_sequence AS seq, stop_id, CAST(arrival_time_sec AS BIGINT) AS arr,
       CAST(departure_time_sec AS BIGINT) AS dep, coalesce(nullif(route_label, ''), nullif(line_text, ''), CAST(trip_id AS VARCHAR)) AS label,
       line_text, {_DAY_MASK} AS day_mask
FROM ox_stop_times"""

B["ox_walks"] = """
SELECT a_stop_id, b_stop_id, distance_m, CAST(floor(distance_m / (50e0 / 60e0)) AS BIGINT) AS walk_sec FROM ox_edges"""

_HEX = "(strpos('0123456789abcdef', substr(digest, {0}, 1)) - 1) * 16 + strpos('0123456789abcdef', substr(digest, {0} + 1, 1)) - 1"


def pairs_sql(seed: str = "od") -> str:
    return f"""
SELECT stop_id AS query_id, stop_id AS start_id, end_id, ['monday', 'tuesday', 'wednesday'][({_HEX.format(3)}) % 3 + 1] AS day,
       [0.5e0, 0.7e0, 0.8e0, 0.9e0][({_HEX.format(5)}) % 4 + 1] AS q
FROM (SELECT *, coalesce(lead(stop_id) OVER w, first_value(stop_id) OVER w) AS end_id
      FROM (SELECT stop_id, md5('{seed}' || CAST(stop_id AS VARCHAR)) AS digest FROM ox_region_stops) d
      WINDOW w AS (PARTITION BY ({_HEX.format(1)}) % 4 ORDER BY digest)) p
WHERE end_id <> stop_id"""


B["ox_pairs"] = pairs_sql()
B["ox_requests_own"] = """
SELECT *, CAST(32400 AS BIGINT) AS deadline_sec, 3 AS max_routes, 120 AS min_transfer_secs, 500e0 AS max_walk_m FROM ox_pairs"""
MANY_ROUTES = 10
B["ox_requests_many"] = f"SELECT * EXCLUDE (max_routes), {MANY_ROUTES} AS max_routes FROM ox_requests_own"
B["ox_requests_ladder"] = """
SELECT query_id * 100 + l.i AS query_id, start_id, end_id, day, l.q, CAST(32400 AS BIGINT) AS deadline_sec, 1 AS max_routes,
       120 AS min_transfer_secs, 500e0 AS max_walk_m
FROM ox_pairs CROSS JOIN (VALUES (0, 0e0), (50, 0.5e0), (70, 0.7e0), (80, 0.8e0), (90, 0.9e0), (95, 0.95e0), (99, 1e0)) l(i, q)"""
B["ox_requests_walks"] = """
SELECT query_id * 1000 + m.m AS query_id, start_id, end_id, day, 0e0 AS q, CAST(32400 AS BIGINT) AS deadline_sec, 1 AS max_routes,
       120 AS min_transfer_secs, CAST(m.m AS DOUBLE) AS max_walk_m FROM ox_pairs CROSS JOIN (VALUES (0), (500)) m(m)
UNION ALL SELECT query_id * 1000 + 999, start_id, start_id, day, 0e0, 32400, 1, 120, 500e0 FROM ox_pairs"""

B["ox_requests_external"] = """
SELECT start_id AS query_id, start_id, end_id, 'tuesday' AS day, 0e0 AS q, CAST(32400 AS BIGINT) AS deadline_sec, 1 AS max_routes,
       120 AS min_transfer_secs, 500e0 AS max_walk_m
FROM (SELECT DISTINCT orig_id AS start_id, dest_id AS end_id FROM fx_external_json) p
WHERE start_id <> end_id AND start_id IN (SELECT stop_id FROM ox_region_stops) AND end_id IN (SELECT stop_id FROM ox_region_stops)"""

_REQ = "query_id, start_id, end_id, day_bit, dow_bucket, q, min_transfer_secs, max_walk_m, max_routes"
_STATE = _REQ + ", stop_id, t, conf, boardings, walk_m, next_label, trail, legs, lines, first_line"


def _pareto(source: str, older: str | None = None, all_alternatives: bool = False) -> str:
    def beats(x: str, with_ties: bool) -> str:
        # A label with a class is only beaten by its own class; where all alternatives are asked for, by the same lines.
        better = (f"{x}.query_id = r.query_id AND {x}.stop_id = r.stop_id AND (r.next_label IS NULL OR {x}.next_label = r.next_label) "
                  f"AND {x}.t >= r.t AND {x}.conf >= r.conf AND {x}.boardings <= r.boardings AND {x}.walk_m <= r.walk_m")
        if all_alternatives:
            better += f" AND {x}.lines = r.lines"
        if with_ties:
            better += (f" AND ({x}.t > r.t OR {x}.conf > r.conf OR {x}.boardings < r.boardings OR {x}.walk_m < r.walk_m "
                       f"OR {x}.trail < r.trail)")
        return better
    old = f" AND NOT EXISTS (SELECT 1 FROM {older} o WHERE {beats('o', False)})" if older else ""
    return f"SELECT * FROM {source} r WHERE NOT EXISTS (SELECT 1 FROM {source} x WHERE {beats('x', True)}){old}"


def _walk(source: str) -> str:
    return f"""
SELECT query_id, start_id, end_id, day_bit, dow_bucket, q, min_transfer_secs, max_walk_m, max_routes, w.a_stop_id AS stop_id,
       r.t - w.walk_sec AS t, conf, boardings, round(walk_m + w.distance_m, 3) AS walk_m, CAST(NULL AS VARCHAR) AS next_label,
       'w' || CAST(w.a_stop_id AS VARCHAR) || '>' || CAST(r.stop_id AS VARCHAR) || '|' || trail AS trail,
       'walk;' || CAST(w.a_stop_id AS VARCHAR) || ';' || CAST(r.stop_id AS VARCHAR) || ';;;;' || CAST(r.t - w.walk_sec AS VARCHAR) || ';'
       || CAST(r.t AS VARCHAR) || ';' || CAST(round(w.distance_m, 3) AS VARCHAR) || '|' || legs AS legs, lines, first_line
FROM {source} r JOIN ox_walks w ON w.b_stop_id = r.stop_id
WHERE r.stop_id <> r.start_id AND round(walk_m + w.distance_m, 3) <= max_walk_m AND r.t - w.walk_sec >= 0 AND w.a_stop_id <> end_id"""


def _union(prefix: str, kind: str, rounds: range) -> str:
    return "(" + " UNION ALL ".join(f"SELECT {_STATE} FROM {prefix}{kind}{k}" for k in rounds) + ")"


def _ride(labels: str, scored: str, later: bool = False) -> str:
    change = "CASE WHEN r.stop_id = r.end_id THEN 0 ELSE r.min_transfer_secs END"
    events = f"""
SELECT r.*, a.trip_id, a.seq, a.arr, a.label, a.line_text, b.stop_id AS b_stop, b.dep AS b_dep,
       r.t - {change} - a.arr AS slack, {", ".join("a." + c for c in ds.DIST_COLS)}
FROM {labels} r JOIN {scored} a ON a.stop_id = r.stop_id AND a.dow_bucket = r.dow_bucket
JOIN ox_calls_by_day b ON b.trip_id = a.trip_id
WHERE r.stop_id <> r.start_id AND a.arr <= r.t - {change} AND (a.day_mask & r.day_bit) <> 0 AND b.seq < a.seq
  AND b.stop_id <> r.stop_id AND b.stop_id <> r.end_id AND b.dep <= a.arr
  {"AND b.dep >= r.floor_sec" if later else ""}"""
    certain = "q = 0 OR (stop_id <> end_id AND coalesce(next_label = label, false))"
    return f"""
SELECT {_REQ}, b_stop AS stop_id, b_dep AS t, new_conf AS conf, boardings + 1 AS boardings, walk_m, label AS next_label,
       trip_id || ':' || CAST(b_stop AS VARCHAR) || '>' || CAST(stop_id AS VARCHAR) || '|' || trail AS trail,
       'ride;' || CAST(b_stop AS VARCHAR) || ';' || CAST(stop_id AS VARCHAR) || ';' || trip_id || ';' || label || ';' ||
       coalesce(line_text, '') || ';' || CAST(b_dep AS VARCHAR) || ';' || CAST(arr AS VARCHAR) || ';0|' || legs AS legs,
       CASE WHEN first_line = label THEN lines WHEN lines = '' THEN label ELSE label || ' > ' || lines END AS lines, label AS first_line
FROM (SELECT *, round(conf * CASE WHEN {certain} THEN 1e0 ELSE coalesce({p_connection_sql("e.slack", "e.", "e.")}, 1e0) END, 9) AS new_conf
      FROM ({events}) e) s WHERE new_conf >= q"""


_START = ("query_id, start_id, end_id, q, max_routes, t, conf, boardings, walk_m, trail, legs, lines, "
          "greatest(boardings - 1, 0) AS n_transfers")
_ORDER = "t DESC, n_transfers, walk_m, conf DESC, trail"


def _ranked(sources: list[str]) -> str:
    union = " UNION ALL ".join(f"SELECT {_START} FROM {s} WHERE stop_id = start_id" for s in sources)
    return f"""
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {_ORDER}) AS option FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id, lines ORDER BY {_ORDER}) AS n FROM ({union}) f) g WHERE n = 1"""


# Boardings that the SQL follows. The search itself has no limit, so equal results show that no route needs more.
ROUNDS = 4


def add_search(name: str, requests: str, all_alternatives: bool = False) -> None:
    """Blocks of a search with at most ``ROUNDS`` boardings; its routes are in ``ox_<name>_routes``."""
    p = f"ox_{name}_"
    B[p + "asked"] = f"""
SELECT DISTINCT c.stop_id AS bpuic, CAST((c.arr // 3600) % 24 AS INTEGER) AS hour_of_day, k.dow_bucket, c.line_text,
       CAST(NULL AS VARCHAR) AS product_id_clean
FROM ox_calls_by_day c CROSS JOIN (SELECT DISTINCT CASE day WHEN 'saturday' THEN 'saturday' WHEN 'sunday' THEN 'sunday' ELSE 'weekday' END
     AS dow_bucket FROM {requests}) k"""
    B[p + "resolved"] = resolve_sql(p + "asked")
    B[p + "scored"] = f"""
SELECT c.*, d.dow_bucket, {", ".join("d." + c for c in ds.DIST_COLS)}
FROM ox_calls_by_day c JOIN {p}resolved d ON d.bpuic = c.stop_id AND d.hour_of_day = (c.arr // 3600) % 24
  AND d.line_text IS NOT DISTINCT FROM c.line_text"""
    B[p + "v0"] = f"""
SELECT query_id, start_id, end_id, {_DAY_BIT} AS day_bit,
       CASE day WHEN 'saturday' THEN 'saturday' WHEN 'sunday' THEN 'sunday' ELSE 'weekday' END AS dow_bucket, q, min_transfer_secs,
       max_walk_m, max_routes, end_id AS stop_id, deadline_sec AS t, 1e0 AS conf, 0 AS boardings, 0e0 AS walk_m,
       CAST(NULL AS VARCHAR) AS next_label, '' AS trail, '' AS legs, '' AS lines, CAST(NULL AS VARCHAR) AS first_line
FROM {requests} WHERE start_id <> end_id"""
    B[p + "w0"] = _walk(p + "v0")
    B[p + "u0"] = f"SELECT {_STATE} FROM {p}v0 UNION ALL SELECT {_STATE} FROM {p}w0 WHERE stop_id <> start_id"
    B[p + "a0"] = _pareto(p + "u0", None, all_alternatives)
    B[p + "b1"] = _ride(p + "a0", p + "scored")
    B[p + "c1"] = f"SELECT * FROM {p}b1 WHERE stop_id <> start_id"
    B[p + "v1"] = _pareto(p + "c1", None, all_alternatives)
    B[p + "w1"] = _walk(p + "v1")
    B[p + "f1"] = _ranked([p + "w0", p + "b1", p + "w1"])
    sources = [p + "w0", p + "b1", p + "w1"]
    for k in range(1, ROUNDS):
        B[p + f"f{k}"] = _ranked(sources)
        # Requests that have all their routes need no later label that leaves before the last of them.
        B[p + f"u{k}"] = f"""
SELECT u.*, coalesce(f.t, 0) AS floor_sec FROM (SELECT {_STATE} FROM {p}v{k} UNION ALL SELECT {_STATE} FROM {p}w{k} WHERE stop_id <> start_id) u
LEFT JOIN {p}f{k} f ON f.query_id = u.query_id AND f.option = f.max_routes WHERE f.t IS NULL OR u.t >= f.t"""
        B[p + f"a{k}"] = _pareto(p + f"u{k}", _union(p, "a", range(k)), all_alternatives)
        B[p + f"b{k + 1}"] = _ride(p + f"a{k}", p + "scored", later=True)
        B[p + f"c{k + 1}"] = f"SELECT * FROM {p}b{k + 1} WHERE stop_id <> start_id"
        B[p + f"v{k + 1}"] = _pareto(p + f"c{k + 1}", _union(p, "v", range(1, k + 1)), all_alternatives)
        B[p + f"w{k + 1}"] = _walk(p + f"v{k + 1}")
        sources += [p + f"b{k + 1}", p + f"w{k + 1}"]
    B[p + "all"] = _ranked(sources)
    B[p + "routes"] = f"SELECT * FROM {p}all WHERE option <= max_routes"
    B[p + "legs"] = f"""
SELECT query_id, start_id, end_id, q, option, leg_no, split_part(leg, ';', 1) AS kind, CAST(split_part(leg, ';', 2) AS BIGINT) AS from_stop,
       CAST(split_part(leg, ';', 3) AS BIGINT) AS to_stop, nullif(split_part(leg, ';', 4), '') AS trip_id,
       nullif(split_part(leg, ';', 5), '') AS label, nullif(split_part(leg, ';', 6), '') AS line_text,
       CAST(split_part(leg, ';', 7) AS BIGINT) AS dep_sec, CAST(split_part(leg, ';', 8) AS BIGINT) AS arr_sec,
       CAST(split_part(leg, ';', 9) AS DOUBLE) AS walk_m
FROM (SELECT query_id, start_id, end_id, q, option, generate_subscripts(string_split(rtrim(legs, '|'), '|'), 1) AS leg_no,
             unnest(string_split(rtrim(legs, '|'), '|')) AS leg FROM {p}routes WHERE legs <> '') l"""


for _name in ("own", "ladder", "walks", "external"):
    add_search(_name, f"ox_requests_{_name}")
add_search("many", "ox_requests_many", all_alternatives=True)
