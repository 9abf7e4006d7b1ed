"""Itinerary search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import cut_lineage
from ..functions import fixed_values as fv
from ..operators import legs as lg
from ..operators import search, service_days
from ..operators.skyline import undominated
from . import search_sql, shared
from .registry import ORACLE_BLOCKS, query
from .shared import rounded, rounded_sql

_routes: dict[tuple[str, str, str], DataFrame] = {}


def pairs(t) -> DataFrame:
    return search.paired_requests(shared.prepared(t).stops)


def _spread(rows: DataFrame, column: str, values: list) -> DataFrame:
    return rows.withColumn(column, F.explode(F.array(*[F.lit(v) for v in values])))


def requests(t, panel: str) -> DataFrame:
    if panel == "external":
        # The pairs of the other planner's answers; each origin has one destination there.
        known = shared.prepared(t).stops.select("stop_id")
        asked = t.view("fx_external_json").select(F.col("orig_id").alias("start_id"), F.col("dest_id").alias("end_id")).distinct()
        for side in ("start_id", "end_id"):
            asked = asked.join(known.withColumnRenamed("stop_id", side), side, "left_semi")
        asked = asked.where("start_id <> end_id").select(F.col("start_id").alias("query_id"), "start_id", "end_id")
        return search.as_requests(asked.withColumns({"day": F.lit("tuesday"), "q": F.lit(0.0)}), max_routes=1)
    base = pairs(t)
    if panel == "own":
        return search.as_requests(base)
    if panel == "many":
        return search.as_requests(base, max_routes=search_sql.MANY_ROUTES)
    if panel == "ladder":
        rows = _spread(base.drop("q"), "q", [0.0, 0.5, 0.7, 0.8, 0.9, 0.95, 1.0])
        step = F.when(F.col("q") == 1.0, 99).otherwise(F.round(F.col("q") * 100)).cast("bigint")
        return search.as_requests(rows.withColumn("query_id", F.col("query_id") * 100 + step), max_routes=1)
    rows = _spread(base.withColumn("q", F.lit(0.0)), "max_walk_m", [0.0, 500.0])
    rows = rows.withColumn("query_id", F.col("query_id") * 1000 + F.col("max_walk_m").cast("bigint"))
    loops = base.withColumns({"query_id": F.col("query_id") * 1000 + 999, "end_id": F.col("start_id"), "q": F.lit(0.0),
                              "max_walk_m": F.lit(500.0)})
    return search.as_requests(rows.unionByName(loops), max_routes=1)


def routes(t, panel: str = "own") -> DataFrame:
    """Routes of a panel, searched once per session and kept in the shared folder."""
    key = (t.spark.sparkContext.applicationId, t.folder, panel)
    if key not in _routes:
        p = shared.prepared(t)
        _routes[key] = cut_lineage(search.ranked_routes(
            requests(t, panel), p.stop_times, p.walking_edges, p.delay_levels))
    return _routes[key]


_INTS = "CAST(option AS INTEGER) AS option, CAST(boardings AS INTEGER) AS boardings, CAST(n_transfers AS INTEGER) AS n_transfers"


@query("random_od_pairs", "SELECT query_id, start_id, end_id, day, q FROM ox_pairs")
def random_od_pairs(t):
    return pairs(t)


@query("validate_queries", """
SELECT query_id, CASE WHEN start_id NOT IN (SELECT stop_id FROM ox_region_stops) THEN 'unknown start'
  WHEN end_id NOT IN (SELECT stop_id FROM ox_region_stops) THEN 'unknown end'
  WHEN day NOT IN ('monday','tuesday','wednesday','thursday','friday','saturday','sunday') THEN 'unknown day'
  WHEN NOT max_walk_m BETWEEN 0 AND 500 THEN 'walk limit out of range' ELSE 'ok' END AS status
FROM (SELECT o_orderkey AS query_id, 8500000 + o_custkey % 110 AS start_id, 8500000 + o_orderkey % 120 AS end_id,
             CASE WHEN o_orderkey % 7 = 0 THEN 'someday' ELSE 'friday' END AS day, CAST(o_orderkey % 600 - 20 AS DOUBLE) AS max_walk_m
      FROM {orders}) r""")
def validate_queries(t):
    rows = t.sql("""SELECT o_orderkey AS query_id, 8500000 + o_custkey % 110 AS start_id, 8500000 + o_orderkey % 120 AS end_id,
        CASE WHEN o_orderkey % 7 = 0 THEN 'someday' ELSE 'friday' END AS day, CAST(o_orderkey % 600 - 20 AS DOUBLE) AS max_walk_m
        FROM {orders}""")
    return search.validate_requests(rows, shared.prepared(t).stops).select("query_id", "status")


@query("direct_itineraries", """
SELECT r.query_id, a.trip_id, a.label, b.seq AS board_seq, a.seq AS alight_seq, b.dep, a.arr
FROM (SELECT *, CASE day WHEN 'monday' THEN 1 WHEN 'tuesday' THEN 2 ELSE 4 END AS bit FROM ox_requests_own) r
JOIN ox_calls_by_day a ON a.stop_id = r.end_id AND a.arr <= r.deadline_sec AND (a.day_mask & r.bit) <> 0
JOIN ox_calls_by_day b ON b.trip_id = a.trip_id AND b.stop_id = r.start_id AND b.seq < a.seq""")
def direct_itineraries(t):
    return search.direct_itineraries(requests(t, "own"), shared.prepared(t).stop_times)


_ONE_TRANSFER = """
SELECT r.query_id, a.trip_id AS trip_1, b.trip_id AS trip_2, a.label AS label_1, b.label AS label_2, a0.seq AS board_seq_1,
       a.seq AS alight_seq_1, a0.dep AS dep_1, a.arr AS arr_1, a.stop_id AS alight_stop_1, b.stop_id AS board_stop_2,
       round(w.walk_m, 3) + 0e0 AS walk_m, b.seq AS board_seq_2, z.seq AS alight_seq_2, b.dep AS dep_2, z.arr AS arr_2
FROM (SELECT *, CASE day WHEN 'monday' THEN 1 WHEN 'tuesday' THEN 2 ELSE 4 END AS bit FROM ox_requests_own) r
JOIN ox_calls_by_day z ON z.stop_id = r.end_id AND z.arr <= r.deadline_sec AND (z.day_mask & r.bit) <> 0
JOIN ox_calls_by_day b ON b.trip_id = z.trip_id AND b.seq < z.seq AND b.stop_id <> r.end_id AND b.stop_id <> r.start_id
JOIN (SELECT a_stop_id, b_stop_id, distance_m AS walk_m, walk_sec FROM ox_walks
      UNION ALL SELECT DISTINCT stop_id, stop_id, 0e0, 0 FROM ox_calls_by_day) w ON w.b_stop_id = b.stop_id AND w.walk_m <= r.max_walk_m
JOIN ox_calls_by_day a ON a.stop_id = w.a_stop_id AND a.stop_id <> r.start_id AND a.stop_id <> r.end_id AND a.trip_id <> b.trip_id
  AND (a.day_mask & r.bit) <> 0 AND a.arr + r.min_transfer_secs + w.walk_sec <= b.dep
JOIN ox_calls_by_day a0 ON a0.trip_id = a.trip_id AND a0.seq < a.seq AND a0.stop_id = r.start_id"""


@query("one_transfer_itineraries", _ONE_TRANSFER)
def one_transfer_itineraries(t):
    return _transfers(t, search.one_transfer_itineraries)


def _transfers(t, made, **options):
    p = shared.prepared(t)
    out = made(requests(t, "own"), p.stop_times, p.walking_edges, **options)
    return out.select(*[c for c in out.columns if c != "walk_m"], *rounded(["walk_m"], 3))


MAX_WAIT_SECS = 900


@query("one_transfer_within_wait", f"{_ONE_TRANSFER} AND b.dep - w.walk_sec - a.arr - r.min_transfer_secs <= {MAX_WAIT_SECS}")
def one_transfer_within_wait(t):
    return _transfers(t, search.one_transfer_itineraries, max_wait_secs=MAX_WAIT_SECS)


@query("latest_transfers", f"""{_ONE_TRANSFER}
QUALIFY row_number() OVER (PARTITION BY r.query_id, b.trip_id, b.seq, z.seq
  ORDER BY a0.dep DESC, w.walk_sec, a.arr, a.trip_id DESC, a0.seq DESC, a.seq DESC, a.stop_id) = 1""")
def latest_transfers(t):
    return _transfers(t, search.latest_transfers)


def _round_sql(k: int) -> None:
    prev = f"ox_latest_{k - 1}"
    best = f"SELECT query_id, stop_id, max(t) AS t FROM {prev} GROUP BY ALL"
    ORACLE_BLOCKS[f"ox_latest_ride_{k}"] = f"""
SELECT r.query_id, b.stop_id, max(b.dep) AS t
FROM ({best}) l JOIN (SELECT *, CASE day WHEN 'monday' THEN 1 WHEN 'tuesday' THEN 2 ELSE 4 END AS bit FROM ox_requests_own) r USING (query_id)
JOIN ox_calls_by_day a ON a.stop_id = l.stop_id AND (a.day_mask & r.bit) <> 0
  AND a.arr <= l.t - CASE WHEN l.stop_id = r.end_id THEN 0 ELSE r.min_transfer_secs END
JOIN ox_calls_by_day b ON b.trip_id = a.trip_id AND b.seq < a.seq AND b.stop_id <> r.end_id GROUP BY ALL"""
    _walk_sql(k)


def _walk_sql(k: int) -> None:
    ORACLE_BLOCKS[f"ox_latest_{k}"] = f"""
SELECT query_id, stop_id, CAST({k} AS INTEGER) AS boardings, max(t) AS t FROM (
  SELECT query_id, stop_id, t FROM ox_latest_ride_{k}
  UNION ALL SELECT l.query_id, w.a_stop_id, l.t - w.walk_sec FROM ox_latest_ride_{k} l JOIN ox_walks w ON w.b_stop_id = l.stop_id
  JOIN ox_requests_own r ON r.query_id = l.query_id WHERE w.distance_m <= r.max_walk_m AND w.a_stop_id <> r.end_id AND l.t >= w.walk_sec) u
GROUP BY query_id, stop_id"""


ORACLE_BLOCKS["ox_latest_ride_0"] = "SELECT query_id, end_id AS stop_id, deadline_sec AS t FROM ox_requests_own"
_walk_sql(0)
# Rounds that the SQL follows. The search itself has no limit, so equal results show that no stop needs more.
LATEST_ROUNDS = 6
for _k in range(1, LATEST_ROUNDS + 1):
    _round_sql(_k)
    # A round's reach includes what fewer boardings reach.
    ORACLE_BLOCKS[f"ox_latest_{_k}"] += f" UNION ALL SELECT query_id, stop_id, boardings, t FROM ox_latest_{_k - 1}"


@query("latest_departure_rounds", """
SELECT query_id, stop_id, boardings, t FROM (
  SELECT *, max(t) OVER (PARTITION BY query_id, stop_id ORDER BY boardings ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM ox_latest_{n}) x WHERE before IS NULL OR t > before""".replace("{n}", str(LATEST_ROUNDS)))
def latest_departure_rounds(t):
    p = shared.prepared(t)
    return search.latest_departures(requests(t, "own"), p.stop_times, p.walking_edges)


@query("robust_labels", f"""
SELECT DISTINCT query_id, stop_id, t, conf, CAST(boardings AS INTEGER) AS boardings, walk_m, next_label, trail
FROM (SELECT {search_sql._STATE} FROM ox_own_v1 UNION ALL SELECT {search_sql._STATE} FROM ox_own_c0) v""")
def robust_labels(t):
    p = shared.prepared(t)
    ask = requests(t, "own")
    arrivals = cut_lineage(search.scored_arrivals(p.stop_times, p.delay_levels, ask))
    first = search.destination_labels(ask)
    walked = search.walk_back(first, p.walking_edges)
    # Used twice: the first domination runs once.
    labels = cut_lineage(undominated(first.unionByName(walked.where("stop_id <> start_id")), class_column="next_label"))
    boarded = search.ride_back(labels, arrivals, search.calls_by_day(p.stop_times))
    vehicle = undominated(boarded.where("stop_id <> start_id"), class_column="next_label")
    return vehicle.unionByName(labels).select("query_id", "stop_id", "t", "conf", "boardings", "walk_m", "next_label", "trail")


ORACLE_BLOCKS["ox_own_c0"] = "SELECT * FROM ox_own_a0"

# Every call as a label of its stop, with criteria that often tie.
_LABELS = """SELECT stop_id, CAST(arrival_time_sec AS BIGINT) AS t, CAST((trip_id * 7 + stop_sequence) % 50 AS DOUBLE) / 50 AS conf,
  CAST(1 + trip_id % 3 AS INT) AS boardings, CAST((trip_id * 13) % 9 AS DOUBLE) * 50 AS walk_m,
  CAST(trip_id AS STRING) || '/' || CAST(stop_sequence AS STRING) AS trail FROM fx_stop_times"""


@query("label_dominance", f"""
SELECT * FROM ({_LABELS}) r WHERE NOT EXISTS (SELECT 1 FROM ({_LABELS}) x WHERE x.stop_id = r.stop_id AND x.t >= r.t AND x.conf >= r.conf
  AND x.boardings <= r.boardings AND x.walk_m <= r.walk_m
  AND (x.t > r.t OR x.conf > r.conf OR x.boardings < r.boardings OR x.walk_m < r.walk_m OR x.trail < r.trail))""")
def label_dominance(t):
    return undominated(t.sql(_LABELS), keys=("stop_id",), max_boardings=3)


@query("ranked_routes", f"""
SELECT query_id, start_id, end_id, q, {_INTS}, t AS dep_sec, conf, walk_m, lines, trail FROM ox_own_routes""")
def ranked_routes(t):
    p = shared.prepared(t)
    found = search.ranked_routes(requests(t, "own"), p.stop_times, p.walking_edges, p.delay_levels)
    return found.drop("path")


@query("ranked_alternatives", f"""
SELECT query_id, start_id, end_id, q, {_INTS}, t AS dep_sec, conf, walk_m, lines, trail FROM ox_many_routes""")
def ranked_alternatives(t):
    p = shared.prepared(t)
    found = search.ranked_routes(requests(t, "many"), p.stop_times, p.walking_edges, p.delay_levels, all_alternatives=True)
    return found.drop("path")


_ON_WEEKDAY = "CASE dayofweek(d) " + " ".join(f"WHEN {(i + 1) % 7} THEN {day}" for i, day in enumerate(fv.DAYS)) + " END"


def service_dates_sql(calendar: str, exceptions: str) -> str:
    """All (service, date) on which services run."""
    return f"""
SELECT service_id, d FROM (
  SELECT service_id, d FROM (SELECT *, CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS d FROM {calendar}) c WHERE {_ON_WEEKDAY}
  EXCEPT SELECT service_id, date FROM {exceptions} WHERE exception_type = 2) u
UNION SELECT service_id, date FROM {exceptions} WHERE exception_type = 1"""


ORACLE_BLOCKS["ox_service_dates"] = service_dates_sql("fx_service_calendar", "fx_service_exceptions")
ORACLE_BLOCKS["ox_trip_dates"] = service_dates_sql("fx_trip_calendar", "fx_trip_exceptions")


@query("service_days", """
SELECT service_id, count(*) AS n_days, min(d) AS first_date, max(d) AS last_date, CAST(sum(d - DATE '1970-01-01') AS BIGINT) AS day_sum
FROM ox_service_dates GROUP BY service_id""")
def service_day_counts(t):
    made = service_days.service_days(t.view("fx_service_calendar"), t.view("fx_service_exceptions"))
    return made.select("service_id", *[c.alias(n) for n, c in service_days.date_totals("service_bits").items()])


def dated_stop_times(t) -> DataFrame:
    return service_days.with_service_days(shared.prepared(t).stop_times, service_days.service_days(t.view("fx_trip_calendar"), t.view("fx_trip_exceptions")))


def dated_requests(t) -> DataFrame:
    """The pairs, each on a date of four weeks."""
    return search.as_requests(pairs(t), date=F.date_add(F.lit("1996-03-04").cast("date"), (F.col("start_id") % 28).cast("int")))


ORACLE_BLOCKS["ox_requests_dated"] = """
SELECT * EXCLUDE (day), DATE '1996-03-04' + CAST(start_id % 28 AS INTEGER) AS date FROM ox_requests_own"""


@query("itineraries_on_date", """
SELECT r.query_id, r.date, a.trip_id, a.label, b.seq AS board_seq, a.seq AS alight_seq, b.dep, a.arr
FROM ox_requests_dated r JOIN ox_calls_by_day a ON a.stop_id = r.end_id AND a.arr <= r.deadline_sec
JOIN fx_trips s ON CAST(s.trip_id AS VARCHAR) = a.trip_id JOIN ox_trip_dates d ON d.service_id = s.service_id AND d.d = r.date
JOIN ox_calls_by_day b ON b.trip_id = a.trip_id AND b.stop_id = r.start_id AND b.seq < a.seq""")
def itineraries_on_date(t):
    asked = dated_requests(t)
    found = search.direct_itineraries(asked, dated_stop_times(t))
    return found.join(asked.select("query_id", "date"), "query_id")
